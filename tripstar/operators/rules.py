"""Data-quality rules of the silver layer and the valid / quarantine split.

Rules are named ``Column`` predicates over the raw (bronze) column names. The conjunction is
three-valued: a NULL operand (e.g. a NULL fee) makes the row's validity *unknown* rather than
false. ``on_null="quarantine"`` (default) routes such rows to quarantine with a ``<rule>_null``
reason; ``on_null="drop"`` reproduces a plain ``filter(cond)`` / ``filter(~cond)`` split, in which
unknown rows reach neither output (:func:`unknown_rows` exposes them).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the reason text of every quarantined row.
QUARANTINE_REASON = "failed_data_quality_validation"

# Reason class of each rule (the quarantine classes of the layer design: provider,
# bad timestamps, bad / unknown zone, bad duration, negative amounts). ``<rule>_null`` keeps the
# class of its rule.
RULE_CLASSES = {
    "license_present": "provider",
    "request_present": "timestamps",
    "pickup_present": "timestamps",
    "dropoff_present": "timestamps",
    "request_not_after_pickup": "timestamps",
    "pickup_before_dropoff": "timestamps",
    "pickup_zone_in_range": "zone",
    "dropoff_zone_in_range": "zone",
    "trip_time_positive": "duration",
    "duration_consistent": "duration",
}

Rule = tuple[str, Column]

# Fee columns that must be >= 0.
_NON_NEGATIVE = (
    "trip_miles", "base_passenger_fare", "tolls", "bcf", "sales_tax",
    "congestion_surcharge", "airport_fee", "tips", "driver_pay",
)


def ride_rules() -> list[Rule]:
    """The 18 ride rules, in evaluation order."""
    c = F.col
    rules: list[Rule] = [
        ("license_present", c("hvfhs_license_num").isNotNull()),
        ("request_present", c("request_datetime").isNotNull()),
        ("pickup_present", c("pickup_datetime").isNotNull()),
        ("dropoff_present", c("dropoff_datetime").isNotNull()),
        ("request_not_after_pickup", c("request_datetime") <= c("pickup_datetime")),
        ("pickup_before_dropoff", c("pickup_datetime") < c("dropoff_datetime")),
        ("pickup_zone_in_range", c("PULocationID").between(1, 265)),
        ("dropoff_zone_in_range", c("DOLocationID").between(1, 265)),
        ("trip_time_positive", c("trip_time") > 0),
    ]
    rules += [(f"{name}_non_negative", c(name) >= 0.0) for name in _NON_NEGATIVE]
    return rules


def duration_rule(tolerance_sec: int) -> Rule:
    """Opt-in rule: computed and reported trip durations agree within ``tolerance_sec``.
    Applies to silver names (``trip_duration_sec``, ``reported_duration_sec``)."""
    return ("duration_consistent",
            F.abs(F.col("trip_duration_sec") - F.col("reported_duration_sec")) <= tolerance_sec)


def reason_class(rule_name: str) -> str:
    base = rule_name[:-5] if rule_name.endswith("_null") else rule_name
    return RULE_CLASSES.get(base, "amounts" if base.endswith("_non_negative") else "other")


def validity(rules: list[Rule]) -> Column:
    """Three-valued conjunction of all rules (TRUE / FALSE / NULL)."""
    return reduce(lambda a, b: a & b, (pred for _, pred in rules))


def _rule_flags(rules: list[Rule]) -> list[tuple[str, Column]]:
    """For each rule: (``name``, fails) and (``name_null``, cannot be judged)."""
    flags = []
    for name, pred in rules:
        flags.append((name, ~pred))
        flags.append((f"{name}_null", pred.isNull()))
    return flags


def failed_rules(rules: list[Rule]) -> Column:
    """Comma-joined names of the rules a row fails (``name``) or cannot be judged on
    (``name_null``), in rule order; ``''`` for a valid row. ``concat_ws`` skips NULLs, so this
    stays a plain codegen'd expression (no higher-order lambda)."""
    return F.concat_ws(",", *[F.when(flag, F.lit(name)) for name, flag in _rule_flags(rules)])


def valid_rows(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Rows on which every rule is TRUE. Simple predicates reach the Parquet scan."""
    return df.filter(validity(rules or ride_rules()))


def quarantine_rows(df: DataFrame, rules: list[Rule] | None = None, on_null: str = "quarantine") -> DataFrame:
    """Rows that fail (or, with ``on_null="quarantine"``, cannot be judged on) some rule, with
    ``quarantine_reason`` (constant) and ``failed_rules`` (comma-joined rule names)."""
    rules = rules or ride_rules()
    cond = validity(rules)
    if on_null == "quarantine":
        keep = ~F.coalesce(cond, F.lit(False))
    elif on_null == "drop":
        keep = ~cond
    else:
        raise ValueError(f"on_null must be 'quarantine' or 'drop', got {on_null!r}")
    return df.filter(keep).withColumns({
        "quarantine_reason": F.lit(QUARANTINE_REASON),
        "failed_rules": failed_rules(rules),
    })


def unknown_rows(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Rows whose validity is NULL: no rule false, some rule NULL."""
    return df.filter(validity(rules or ride_rules()).isNull())


def split(df: DataFrame, rules: list[Rule] | None = None, on_null: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)``; both are lazy filters of the same input."""
    rules = rules or ride_rules()
    return valid_rows(df, rules), quarantine_rows(df, rules, on_null)


def reason_counts(quarantine: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Quarantined rows per failed rule, with the rule's reason class (a row failing k rules
    counts once for each).

    One aggregate row with a ``count_if`` per rule flag (partial aggregation, no explode of rows),
    unpivoted with ``stack``; rules no row failed are left out."""
    flags = _rule_flags(rules or ride_rules())
    one = quarantine.agg(*[F.count_if(flag).alias(f"f{i}") for i, (_, flag) in enumerate(flags)])
    triples = ", ".join(f"'{name}', '{reason_class(name)}', f{i}" for i, (name, _) in enumerate(flags))
    return (one.selectExpr(f"stack({len(flags)}, {triples}) AS (rule, reason_class, n_rows)")
            .filter("n_rows > 0"))
