"""Bronze -> silver: validate, standardise, derive, de-duplicate, plus the quarantine branch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar import schemas
from tripstar.operators import rules as R
from tripstar.operators.dedupe import dedupe
from tripstar.operators.standardise import (
    add_quarantine_id, add_trip_id, derive_trip_columns, drop_operational_columns, fill_on_scene, lenient_cast, rename_columns,
)

# The month of the file that a row came in.
MONTH = "source_month"
SILVER_COLUMNS = [f.name for f in schemas.SILVER_RIDES.fields] + [f.name for f in schemas.SILVER_DERIVED.fields]


@dataclass
class SilverResult:
    silver: DataFrame
    quarantine: DataFrame
    prepared: DataFrame  # bronze after drop + fill, the input of the split


def prepare(bronze: DataFrame) -> DataFrame:
    """Drop operational columns and fill ``on_scene_datetime`` (both before validation)."""
    return fill_on_scene(drop_operational_columns(bronze))


def _typed(valid: DataFrame) -> tuple[DataFrame, list[str]]:
    """Declared columns and ``source_month``, if there."""
    month = [MONTH] if MONTH in valid.columns else []
    renamed = lenient_cast(rename_columns(valid.drop("trip_id"), schemas.RIDE_RENAMES), schemas.SILVER_RIDES)
    declared = [f.name for f in schemas.SILVER_RIDES.fields if f.name != "trip_id"]
    return renamed.select(*declared, *month), month


def validated_silver(valid: DataFrame) -> DataFrame:
    """Valid rows -> standardised, derived, deduplicated silver with ``trip_id``: one row per natural key over
    all files. With a ``source_month`` column (which then stays beside the silver columns) the earliest month
    that has a key owns it; the month's survivor is the smallest row (see :func:`dedupe`)."""
    std, month = _typed(valid)
    std = derive_trip_columns(std)
    rest = [c for c in std.columns if c not in schemas.NATURAL_KEY and c not in month]
    deduped = dedupe(std, schemas.NATURAL_KEY, [*month, *rest])
    return add_trip_id(deduped, month=F.col(MONTH) if month else None).select(*SILVER_COLUMNS, *month)


def month_rides(valid: DataFrame, count_col: str) -> DataFrame:
    """Valid rows of source months -> silver rows of each month by itself, in the order of their partitions: a
    function of the month's files alone, whatever else is loaded with it. Which of the months that have a key
    owns it is settled between the months' rows (:mod:`tripstar.plans.ownership`). ``count_col`` gets the number
    of valid rows that a row stands for. Derived columns follow from the key, so they break no tie and are told
    after both exchanges."""
    std, _ = _typed(valid)
    deduped = dedupe(std, [*schemas.NATURAL_KEY, MONTH], count_col=count_col)
    numbered = add_trip_id(deduped, month=F.col(MONTH), by_range=[MONTH])
    return derive_trip_columns(numbered).select(*SILVER_COLUMNS, count_col, MONTH)


def bronze_to_silver(bronze: DataFrame, on_null: str = "quarantine", rules: list | None = None) -> SilverResult:
    """Lazy silver and quarantine frames of one bronze input.

    Silver shuffles twice (the dedupe on the natural key, the numbering on month and cell). Quarantine
    rows keep their raw names (less the operational columns) and every other column of the feed, and
    get their ``trip_id`` *after* the filter, so the validity predicates still reach the scan."""
    rules = rules or R.ride_rules()
    prepared = prepare(bronze)
    quarantine = R.quarantine_rows(prepared, rules, on_null)
    month = F.col(MONTH) if MONTH in bronze.columns else F.date_format("pickup_datetime", "yyyy-MM")
    return SilverResult(validated_silver(R.valid_rows(prepared, rules)), add_quarantine_id(quarantine, month), prepared)


def split_counts(prepared: DataFrame, rules: list | None = None) -> DataFrame:
    """One row per ``on_null`` mode: input rows, valid, quarantined, lost (in neither output),
    and whether the three add up to the input. One aggregate pass."""
    cond = R.validity(rules or R.ride_rules())
    one = prepared.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(cond).alias("valid_rows"),
        F.count_if(~cond).alias("failed_rows"),
        F.count_if(cond.isNull()).alias("unknown_rows"),
    )
    modes = one.selectExpr(
        "input_rows", "valid_rows",
        "stack(2, 'quarantine', failed_rows + unknown_rows, 0L, "
        "'drop', failed_rows, unknown_rows) AS (on_null, quarantine_rows, lost_rows)",
    )
    return modes.withColumn(
        "reconciles", F.col("valid_rows") + F.col("quarantine_rows") + F.col("lost_rows") == F.col("input_rows"))


def pipeline_counts(prepared: DataFrame, rules: list | None = None) -> DataFrame:
    """Bronze, valid, quarantine (default mode), unknown and silver row counts in one job.

    Rows are pre-aggregated per raw natural key (map-side partial aggregate), so the silver
    count -- keys with at least one valid row -- needs no second pass over the data."""
    cond = R.validity(rules or R.ride_rules())
    raw_key = ["hvfhs_license_num", "request_datetime", "pickup_datetime", "dropoff_datetime",
               "PULocationID", "DOLocationID"]
    per_key = prepared.groupBy(*raw_key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(cond).alias("v"),
        F.count_if(cond.isNull()).alias("u"),
    )
    return per_key.agg(
        F.sum("n").cast("bigint").alias("bronze_rows"),
        F.sum("v").cast("bigint").alias("valid_rows"),
        (F.sum("n") - F.sum("v")).cast("bigint").alias("quarantine_rows"),
        F.sum("u").cast("bigint").alias("unknown_rows"),
        F.count_if(F.col("v") > 0).alias("silver_rows"),
    )
