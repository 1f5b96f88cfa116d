"""Demand metrics over the gold star schema: dashboard KPIs, trends, breakdowns, the four
pre-aggregate tables, star joins and integrity checks.

Pattern throughout: aggregate the fact table first (map-side partial aggregation shrinks it to
at most one row per group per task), then join the *aggregated* result to the dimension. No side is
hinted: the planner and AQE broadcast a dimension by its size in bytes or shuffle two small sides, and
fact rows never shuffle for a join. Distances are added as decimals, so totals do not depend on the
order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def for_dates(fact: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Restrict the fact table to pickup dates in ``[start, end]`` (ISO dates, both optional).

    The range is stated on the partition columns (``make_date(year, month, day)``), so on the
    published table it becomes a partition filter: only the matching day directories are listed
    and read. (A predicate on ``date_key`` alone could not prune.)"""
    d = F.make_date("year", "month", "day")
    if start is not None:
        fact = fact.filter(d >= F.lit(start).cast("date"))
    if end is not None:
        fact = fact.filter(d <= F.lit(end).cast("date"))
    return fact


def for_calendar_days(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Fact rows on the days selected from ``dim_date`` (e.g.
    ``dim_date.filter("day_of_week IN ('Saturday', 'Sunday')")``).

    A left-semi star join on the partition columns (``year, month, day``) rather than on
    ``date_key``: a selective predicate (comparison / IN) on the dimension then drives dynamic
    partition pruning of the fact scan -- only the selected days' files are read."""
    keys = days.select("year", "month", "day").distinct()
    return fact.join(keys, ["year", "month", "day"], "left_semi")


def _ride_stats() -> list:
    return [
        F.count(F.lit(1)).alias("rides"),
        *_totals("distance", "trip_duration_sec"),
    ]


def _exact(col: str) -> Column:
    return F.sum(F.col(col).cast("decimal(18,6)"))


def _totals(distance: str, duration: str) -> list[Column]:
    """Order-independent total and mean distance and mean duration."""
    total = _exact(distance).cast("double")
    return [
        total.alias("total_distance"),
        (total / F.count(distance)).alias("avg_distance"),
        (F.sum(duration).cast("double") / F.count(duration)).alias("avg_duration_sec"),
    ]


def kpi_totals(fact: DataFrame) -> DataFrame:
    """Total rides, average distance, average (computed) duration, total distance."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_rides"),
        *_totals("distance", "trip_duration_sec"),
    )


def daily_rides_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Rides per pickup date, with calendar attributes, in date order."""
    per_day = fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("rides"))
    dates = dim_date.select("date_key", "full_date", "day_of_week", "is_weekend")
    return per_day.join(dates, "date_key", "left").select(
        "date_key", "full_date", "day_of_week", "is_weekend", "rides").orderBy("date_key")


def rides_by_hour(fact: DataFrame) -> DataFrame:
    return fact.groupBy("pickup_hour").agg(F.count(F.lit(1)).alias("rides")).orderBy("pickup_hour")


def rides_by_provider(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("hvfhs_license_num").agg(F.count(F.lit(1)).alias("rides"))
            .orderBy(F.desc("rides"), "hvfhs_license_num"))


def rides_by_pickup_zone(fact: DataFrame, dim_zone: DataFrame, top_k: int | None = None) -> DataFrame:
    """Rides per pickup zone with zone name, borough and centroid (map layer). LEFT from the
    fact side, so the totals reconcile with ``kpi_totals`` even for unknown zones. ``top_k``
    keeps the busiest zones only (a top-k report)."""
    per_zone = fact.groupBy("pu_location_id").agg(F.count(F.lit(1)).alias("rides"))
    zones = dim_zone.select(
        F.col("location_id").alias("pu_location_id"), "zone_name", "borough", "centroid_lat", "centroid_lon")
    out = per_zone.join(zones, "pu_location_id", "left").select(
        "pu_location_id", "zone_name", "borough", "centroid_lat", "centroid_lon", "rides")
    out = out.orderBy(F.desc("rides"), "pu_location_id")
    return out.limit(top_k) if top_k else out


def rides_by_zone_pair(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Origin-destination matrix: rides per (pickup zone, dropoff zone), both roles named."""
    per_pair = fact.groupBy("pu_location_id", "do_location_id").agg(F.count(F.lit(1)).alias("rides"))
    zones = dim_zone.select("location_id", "zone_name")
    pu = zones.select(F.col("location_id").alias("pu_location_id"), F.col("zone_name").alias("pu_zone_name"))
    do = zones.select(F.col("location_id").alias("do_location_id"), F.col("zone_name").alias("do_zone_name"))
    return (per_pair.join(pu, "pu_location_id", "left")
            .join(do, "do_location_id", "left")
            .select("pu_location_id", "pu_zone_name", "do_location_id", "do_zone_name", "rides"))


def rides_by_weekday_flag(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Rides and active days per weekday name and weekend flag (fact -> dim_date star join)."""
    per_day = fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("rides"))
    dates = dim_date.select("date_key", "day_of_week", "is_weekend")
    return (per_day.join(dates, "date_key", "left")
            .groupBy("is_weekend", "day_of_week")
            .agg(F.sum("rides").alias("rides"), F.count(F.lit(1)).alias("days")))


def fact_orphan_keys(fact: DataFrame, dim_date: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Foreign-key integrity: per foreign key, the fact rows and distinct keys with no
    dimension row. A NULL key refers to nothing and is no orphan, as in SQL.

    One linear plan over one scan of the fact table: each row emits its three (foreign key,
    value) pairs, a partial aggregate counts rows per pair (a few thousand groups), and one left
    join against the union of all dimension keys marks the pairs that resolve."""
    fks = ("date_key", "pu_location_id", "do_location_id")
    pairs = F.explode(F.array(*[
        F.struct(F.lit(fk).alias("foreign_key"), F.col(fk).cast("bigint").alias("_k")) for fk in fks]))
    per_key = (fact.select(pairs.alias("e")).select("e.*")
               .groupBy("foreign_key", "_k").agg(F.count(F.lit(1)).alias("n")))
    date_keys = dim_date.select(F.lit("date_key").alias("foreign_key"), F.col("date_key").cast("bigint").alias("_k"))
    zone_ids = dim_zone.select(F.col("location_id").cast("bigint").alias("_k"))
    dim_keys = (date_keys
                .unionByName(zone_ids.select(F.lit("pu_location_id").alias("foreign_key"), "_k"))
                .unionByName(zone_ids.select(F.lit("do_location_id").alias("foreign_key"), "_k"))
                .distinct().withColumn("_hit", F.lit(True)))
    marked = per_key.join(dim_keys, ["foreign_key", "_k"], "left")
    orphan = F.col("_hit").isNull() & F.col("_k").isNotNull()
    return marked.groupBy("foreign_key").agg(
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"),
    )


def agg_trips(fact: DataFrame, key: str) -> DataFrame:
    """Pre-aggregate table: group key, rides, total / average distance, average duration."""
    return fact.groupBy(key).agg(*_ride_stats())


# The four pre-aggregate tables and their group keys.
PREAGGREGATES = {
    "agg_trips_daily": "date_key",
    "agg_trips_by_zone": "pu_location_id",
    "agg_trips_by_hour": "pickup_hour",
    "agg_trips_by_company": "hvfhs_license_num",
}


# Group keys of the additive base: everything the pre-aggregates and the calendar need.
BASE_KEYS = ("date_key", "pu_location_id", "pickup_hour", "hvfhs_license_num", "year", "month", "day")


def base_aggregate(fact: DataFrame) -> DataFrame:
    """Additive base of the pre-aggregates: rides and sums by day, zone, hour and provider."""
    return fact.groupBy(*BASE_KEYS).agg(
        F.count(F.lit(1)).alias("rides"), _exact("distance").cast("decimal(38,6)").alias("sum_distance"),
        F.count("distance").alias("n_distance"), F.sum("trip_duration_sec").alias("sum_duration"),
        F.count("trip_duration_sec").alias("n_duration"))


def roll_up(base: DataFrame, key: str) -> DataFrame:
    """A pre-aggregate from the base; equal to :func:`agg_trips` over the fact table."""
    total = F.sum("sum_distance").cast("double")
    return base.groupBy(key).agg(
        F.sum("rides").alias("rides"), total.alias("total_distance"), (total / F.sum("n_distance")).alias("avg_distance"),
        (F.sum("sum_duration").cast("double") / F.sum("n_duration")).alias("avg_duration_sec"))


def agg_trips_daily(fact: DataFrame) -> DataFrame:
    return agg_trips(fact, "date_key")


def agg_trips_by_zone(fact: DataFrame) -> DataFrame:
    return agg_trips(fact, "pu_location_id")


def agg_trips_by_hour(fact: DataFrame) -> DataFrame:
    return agg_trips(fact, "pickup_hour")


def agg_trips_by_company(fact: DataFrame) -> DataFrame:
    return agg_trips(fact, "hvfhs_license_num")


def id_uniqueness(df: DataFrame, id_col: str = "trip_id") -> DataFrame:
    """``n_rows`` and ``distinct_ids``; equal when the id is unique. An exact distinct count
    (approximate sketches cannot prove uniqueness)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(id_col).alias("distinct_ids"))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: ``(column_name, null_count, n_rows)``, from a single aggregate pass."""
    aggs = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    pairs = ", ".join(f"'{c}', n{i}" for i, c in enumerate(df.columns))
    return one.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, null_count)", "n_rows")
