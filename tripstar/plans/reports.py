"""The dashboard reports as SQL views over the published gold tables.

BI tools and SQL users query views; each view is the lazy DataFrame of one report function
over the catalog tables, so every query against it is planned afresh by Catalyst (partition
pruning, broadcast dimensions) on the current data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.operators import metrics as M
from tripstar.operators.geo import rides_by_cell


def gold_tables(spark: SparkSession, database: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(fact_rides, dim_date, dim_zone)`` from the catalog."""
    return (spark.table(f"{database}.fact_rides"), spark.table(f"{database}.dim_date"),
            spark.table(f"{database}.dim_zone"))


REPORTS: dict[str, Callable[[DataFrame, DataFrame, DataFrame], DataFrame]] = {
    "kpi_totals": lambda f, d, z: M.kpi_totals(f),
    "daily_rides_trend": lambda f, d, z: M.daily_rides_trend(f, d),
    "rides_by_hour": lambda f, d, z: M.rides_by_hour(f),
    "rides_by_provider": lambda f, d, z: M.rides_by_provider(f),
    "rides_by_pickup_zone": lambda f, d, z: M.rides_by_pickup_zone(f, z),
    "rides_by_zone_pair": lambda f, d, z: M.rides_by_zone_pair(f, z),
    "rides_by_weekday_flag": lambda f, d, z: M.rides_by_weekday_flag(f, d),
    "rides_by_cell": lambda f, d, z: rides_by_cell(f, z),
    "fact_orphan_keys": lambda f, d, z: M.fact_orphan_keys(f, d, z),
}


# Reports that the pre-aggregates answer as well, when no dates are given.
FROM_PREAGGREGATES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rides_by_hour": lambda spark, db: spark.table(f"{db}.agg_trips_by_hour").select("pickup_hour", "rides").orderBy("pickup_hour"),
    "rides_by_provider": lambda spark, db: spark.table(f"{db}.agg_trips_by_company").select(
        "hvfhs_license_num", "rides").orderBy(F.desc("rides"), "hvfhs_license_num"),
}


# Views that sessions have registered: (application, database) -> prefix -> range of dates.
_registered: dict[tuple[str, str], dict[str, tuple[str | None, str | None]]] = {}


def refresh_report_views(spark: SparkSession, database: str) -> None:
    """Register the report views of this application anew: a temporary view keeps the directories of the
    dimensions that it was planned with, and a publish gives them others."""
    for prefix, (start, end) in _registered.get((spark.sparkContext.applicationId, database), {}).items():
        register_report_views(spark, database, prefix, start, end)


def register_report_views(spark: SparkSession, database: str, prefix: str = "",
                          start: str | None = None, end: str | None = None) -> list[str]:
    """Create or replace a temporary view per report (``<prefix><report>``) over the gold
    tables of ``database``; returns the view names. ``start`` / ``end`` (ISO dates) scope every
    view to a pickup-date range through partition filters, so only those day directories are
    read; without them the pre-aggregate tables answer what they can without the fact table."""
    fact, dim_date, dim_zone = gold_tables(spark, database)
    scoped = start is not None or end is not None
    fact = M.for_dates(fact, start, end)
    names = []
    for name, build in REPORTS.items():
        df = FROM_PREAGGREGATES[name](spark, database) if not scoped and name in FROM_PREAGGREGATES else build(fact, dim_date, dim_zone)
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    for name in M.PREAGGREGATES:
        df = M.agg_trips(fact, M.PREAGGREGATES[name]) if scoped else spark.table(f"{database}.{name}")
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    _registered.setdefault((spark.sparkContext.applicationId, database), {})[prefix] = (start, end)
    return names
