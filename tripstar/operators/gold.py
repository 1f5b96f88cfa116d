"""Gold star schema builders: ``fact_rides`` (map-only projection), ``dim_date`` and ``dim_zone``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar import schemas
from tripstar.functions.columns import date_key
from tripstar.operators.standardise import conform


def fact_rides(silver: DataFrame) -> DataFrame:
    """One row per ride: ``date_key`` (yyyyMMdd INT) and ``pickup_hour`` added, 14 columns.
    No shuffle: scan -> project."""
    fact = silver.withColumns({"date_key": date_key("start_time"), "pickup_hour": F.hour("start_time")})
    return conform(fact, schemas.FACT_RIDES)


def dim_date(rides: DataFrame, time_col: str = "start_time", spine: bool = False) -> DataFrame:
    """One row per observed pickup date (``spine=True``: every date between the first and the
    last one). The distinct is a partial aggregate, so only the few distinct dates shuffle."""
    dates = rides.select(F.to_date(time_col).alias("full_date")).distinct()
    if spine:
        bounds = dates.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))
        dates = bounds.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    d = F.col("full_date")
    return dates.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_zone(zone_reference: DataFrame) -> DataFrame:
    """The 9 dimension columns, in order, typed as declared."""
    return conform(zone_reference.select([
        F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.DIM_ZONE.fields
    ]), schemas.DIM_ZONE)
