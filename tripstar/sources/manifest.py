"""Source manifest: one download URL per month, January of the start year through December of
the end year, inclusive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Public TLC trip-record location and file naming.
TLC_FHVHV_BASE_URL = "https://d37ci6vzurychx.cloudfront.net/trip-data/fhvhv_tripdata_"
FILE_SUFFIX = ".parquet"


def monthly_source_manifest(bounds: DataFrame, base_url: str = TLC_FHVHV_BASE_URL) -> DataFrame:
    """``bounds`` has ``start_year`` and ``end_year`` (one or more rows); returns ``url`` and
    ``source_month`` (``yyyy-MM``) per month. A row with start > end fails the job."""
    s, e = F.col("start_year").cast("int"), F.col("end_year").cast("int")
    checked = bounds.select(
        F.when(s > e, F.raise_error(F.lit("start_year must be <= end_year"))).otherwise(s).alias("s"), e.alias("e"))
    months = checked.select(F.explode(F.sequence(
        F.make_date("s", F.lit(1), F.lit(1)), F.make_date("e", F.lit(12), F.lit(1)), F.expr("INTERVAL 1 MONTH"),
    )).alias("m"))
    ym = F.date_format("m", "yyyy-MM")
    return months.select(F.concat(F.lit(base_url), ym, F.lit(FILE_SUFFIX)).alias("url"), ym.alias("source_month"))


def manifest_for_years(spark: SparkSession, start_year: int, end_year: int,
                       base_url: str = TLC_FHVHV_BASE_URL) -> DataFrame:
    if start_year > end_year:
        raise ValueError("start_year must be <= end_year")
    bounds = spark.range(1).select(F.lit(start_year).alias("start_year"), F.lit(end_year).alias("end_year"))
    return monthly_source_manifest(bounds, base_url)
