"""File readers and writers for every layer."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar import schemas
from tripstar.operators.geo import standardise_zone_lookup


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Monthly bronze files under ``path``.

    With ``schema`` no footer is read. Without it the schema is discovered by merging the footers:
    columns that came later are NULL in older files, and declared columns are read through the
    declared types, so that int/long drift between files does no harm."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.schema(evolved_schema(spark, path)).parquet(path)


def evolved_schema(spark: SparkSession, path: str) -> T.StructType:
    """The declared bronze columns, then every other column found in any file, then the partition
    columns. If footers cannot be merged (a column's type drifted), the landing partitions are looked
    at one by one; their number is bounded by the calendar."""
    try:
        found = [spark.read.option("mergeSchema", True).parquet(path).schema]
    except AnalysisException:
        raise
    except Exception:  # noqa: BLE001 - footers that do not merge fail in a Spark job
        fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        parts = [s.getPath().toString() for s in fs.listStatus(fs_path) if not s.getPath().getName().startswith(("_", "."))]
        found = [spark.read.option("basePath", path).parquet(p).schema for p in sorted(parts)]
    declared = {f.name: f for f in schemas.BRONZE_RIDES}
    extra = {f.name: f for s in found for f in s if f.name not in declared}
    return T.StructType([*declared.values(), *extra.values()])


def read_partition_glob(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Scan ``root/<glob>`` (e.g. ``year=2024/*``) keeping the partition columns: ``basePath``
    tells partition discovery where the table starts."""
    return spark.read.option("basePath", root).parquet(f"{root.rstrip('/')}/{glob}")


def read_with_source_file(spark: SparkSession, path: str) -> DataFrame:
    """Single file or directory scan plus a ``source_file`` provenance column."""
    df = spark.read.parquet(path)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def _csv(spark: SparkSession, schema: T.StructType | None, null_value: str | None = None):
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.schema(schema) if schema is not None else reader


def read_zone_reference_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone reference CSV (header; ``"`` both quote and escape, as the GeoJSON cells hold
    commas and doubled quotes), read through a declared schema without an inference pass.
    ``h3_resolution`` may be written as ``8`` or ``8.0``; it is read as a number and cast to INT."""
    as_read = T.StructType([T.StructField(f.name, T.DoubleType() if f.name == "h3_resolution" else f.dataType) for f in schemas.DIM_ZONE])
    return _csv(spark, as_read).csv(path).withColumn("h3_resolution", F.col("h3_resolution").cast("int"))


def write_zone_reference_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .csv(path))


def read_zone_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """Published zone lookup CSV -> standardised ``location_id, borough, zone_name,
    service_zone`` (``N/A`` -> NULL)."""
    raw = _csv(spark, T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.ZONE_LOOKUP.fields])).csv(path)
    return standardise_zone_lookup(raw)


def write_text_lines(df: DataFrame, column: str, path: str) -> None:
    """One line per row of a single string column."""
    df.select(column).write.mode("overwrite").text(path)


def read_csv_as_strings(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column as text (exploration / landing checks)."""
    return spark.read.option("header", True).csv(path)


# Zone centroid table of the enrichment variant: id and point, no geometry.
ZONE_CENTROIDS = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])


def read_zone_centroids_csv(spark: SparkSession, path: str) -> DataFrame:
    """``LocationID, lat, lon`` CSV -> ``location_id, centroid_lat, centroid_lon`` through a
    declared schema (no inference pass over the file)."""
    df = _csv(spark, ZONE_CENTROIDS).csv(path)
    return df.withColumnsRenamed({"LocationID": "location_id", "lat": "centroid_lat", "lon": "centroid_lon"})
