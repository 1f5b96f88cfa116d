"""Watched-directory landing: every new Parquet file below ``landing_dir`` is appended to bronze
exactly once (the file source records processed files in the checkpoint). ``availableNow``
processes what is there and stops, so the job runs on the monthly schedule like a batch job but
never re-ingests a file, and survives restarts through its checkpoint."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar.plans.lake import _fs, read_text

# The file sink's log of committed batches.
SINK_LOG = "_spark_metadata"


def sink_batches(spark: SparkSession, sink_dir: str) -> dict[int, str]:
    """The batches that the file sink has committed: number -> name of its log file."""
    fs, path = _fs(spark, f"{sink_dir}/{SINK_LOG}")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return {int(n.split(".")[0]): n for n in names if n.split(".")[0].isdigit()}


def files_since(spark: SparkSession, sink_dir: str, batch: int) -> list[str]:
    """Files of the batches after ``batch``, from the sink's own log. Now and then the sink rewrites the names of all
    its files into one log file; only then are older names read, to tell the last batch's from them."""
    batches = sink_batches(spark, sink_dir)

    def logged(names: list[str]) -> set[str]:
        # Spark's readers pass over the log's folder; the sink itself reads these names in the driver, too
        lines = [x for n in names for x in read_text(spark, f"{sink_dir}/{SINK_LOG}/{n}").splitlines()]
        return {json.loads(x)["path"] for x in lines if x.startswith("{")}

    new = sorted(b for b in batches if b > batch)
    found = logged([batches[b] for b in new if batches[b].isdigit()])
    whole = [b for b in new if not batches[b].isdigit()]
    if whole:
        # the last rewritten log has every file up to its batch; what the batches until ``batch`` had goes
        start = max((b for b in batches if b <= batch and not batches[b].isdigit()), default=-1)
        found |= logged([batches[whole[-1]]]) - logged([batches[b] for b in batches if start <= b <= batch])
    return sorted(found)


def land_new_files(spark: SparkSession, landing_dir: str, bronze_dir: str, checkpoint_dir: str,
                   schema: T.StructType, max_files_per_trigger: int | None = None) -> int:
    """Append unseen landing files to ``bronze_dir`` (with ``source_file``); returns the number of rows
    appended by this run, from the footers of the files that its batches have committed. The cost follows the new
    files, not the history of bronze."""
    landed = T.StructType([*schema.fields, T.StructField("source_file", T.StringType())])
    before = max(sink_batches(spark, bronze_dir), default=-1)
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_dir).withColumn("source_file", F.col("_metadata.file_path"))
    query = (stream.writeStream.format("parquet").option("path", bronze_dir)
             .option("checkpointLocation", checkpoint_dir).outputMode("append")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    new = files_since(spark, bronze_dir, before)
    return spark.read.schema(landed).parquet(*new).count() if new else 0
