"""Helpers shared by the corpus operators: table access, scratch tables and Arrow plumbing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tripstar.paths import scratch_path

# Rows handed to one call of a batch function; a very long text only ever shares memory with this many.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Removes the shuffle files of a finished query at once.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries that run inside leave no shuffle files behind; the session's setting comes back after."""
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


def materialise(df: DataFrame, name: str, path: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder (or to ``path``) and read it back: later readers do not
    recompute it, and the files outlive any executor. ``options`` go to the Parquet writer."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"llm-{name}")
    with shuffles_removed(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def strings(array: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, None for nulls."""
    return array.cast(pa.binary()).to_pylist()


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list] | None], schema: str,
                binary: tuple[str, ...] = ("text",)) -> DataFrame:
    """``fn`` gets a dict of column lists (columns in ``binary`` as UTF-8 bytes) for at most
    SLICE_ROWS rows and returns a dict of output columns (or None)."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                part = whole.slice(at, SLICE_ROWS)
                cols = {n: strings(part.column(i)) if n in binary else part.column(i).to_pylist()
                        for i, n in enumerate(part.schema.names)}
                if out := fn(cols):
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def text_column(name: str = "text"):
    """A text column with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))
