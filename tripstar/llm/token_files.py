"""Token files: whole texts as token ids in Parquet list columns, made for selective reads.

The files hold one row per document in ascending order of the id: the id, ``shard`` (the writing task),
``first`` (ids before it in the shard), ``n_tokens`` and ``tokens``, a list of ids. Id lists have a
dictionary (a vocabulary is small, so an id takes as many bits as the page's dictionary needs) or are
delta encoded; the ascending columns are always delta encoded. Row groups and pages are of stated size,
and every page has its bounds in the page index, so a range of documents is read from its own pages and
a scan of the metadata never touches the ids.

One shuffle brings texts into order of the id (a range partitioning with a row number as the last key, so
that documents of one id and even copies may be split over shards); the shards are then encoded and
written where they are. The number of ids before a document in all shards follows from the shards' totals,
one row per shard, added up by Spark from the metadata columns alone; the sums are kept beside the files.

Defined cases: a null or empty text is the end id alone; null ids come first; repeated rows are written
once each; equal ids are in order of their texts' hash; very long texts are one list each; an empty table
gives files without rows; columns besides the id and the text are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstar.llm.common import materialise
from tripstar.llm.encoding import process_tokenizer

END_ID = 2
# Bytes of a row group and rows of a page: what one selective read has to take in.
ROW_GROUP_BYTES, PAGE_ROWS = 16 << 20, 1000
# Texts encoded at a time.
TEXTS = 256


def writer_options(encoding: str = "dictionary", row_group_bytes: int = ROW_GROUP_BYTES, page_rows: int = PAGE_ROWS,
                   id_col: str = "doc_id") -> dict[str, str]:
    """Parquet options of the token files. ``encoding`` is that of the ids, ``dictionary`` or ``delta``."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding must be 'dictionary' or 'delta', got {encoding!r}")
    columns = {id_col: False, "shard": True, "first": False, "n_tokens": False, "tokens.list.element": encoding == "dictionary"}
    return {
        "compression": "zstd",
        "parquet.writer.version": "v2",  # integers without a dictionary are delta encoded
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        **{f"parquet.enable.dictionary#{c}": str(on).lower() for c, on in columns.items()},
    }


def encode(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, shard, first, n_tokens, tokens) of every document, in ascending order over the partitions."""
    # the row number is a function of the input's partitions, so a task that runs again gives it again
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"),
                        F.monotonically_increasing_id().alias("row"))
    ordered = keyed.repartitionByRange("id", "tie", "row").sortWithinPartitions("id", "tie", "row").select("id", "text")
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, shard int, first long, n_tokens long, tokens array<int>"

    def run(batches):
        coder, shard, first = process_tokenizer(tokenizer), TaskContext.get().partitionId(), 0
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                part = whole.slice(at, TEXTS)
                ids, n = coder.encode_flat(part.column(1), end_id)
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32)))
                columns = [part.column(0), pa.array(np.full(len(n), shard, np.int32)), pa.array(first + ends - n), pa.array(n), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "shard", "first", "n_tokens", "tokens"])
                first += int(ends[-1])

    return ordered.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, encoding: str = "dictionary",
                 row_group_bytes: int = ROW_GROUP_BYTES, page_rows: int = PAGE_ROWS, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Token files at ``path``/ids and the ids before each shard at ``path``/shards. Starts two jobs."""
    options = writer_options(encoding, row_group_bytes, page_rows, id_col)
    written = materialise(encode(docs, tokenizer, end_id, id_col, text_col), "ids", f"{path}/ids", **options)
    totals = written.groupBy("shard").agg(F.sum("n_tokens").alias("total"), F.count(F.lit(1)).alias("n_docs"),
                                          F.min(id_col).alias("lowest"), F.max(id_col).alias("highest"))
    # one row per writing task
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals.withColumn("before", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{path}/shards")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The id, ``start`` (ids of all documents before it) and ``n_tokens`` of every document; the ids are not read."""
    return _placed(spark, path).drop("tokens")


def read_tokens(spark: SparkSession, path: str, low=None, high=None, id_col: str = "doc_id") -> DataFrame:
    """As :func:`read_metadata`, with ``tokens``; of the documents with ``low`` <= id <= ``high`` if these
    are given, from the pages that can hold them."""
    rows = _placed(spark, path)
    if low is not None:
        rows = rows.filter(F.col(id_col) >= low)
    if high is not None:
        rows = rows.filter(F.col(id_col) <= high)
    return rows


def _placed(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(f"{path}/ids")
    # one row per shard: files of some MB at least, so a thousandth of the data at most
    shards = spark.read.parquet(f"{path}/shards").select("shard", "before")
    keep = [c for c in rows.columns if c not in ("shard", "first", "n_tokens", "tokens")]
    return rows.join(shards, "shard").select(*keep, (F.col("before") + F.col("first")).alias("start"), "n_tokens", "tokens")


def id_checksums(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32): the CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    schema = f"id {tokens.schema[id_col].dataType.simpleString()}, start long, n_tokens long, ids_crc32 long"

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            view = memoryview(np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), dtype="<u4")).cast("B")
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)) * 4
            begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            crc = [zlib.crc32(view[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())],
                                             names=["id", "start", "n_tokens", "ids_crc32"])

    picked = tokens.select(F.col(id_col).alias("id"), "start", "n_tokens", "tokens")
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id_col)
