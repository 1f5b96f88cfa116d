import glob
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from llm_helpers import odd
from tripstar.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")


def _want(rows):
    """Ascending ids, nulls first; rows of one id in any order."""
    plain = Tokenizer.from_file(PATH)
    return [(i, tuple(plain.encode(t or "", add_special_tokens=False).ids + [2])) for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_odd_rows_round_trip(spark, tmp_dir, encoding):
    T.write_tokens(odd.odd_docs(spark), f"{tmp_dir}/t", PATH, encoding=encoding)
    rows = sorted(T.read_tokens(spark, f"{tmp_dir}/t").collect(), key=lambda r: r.start)
    want = _want(odd.ROWS)
    assert [r.doc_id for r in rows] == [i for i, _ in want]
    assert sorted((str(r.doc_id), tuple(r.tokens)) for r in rows) == sorted((str(i), x) for i, x in want)
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.tokens))
        at += r.n_tokens
    sums = {(r.start, r.ids_crc32) for r in T.id_checksums(T.read_tokens(spark, f"{tmp_dir}/t")).collect()}
    assert sums == {(r.start, zlib.crc32(np.array(r.tokens, "<u4").tobytes())) for r in rows}


def test_no_rows(spark, tmp_dir):
    T.write_tokens(odd.no_docs(spark), f"{tmp_dir}/t", PATH)
    assert T.id_checksums(T.read_tokens(spark, f"{tmp_dir}/t")).count() == 0
    assert T.read_metadata(spark, f"{tmp_dir}/t").columns == ["doc_id", "start", "n_tokens"]


def test_encodings_row_groups_and_page_index(spark, tmp_dir):
    docs = spark.range(6000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 60), i -> concat('w', (id * 7 + i * i) % 997))) AS text").repartition(4)
    seen = {}
    for encoding in ("dictionary", "delta"):
        path = f"{tmp_dir}/{encoding}"
        T.write_tokens(docs, path, PATH, encoding=encoding, row_group_bytes=200_000, page_rows=100)
        for f in glob.glob(f"{path}/ids/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            assert meta.num_rows < 700 or meta.num_row_groups > 1
            for g in range(meta.num_row_groups):
                by_name = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i) for i in range(meta.num_columns)}
                assert all(c.has_offset_index and c.has_column_index for n, c in by_name.items() if n != "tokens.list.element")
                assert "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings
                seen.setdefault(encoding, set()).update(by_name["tokens.list.element"].encodings)
    assert "RLE_DICTIONARY" in seen["dictionary"] and "DELTA_BINARY_PACKED" not in seen["dictionary"]
    assert "DELTA_BINARY_PACKED" in seen["delta"] and "RLE_DICTIONARY" not in seen["delta"]
    # a range of documents and the metadata are read by themselves
    some = T.read_tokens(spark, f"{tmp_dir}/delta", 1000, 1009)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,1000)" in plan and "LessThanOrEqual(doc_id,1009)" in plan
    assert sorted(r.doc_id for r in some.collect()) == list(range(1000, 1010))
    plan = T.read_metadata(spark, f"{tmp_dir}/delta")._jdf.queryExecution().executedPlan().toString()
    assert "array<int>" not in plan


def test_one_id_is_split_over_shards(spark, tmp_dir):
    docs = spark.range(4000).selectExpr("7L AS doc_id", "'one text of many' AS text").repartition(4)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        T.write_tokens(docs, f"{tmp_dir}/t", PATH)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    shards = spark.read.parquet(f"{tmp_dir}/t/shards").collect()
    assert len(shards) == 5 and max(r.n_docs for r in shards) < 1200
    starts = sorted(r.start for r in T.read_metadata(spark, f"{tmp_dir}/t").collect())
    assert starts == list(range(0, 4000 * 5, 5))
