import duckdb
import numpy as np
from conftest import SF_SMALL

from llm_helpers import odd
from tripstar.llm import quality as Q
from tripstar.llm.registry import QUERIES
from tripstar.llm.oracles import ORACLE_SQL


def test_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.execute(ORACLE_SQL["op1_quality_rules"]).df()
    got = QUERIES["op1_quality_rules"](spark, SF_SMALL).toPandas()
    key = sorted(want.columns)
    assert sorted(map(tuple, got[key].astype(str).values)) == sorted(map(tuple, want[key].astype(str).values))


def test_repeated_words_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        ids = rng.integers(0, 4, rng.integers(0, 30))
        windows = [tuple(ids[i:i + 3]) for i in range(len(ids) - 2)]
        covered = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
        assert Q.repeated_words(ids.astype(np.int64), 4) == len(covered)


def test_duplicate_lines():
    assert Q.duplicate_lines(b"a\nb\na\n\n\n \n \nb ") == 1
    assert Q.duplicate_lines(b"") == 0


def test_odd_rows(spark):
    docs = odd.odd_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = Q.quality_rules(docs, labels).collect()
    assert len(rows) == len(odd.ROWS)
    for r in rows:
        if not r.n_words:
            assert r.base_failed and not r.kept and r.n_ngrams == r.llr_fixed == 0
    assert len({tuple(r) for r in rows if r.doc_id == 1}) == 1
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    assert Q.quality_rules(odd.no_docs(spark), labels).count() == 0
    # without labels the base rules alone decide
    alone = Q.quality_rules(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in alone)


def test_trusted_sample_is_bounded(spark):
    labels = spark.range(10_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    n = Q.trusted_ids(labels, 1000).count()
    assert 800 < n < 1200
    assert Q.trusted_ids(labels, 10_000).count() == 10_000
