import hashlib
import random
from itertools import permutations

import numpy as np

from llm_helpers import odd
from tripstar.llm import filter_audit as A

LABELS = [(1, 1, 0), (1, 0, 1), (2, None, None), (5, 0, 1), (None, 1, 1), (99, 1, 1)]
LABEL_SCHEMA = "doc_id long, quality int, toxic int, id int, good string"


def _labels(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], LABEL_SCHEMA)


def _brute(docs, labels):
    lowest = {}
    for i, text, *_ in docs:
        if i is not None:
            t = text or ""
            lowest[t] = min(lowest.get(t, i), i)
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, x in labels if x == 1}
    rows = {}
    for i, text, lang, *_ in docs:
        t = text or ""
        words = t.encode().split()
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and lowest[t] < i}
        rows.setdefault(lang or "", []).append(({f for f in fails if fails[f]}, i is not None and i in good, i is not None and i in toxic))
    out = {}
    for part, found in rows.items():
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = found
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                removed_by[f] += len(gone)
                fails = sum(f in r[0] for r in found)
                out[(part, "".join(order), step)] = [len(left), len(gone), fails - len(gone), sum(r[0] == {f} for r in found),
                                                     sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return out


def _got(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


def test_odd_rows(spark):
    assert _got(A.audit_documents(odd.odd_docs(spark), _labels(spark, LABELS))) == _brute(odd.ROWS, LABELS)
    assert A.audit_documents(odd.no_docs(spark), _labels(spark, [])).count() == 0
    assert _got(A.audit_documents(odd.odd_docs(spark), _labels(spark, []))) == _brute(odd.ROWS, [])


def test_against_brute_force_with_small_chunks(spark):
    rng = random.Random(3)
    texts = ["word " * 250, "WORD two " * 130, " ".join(f"w{i}" for i in range(220)), "a $ b", "", None, "copy of a text", " ".join(f"W{i}%" for i in range(300))]
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["en", "de", None, ""]), "a", 1) for _ in range(300)]
    labels = [(rng.randrange(45), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(30)]
    df = spark.createDataFrame(docs, odd.SCHEMA).repartition(3)
    for rows in (1 << 16, 7):
        assert _got(A.audit_documents(df, _labels(spark, labels), rows)) == _brute(docs, labels)


def test_posting_lists_hold_the_failing_ids(spark):
    docs = [(i, "x" if i % 3 else "a # b", "en", "a", 1) for i in range(50)]
    flags = A.later_copies(A.corpus_flags(spark.createDataFrame(docs, odd.SCHEMA)))
    lists = A.posting_lists(A.with_labels(flags, _labels(spark, [(3, 1, 0)])).coalesce(1), list("ABCDE"), 20).collect()
    assert [r.n for r in lists] and sum(r.n for r in lists) == 50 and max(r.n for r in lists) <= 20
    for r in lists:
        assert r.ids == sorted(r.ids) and (r.low, r.high) == (r.ids[0], r.ids[-1])
    assert sorted(r.ids[p] for r in lists for p in r.D) == list(range(0, 50, 3))
    assert sorted(r.ids[p] for r in lists for p in r.E) == [i for i in range(50) if i not in (0, 1)]
    assert [r.ids[p] for r in lists for p in r.good] == [3]


def test_galloping_set_operations():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, rng.integers(1, 300), rng.integers(0, 120))).astype(np.int32) for _ in range(2))
        assert (A.gallop(a, b) == np.isin(a, b)).all()
        assert A.common(a, b).tolist() == np.intersect1d(a, b).tolist()
        assert A.without(a, b).tolist() == np.setdiff1d(a, b).tolist()
        assert A.union(a, b).tolist() == np.union1d(a, b).tolist()


def test_digest_is_of_the_text(spark):
    row = A.corpus_flags(odd.odd_docs(spark)).filter("id = 8").first()
    assert bytes(row.digest) == hashlib.sha256(b"***").digest()
