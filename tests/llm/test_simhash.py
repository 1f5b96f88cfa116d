import numpy as np
import xxhash

from llm_helpers import odd
from tripstar.llm import simhash as S


def _components(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_links_at_every_level_against_brute_force(spark):
    rng = np.random.default_rng(3)
    prints = set()
    for _ in range(12):
        base = int(rng.integers(0, 1 << 62))
        for _ in range(30):  # near copies at 0 to 5 bits
            x = base
            for b in rng.integers(0, 63, rng.integers(0, 6)):
                x ^= 1 << int(b)
            prints.add(x)
    # a dense list: many prints that differ in two bytes only
    prints |= {int(x) for x in rng.integers(0, 1 << 16, 400)}
    want = _components(prints)
    classes = spark.createDataFrame([(p,) for p in prints], "fp long")
    for limit in (512, 6):  # with short lists only, and with every finer index in use
        roots = {r.node: r.root for r in S.connected(S.class_links(classes, max_list=limit)).collect()}
        assert {p: roots.get(p, p) for p in prints} == want


def test_long_chain(spark):
    links = spark.range(60).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in S.connected(links).collect()} == {0}


def test_fingerprint_against_brute_force():
    for text in (b"", b"one", b"One two", b"a B c d e f a b c", "Ünï x y z".encode()):
        words = text.lower().split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        assert S.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_odd_rows(spark):
    docs = odd.odd_docs(spark)
    rows = S.near_duplicates(docs).collect()
    assert len(rows) == len(odd.ROWS)
    zero = [r for r in rows if r.fp == 0]
    assert {r.component_id for r in zero} == {2} and len(zero) == 4  # null, empty, white space, null without id
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 5, 6, 7, 8] and ids.count(None) == 1
    assert S.near_duplicates(odd.no_docs(spark)).count() == 0


def test_one_row_of_each_component_stays(spark):
    texts = [" ".join(f"{w}{i}" for i in range(40)) for w in ("alpha", "beta", "gamma", "delta")]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[0]), (3, texts[1]),  # an id in two components
            (None, texts[2]), (None, texts[2]), (None, texts[2]),  # copies without ids
            (None, texts[3]), (9, texts[3]), (9, texts[3])]  # an id before none, a repeated row
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = S.near_duplicates(docs)
    assert found.select("fp").distinct().count() == 4
    kept = sorted(((r.text, r.doc_id) for r in S.keep_one(docs).collect()), key=str)
    assert kept == [(texts[0], 1), (texts[1], 1), (texts[3], 9), (texts[2], None)]
