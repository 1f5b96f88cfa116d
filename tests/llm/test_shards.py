import random

from llm_helpers import odd
from tripstar.llm import shards as S


def test_tree_finds_the_tightest_bin():
    rng = random.Random(5)
    tree, plain = S.CapacityTree(), []
    for i in range(500):
        if rng.random() < 0.6 or not plain:
            item = (rng.randrange(50), i)
            tree.add(*item)
            plain.append(item)
        else:
            size = rng.randrange(60)
            want = min((x for x in plain if x[0] >= size), default=None)
            assert tree.take(size) == want
            if want:
                plain.remove(want)


def test_best_fit_decreasing_and_equal_shards():
    rng = random.Random(1)
    sizes = sorted((rng.randrange(1, 100) for _ in range(400)), reverse=True)
    bins = S.best_fit_decreasing(sizes, 200)
    load = [sum(s for s, b in zip(sizes, bins, strict=True) if b == k) for k in set(bins)]
    assert max(load) <= 200 and len(load) <= -(-sum(sizes) // 200) + 2
    bins = S.equal_shards(sizes, 24)
    load = [sum(s for s, b in zip(sizes, bins, strict=True) if b == k) for k in range(24)]
    assert max(load) - min(load) <= 20
    bins = S.equal_shards([10_000, 5000, *sizes], 24)  # two hot groups take a bin each
    assert bins.count(0) == bins.count(1) == 1
    load = [sum(s for s, b in zip(sizes, bins[2:], strict=True) if b == k) for k in range(2, 24)]
    assert max(load) - min(load) <= 20
    assert S.best_fit_decreasing([500, 3], 100) == [0, 1] and S.equal_shards([], 3) == []


def test_odd_rows(spark):
    docs = odd.odd_docs(spark)
    rows = S.assign_shards(docs, shards=4).collect()
    assert len(rows) == len(odd.ROWS)
    for k in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1  # equal texts stay together
    assert all(r.size == 8 and r.text_crc32 == 0 for r in rows if r.doc_id in (2, 3))
    assert S.assign_shards(odd.no_docs(spark)).count() == 0
    fixed = S.assign_shards(docs, capacity=1000).collect()
    small = [r for r in fixed if r.size < 1000]
    for k in {r.shard for r in small}:
        assert sum(r.size for r in small if r.shard == k) <= 1000
