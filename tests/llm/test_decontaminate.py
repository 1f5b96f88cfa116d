import random

from llm_helpers import odd
from tripstar.llm import decontaminate as D


def _least(pattern, text):
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        cur = [i]
        for j, d in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != d)))
        prev = cur
    return min(prev)


def test_myers_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        masks = {}
        for i, c in enumerate(p):
            masks[c] = masks.get(c, 0) | 1 << i
        assert D.least_distance(masks, len(p), t, 0, len(t))[0] == _least(p, t)


def test_matcher_against_brute_force():
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "tau"]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(6)]
    matcher = D.Matcher(items, 0.1)
    for _ in range(60):
        text = " ".join(rng.choices(words, k=10))
        if rng.random() < 0.7:
            item = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 9)):
                k = rng.randrange(len(item))
                item[k:k + 1] = rng.choice([[], ["x"], [item[k], "y"]])
            text = text[:30] + "".join(item) + text[30:]
        want = {i: _least(p, text) for i, p in items}
        got = {i: d for i, d, _ in matcher.find(text)}
        assert got == {i: d for i, d in want.items() if d <= int(len(dict(items)[i]) * 0.1)}


def test_blocks_and_odd_rows(spark):
    items = spark.createDataFrame([(1, "The QUICK brown fox, jumps over!"), (2, None), (3, "..."), (4, "wanderung wanderung"), (1, "The QUICK brown fox, jumps over!")],
                                  "item_id long, text string")
    docs = odd.odd_docs(spark)
    for size in (1, 10**6):  # a block for each item, and one for all
        rows = sorted((r.doc_id, r.item_id, r.distance) for r in D.find_leaks(docs, items, block_chars=size).collect())
        assert rows == [(1, 1, 0)] * 4 + [(5, 4, 0)]
    kept = D.drop_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(odd.ROWS) - 3
    assert D.drop_leaks(docs, items.limit(0)).count() == len(odd.ROWS) and D.find_leaks(docs, items.limit(0)).count() == 0
    assert D.find_leaks(odd.no_docs(spark), items).count() == 0
