import hashlib

import numpy as np
import pytest

from llm_helpers import odd
from tripstar.llm import passages as R


def _brute(texts, length):
    seen = {}
    for t in texts:
        for s in range(len(t) - length + 1):
            seen[t[s:s + length]] = seen.get(t[s:s + length], 0) + 1
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if seen[t[s:s + length]] > 1:
                mark[s:s + length] = b"\1" * length
        out.append((bytes(c for c, m in zip(t, mark, strict=True) if not m), sum(mark), sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))))
    return out


def _corpus(seed):
    rng = np.random.default_rng(seed)
    letters = np.frombuffer(b"abcd", np.uint8)
    shared = [bytes(rng.choice(letters, n)) for n in (25, 40, 90, 60)]
    texts = [b"", b"a" * 19, b"a" * 20, b"ab" * 60, b"x" * 50]
    for _ in range(60):
        t = b""
        for _ in range(rng.integers(1, 5)):
            t += bytes(rng.choice(letters, rng.integers(0, 40)))
            p = shared[rng.integers(len(shared))]
            a, b = sorted(rng.integers(0, len(p) + 1, 2))
            t += p[a:b] if rng.random() < 0.5 else p
        texts.append(t)
    return texts + texts[8:11] + [shared[3] * 3]


@pytest.mark.parametrize("reach_bits", [2, 3])
def test_removal_against_brute_force(spark, reach_bits):
    length = 20
    texts = _corpus(reach_bits)
    want = _brute(texts, length)
    keyed = spark.createDataFrame([(i, i % 5, t.decode()) for i, t in enumerate(texts)], "id long, th long, text string")
    spans = {r.id: [s.asDict() for s in r.spans] for r in R.repeated_spans(keyed, length, trigger=4, reach_bits=reach_bits, block_bits=1).collect()}
    for i, t in enumerate(texts):
        kept, runs = R.remove_spans(t, spans.get(i))
        assert (kept, len(t) - len(kept), runs) == want[i], i


def test_odd_rows(spark):
    docs = odd.odd_docs(spark)
    rows = R.remove_repeats(docs).collect()
    assert len(rows) == len(odd.ROWS)
    want = _brute([(t or "").encode()[:5000] for _, t, *_ in odd.ROWS], 400)
    for r in rows:
        text = next((t or "").encode() for i, t, *_ in odd.ROWS if i == r.doc_id and (i is not None or len((t or "").encode()) == r.n_bytes))
        assert r.n_bytes == len(text) and r.n_removed == r.n_bytes - len(r.kept) and r.kept_sha256 == hashlib.sha256(r.kept).hexdigest()
        if r.doc_id == 5:  # a text that repeats itself all along
            assert (r.n_removed, r.n_spans) == (len(text), 1)
        elif r.doc_id != 1:
            assert r.n_removed == 0
    assert all(w[1] in (0, len(odd.LONG[:5000])) for w in want)
    assert R.remove_repeats(odd.no_docs(spark)).count() == 0


def test_query_against_every_string_of_the_documents(spark):
    """The whole table of one size: every 400-byte string that starts twice goes, planted passages with it (those of over
    50 words that are shorter than 400 bytes hold no such string and stay)."""
    import pyarrow.parquet as pq

    from tripstar.llm.registry import QUERIES

    sf, length = "/root/testdata/sf0.01", R.LENGTH
    texts = [(t or "").encode() for t in pq.read_table(f"{sf}/documents.parquet").sort_by("doc_id").column("text").to_pylist()]
    seen = {}
    for t in texts:
        for s in range(len(t) - length + 1):
            key = hash(t[s:s + length])
            seen[key] = seen.get(key, 0) + 1
    want = []
    for t in texts:
        mark = np.zeros(len(t) + 1, np.int64)
        for s in range(len(t) - length + 1):
            if seen[hash(t[s:s + length])] > 1:
                mark[s] += 1
                mark[s + length] -= 1
        gone = np.cumsum(mark)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        want.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    rows = sorted(QUERIES["op7_repeated_passages"](spark, sf).collect(), key=lambda r: r.doc_id)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == want
    assert sum(w[1] > 0 for w in want) > 100


def test_a_hot_phrase_is_joined_in_many_parts(spark):
    """One passage in all of 400 documents, between texts of their own: no join meets its phrases, blocks or strings in one part."""
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefgh", np.uint8)
    passage = bytes(rng.choice(letters, 120))
    texts = [bytes(rng.choice(letters, 30)) + passage + bytes(rng.choice(letters, 30)) for _ in range(400)]
    keyed = spark.createDataFrame([(i, i, t.decode()) for i, t in enumerate(texts)], "id long, th long, text string")
    shared = R.repeated(R.phrases(keyed, 20, 4, 2), ("k1",), "a").localCheckpoint()
    salted, seen = R.dealt(shared, R.ENTRY, "lo")
    hottest = seen.orderBy("n", ascending=False).first()
    assert hottest.n >= 400 and bin(hottest.parts).count("1") == R.SALTS
    assert sorted(map(tuple, R.among(salted, R.ENTRY, seen.filter("n > 1")).select(*shared.columns).collect())) == sorted(
        map(tuple, shared.join(seen.filter("n > 1"), list(R.ENTRY), "left_semi").select(*shared.columns).collect()))
    spans = R.repeated_spans(keyed, 20, trigger=4, reach_bits=2, block_bits=1)
    plan = spans._jdf.queryExecution().toString().split("== Physical Plan ==")[0]
    joins = [line for line in plan.splitlines() if "Join LeftSemi" in line and ("(ka" in line or "(ha" in line)]
    assert joins and all("salt" in line for line in joins)
    assert not [line for line in plan.splitlines() if "Join Inner" in line and "(ka" in line]
    got = {r.id: [s.asDict() for s in r.spans] for r in spans.collect()}
    for i, (t, want) in enumerate(zip(texts, _brute(texts, 20), strict=True)):
        kept, runs = R.remove_spans(t, got.get(i))
        assert (kept, len(t) - len(kept), runs) == want
