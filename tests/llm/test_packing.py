import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from llm_helpers import odd
from tripstar.llm import encoding
from tripstar.llm import packing as P
from tripstar.llm.encoding import WordTokenizer, id_bytes

PATH = public_tokenizers.path("word_bpe_49k.json")


def _brute(totals, weights, k):
    """The first k tokens by virtual finishing time, with queues that run dry (phases)."""
    left, taken = list(totals), [0] * len(totals)
    order, done = [], [0] * len(totals)
    while any(left):
        live = [i for i, r in enumerate(left) if r]
        end = min(Fraction(2 * left[i] + 1, 2 * weights[i]) for i in live)
        phase = sorted((Fraction(2 * j + 1, 2 * weights[i]), i) for i in live for j in range(left[i]) if Fraction(2 * j + 1, 2 * weights[i]) < end)
        for _, i in phase:
            order.append(i)
            left[i] -= 1
    for i in order[:k]:
        taken[i] += 1
    del done
    return taken


def test_mixture_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(25):
        totals = rng.integers(0, 60, rng.integers(1, 6)).tolist()
        targets = None if rng.random() < 0.5 or not any(totals) else rng.integers(1, 9, len(totals)).tolist()
        mix = P.Mixture(totals, targets)
        points = np.arange(sum(totals) + 1)
        served = mix.served(points)
        weights = [int(w) for w in mix.weights]
        assert served.sum(axis=1).tolist() == points.tolist()
        assert (np.diff(served, axis=0) >= 0).all()
        for k in points[:: max(1, len(points) // 7)]:
            assert served[k].tolist() == _brute(totals, weights, int(k))


def test_windows_keep_the_target_shares():
    mix = P.Mixture([10_000, 30_000, 60_000])
    per_window = np.diff(mix.served(np.arange(0, 100_001, 1000)), axis=0)
    assert (abs(per_window - [100, 300, 600]) <= 1).all()


def test_word_tokenizer_is_the_tokenizer():
    texts = [r[1] for r in odd.ROWS if r[1] and len(r[1]) < 5000] + ["don't it's a_b 123abc!!", "x" * 300, "Ａｂ ﬁ ½", "école l'été", "ẞ ΣΣ"]
    plain = Tokenizer.from_file(PATH)
    coder = WordTokenizer(PATH)
    for _ in range(2):
        got = [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode([t.encode() for t in texts])]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert coder.encode([None, b""]) == [b"", b""]


def test_word_tokenizer_on_random_texts():
    """All planes, control characters (U+001C to U+001F are no white space to the tokenizer), combining
    marks and words whose lower case has another length."""
    rng = random.Random(5)
    pools = [range(0x20), range(0x20, 0x7F), range(0x80, 0x250), range(0x250, 0x600), range(0x300, 0x370), range(0x1E00, 0x2100),
             range(0x3000, 0xD800), range(0xE000, 0xFFFE), range(0x10000, 0x110000)]
    texts = ["a\x1cb", "\u0130.", "a<|endoftext|>.b <|startoftext|>", "<|", "x<|y.", "e\u0301. \u00c9", "don't. 'S o'RE"]
    for _ in range(20_000):
        near = [pools[1], *rng.choices(pools, k=2)]
        texts.append("".join(chr(rng.choice(rng.choice(near))) for _ in range(rng.randint(1, 14))))
    plain, coder = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    got = [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode([t.encode() for t in texts])]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_stems_go_to_the_library_without_its_normalizer():
    """Words of letters are encoded by the model alone, each new stem once; the rest by the whole tokenizer."""
    coder, plain = WordTokenizer(PATH), Tokenizer.from_file(PATH)
    whole = coder.tokenizer
    asked = []

    class Listening:
        def encode_batch_fast(self, texts, **kw):
            asked.extend(texts)
            return whole.encode_batch_fast(texts, **kw)

    coder.tokenizer = Listening()
    letters = [chr(c) for c in coder.letters]
    words = [a + b for a in letters for b in ("", "x", "\u00e9s")] + ["Wording,", "wording", "WORDING!"]
    for _ in range(2):
        assert np.frombuffer(coder.encode([" ".join(words).encode()])[0], coder.dtype).tolist() == plain.encode(" ".join(words)).ids
    assert asked and not any(c.isalpha() for text in asked for c in text.replace("<|endoftext|>", ""))


def test_flat_ids_with_an_end_id():
    texts = ["a b", None, "", " \t\x0b ", "\n wording.\r", "\x1c x\x1f y\u00a0z"]
    coder, plain = WordTokenizer(PATH), Tokenizer.from_file(PATH)
    want = [plain.encode(t or "").ids + [1] for t in texts]
    for column in (pa.array(texts), pa.array(["no", *texts]).slice(1)):
        ids, counts = coder.encode_flat(column, 1)
        assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
    assert id_bytes(ids, counts).to_pylist() == [np.array(w, coder.dtype).tobytes() for w in want]
    assert [x.tolist() for x in coder.encode_flat(pa.array([], pa.string()), 1)] == [[], []]


def test_caches_that_run_over(monkeypatch):
    monkeypatch.setattr(encoding, "CACHE_WORDS", 40)
    monkeypatch.setattr(encoding, "CACHE_STEMS", 20)
    coder, plain = WordTokenizer(PATH), Tokenizer.from_file(PATH)
    for k in range(30):
        texts = [f"w{chr(97 + (k * j) % 26)}rd{chr(97 + j)}, Same {k}" for j in range(9)]
        assert [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode([t.encode() for t in texts])] == [plain.encode(t).ids for t in texts]


def test_tail_cuts():
    assert P.tail_cuts(0) == [] and P.tail_cuts(1500) == [1024, 1280, 1408, 1472, 1488, 1496, 1500]


def test_odd_rows_round_trip(spark):
    docs = odd.odd_docs(spark)
    plain = Tokenizer.from_file(PATH)
    for targets in (None, {"a": 5, "b": 1, "c": 1, None: 1}):
        rows = P.pack(docs, PATH, targets=targets, with_ids=True).collect()
        want = sorted((str(i), plain.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, *_ in odd.ROWS)
        by_doc = {}
        for r in rows:
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length > 0
            by_doc.setdefault((str(r.doc_id), r.doc_tokens), []).append(r)
        total = sum(len(x) for _, x in want)
        assert sum(r.length for r in rows) == total
        for (i, n), pieces in by_doc.items():
            copies = sum(1 for j, x in want if j == i and len(x) == n)
            ids = next(x for j, x in want if j == i and len(x) == n)
            for start in {p.start for p in pieces}:
                same = [p for p in pieces if p.start == start]
                assert all(p.ids == ids[start:start + p.length] for p in same)
            assert sum(p.length for p in pieces) == n * copies
        windows = {}
        for r in rows:
            windows.setdefault(r.sequence_id, []).append(r)
        lengths = []
        for k in sorted(windows):
            at = 0
            for r in sorted(windows[k], key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            lengths.append(at)
        assert sorted(windows) == list(range(len(windows)))
        assert all(n == 2048 for n in lengths[: total // 2048]) and all(n & (n - 1) == 0 for n in lengths)
    assert P.pack(odd.no_docs(spark), PATH).count() == 0
