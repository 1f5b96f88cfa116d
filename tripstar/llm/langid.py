"""Language identification with interpolated Kneser-Ney character models.

Texts are read in lower case, every run of other characters than letters as one space. For each
language a trigram model is trained from all learning documents: the trigrams of all texts are counted
inside the tasks and added up; continuation counts, context totals and discounts follow from that
table by grouped counts. An n-gram's key holds its code points, 21 bits each, and its hash is a one-to-one
mixing of the 64 bits: no two n-grams share an entry and all counts are exact. A model is stored as arrays
sorted by hash and searched by bisection; it has an entry for every n-gram that occurs, so its size follows
the alphabets and what is written in them, not the number of documents.

A text's cross-entropy under a model is the mean of -ln P over its trigrams. The language with the
least one is predicted; ``score`` is its posterior among the models, with the evidence counted for at
most ``MAX_EVIDENCE`` characters. Calibrated rejection: over all learning documents that are predicted
right, the ``QUANTILE`` of the cross-entropy under the own language is found (its rank to one in
``QUANTILE_ACCURACY``); a text above it by the factor ``MARGIN`` is marked ``rejected``. The prediction stays in place.

Defined cases: texts that are null or have no letter are ``und`` with score 0 and rejected; so is every
text if nothing can be learned; equal cross-entropies go to the language first in order; repeated rows
give repeated results; null ids are never held out by the queries; an empty table gives no rows; other
columns than the named ones are not looked at, and the model sees none but text and language.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.llm.common import materialise, strings

# An odd factor, so that multiplying by it modulo 2^64 is one-to-one, and its inverse.
_MIX = 0x9E3779B97F4A7C15
_UNMIX = pow(_MIX, -1, 1 << 64)
QUANTILE, QUANTILE_ACCURACY, MARGIN = 0.995, 10_000, 1.05
MAX_EVIDENCE = 64
SLICE_CHARS = 1 << 18
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1))
    return _letters[0]


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the folded texts, each with a space before and after, and where each begins
    (one more entry: the end)."""
    joined = "\n".join(["", *texts, ""]).lower()
    lengths = np.array([len(t.lower()) for t in texts], dtype=np.int64)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    letter = letter_table()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    # a text without a letter next to its border keeps the border all the same
    borders = np.concatenate([[0], np.cumsum(lengths + 1)])
    keep[borders] = True
    folded = np.where(letter, codes, 32)[keep]
    return folded, (np.cumsum(keep) - 1)[borders]


def slot(packed: np.ndarray) -> np.ndarray:
    """The hash of packed n-grams."""
    return (packed.astype(np.uint64) * np.uint64(_MIX)).view(np.int64)


def unslot(hashes: np.ndarray) -> np.ndarray:
    """The packed n-grams of hashes."""
    return (hashes.view(np.uint64) * np.uint64(_UNMIX)).astype(np.int64)


def pack3(c: np.ndarray) -> np.ndarray:
    return (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]


def trigram_counts(docs: DataFrame, text: Column, lang: Column) -> DataFrame:
    """(lang, a, b, c, n) over all rows."""
    def run(batches):
        totals: dict[str, dict] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts, langs = strings(batch.column(0)), batch.column(1).to_pylist()
                for name in sorted(set(langs)):
                    add(totals.setdefault(name, {}), [t.decode() for t, x in zip(texts, langs, strict=True) if x == name])
                if sum(map(len, totals.values())) > 500_000:
                    yield out(totals)
                    totals.clear()
        yield out(totals)

    def add(mine, texts):
        for part in _char_slices(texts):
            folded, begin = fold(part)
            keys = pack3(folded)
            inside = np.ones(len(folded), dtype=bool)
            inside[begin[1:-1]] = False  # trigrams across a border belong to no text
            k, n = np.unique(keys[inside[1:-1]] if len(keys) else keys, return_counts=True)
            for x, y in zip(k.tolist(), n.tolist(), strict=True):
                mine[x] = mine.get(x, 0) + y

    def out(totals):
        keys = np.concatenate([np.fromiter(m.keys(), np.int64, len(m)) for m in totals.values()] or [np.zeros(0, np.int64)])
        n = np.concatenate([np.fromiter(m.values(), np.int64, len(m)) for m in totals.values()] or [np.zeros(0, np.int64)])
        lang = [name for name, m in totals.items() for _ in m]
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(keys), pa.array(n)], names=["lang", "key", "n"])

    mask = F.lit((1 << 21) - 1).cast("long")
    counted = docs.select(text.alias("text"), lang.alias("lang")).mapInArrow(run, "lang string, key long, n long")
    return counted.groupBy("lang", "key").agg(F.sum("n").alias("n")).select(
        "lang", F.shiftright("key", 42).alias("a"), F.shiftright("key", 21).bitwiseAND(mask).alias("b"),
        F.col("key").bitwiseAND(mask).alias("c"), "n")


def _char_slices(texts: list[str]):
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


class Model:
    """Interpolated Kneser-Ney models of several languages over sorted hash arrays."""

    def __init__(self, langs: list[str]):
        self.langs = langs
        self.orders: dict[str, tuple[np.ndarray, np.ndarray]] = {}  # sorted hashes, rows of values per language
        self.ceiling = np.full(len(langs), np.inf)

    def fit(self, tri: dict, ctx2: dict, bi: dict, ctx1: dict, uni: dict, discounts: dict) -> None:
        """Each table: {lang: (slots, columns...)}; see :func:`train`."""
        n = len(self.langs)
        letters = max(2, len({s for t in uni.values() for s in t[0].tolist()}) + 1)

        def union(table, width):
            keys = np.unique(np.concatenate([t[0] for t in table.values()]))
            values = np.zeros((width, len(keys), n))
            for j, name in enumerate(self.langs):
                slots, *cols = table[name]
                at = np.searchsorted(keys, slots)
                for w, col in enumerate(cols):
                    values[w, at, j] = col
            return keys, values

        self.tri_keys, (tri_n,) = union(tri, 1)
        self.ctx2_keys, (ctx2_total, ctx2_types) = union(ctx2, 2)
        self.bi_keys, (bi_n,) = union(bi, 1)
        self.ctx1_keys, (ctx1_total, ctx1_types) = union(ctx1, 2)
        self.uni_keys, (uni_n,) = union(uni, 1)
        d3, d2, d1 = (np.array([discounts[name][k] for name in self.langs]) for k in (3, 2, 1))
        total, types = uni_n.sum(axis=0), (uni_n > 0).sum(axis=0)
        # unigram: continuation counts, mixed with the uniform distribution
        self.uni_p = np.maximum(uni_n - d1, 0) / total + d1 * types / total / letters
        self.uni_p0 = d1 * types / total / letters
        with np.errstate(divide="ignore", invalid="ignore"):
            self.bi_own = np.maximum(bi_n - d2, 0)
            self.ctx1_total, self.ctx1_gamma = ctx1_total, np.where(ctx1_total > 0, d2 * ctx1_types / ctx1_total, 1.0)
            self.ctx2_total, self.ctx2_gamma = ctx2_total, np.where(ctx2_total > 0, d3 * ctx2_types / ctx2_total, 1.0)
        self.tri_own = np.maximum(tri_n - d3, 0)
        packed, low = unslot(self.tri_keys), (1 << 21) - 1
        shorter = (packed >> 21, packed & ((1 << 42) - 1), packed >> 21 & low, packed & low)  # ab, bc, b, c
        self.tri_log = np.log(self._probability(self.tri_own, *map(slot, shorter))).astype(np.float32)

    @staticmethod
    def _rows(keys, slots, table, missing):
        at = np.minimum(np.searchsorted(keys, slots), len(keys) - 1)
        return np.where((keys[at] == slots)[:, None], table[at], missing)

    def _probability(self, own3, ab, bc, b, c):
        """P(c | a b) for every language; own3 is the discounted trigram count."""
        p1 = self._rows(self.uni_keys, c, self.uni_p, self.uni_p0)
        total1 = self._rows(self.ctx1_keys, b, self.ctx1_total, 0.0)
        gamma1 = self._rows(self.ctx1_keys, b, self.ctx1_gamma, 1.0)
        own2 = self._rows(self.bi_keys, bc, self.bi_own, 0.0)
        p2 = np.where(total1 > 0, own2 / np.maximum(total1, 1), 0) + gamma1 * p1
        total2 = self._rows(self.ctx2_keys, ab, self.ctx2_total, 0.0)
        gamma2 = self._rows(self.ctx2_keys, ab, self.ctx2_gamma, 1.0)
        return np.where(total2 > 0, own3 / np.maximum(total2, 1), 0) + gamma2 * p2

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """ln P of every trigram of the code points, a column for each language."""
        hashed = slot(pack3(codes))
        at = np.minimum(np.searchsorted(self.tri_keys, hashed), len(self.tri_keys) - 1)
        out = self.tri_log[at]
        new = np.flatnonzero(self.tri_keys[at] != hashed)
        if len(new):
            a, b, c = codes[new], codes[new + 1], codes[new + 2]
            out[new] = np.log(self._probability(np.zeros((len(new), len(self.langs))),
                                                slot((a << 21) | b), slot((b << 21) | c), slot(b), slot(c)))
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each text under each language, and its number of trigrams with a letter."""
        folded, begin = fold(texts)
        n = len(texts)
        size = np.diff(begin) - 1  # trigrams inside a text with its two spaces
        if len(folded) < 3 or not len(self.langs):
            return np.full((n, len(self.langs)), np.inf), np.zeros(n, np.int64)
        logs = self.log_probabilities(folded)
        sums = np.concatenate([np.zeros((1, logs.shape[1])), np.cumsum(logs, axis=0, dtype=np.float64)])
        lo = np.minimum(begin[:-1], len(logs))
        hi = np.minimum(lo + np.maximum(size, 0), len(logs))
        count = np.maximum(hi - lo, 0)
        return -(sums[hi] - sums[lo]) / np.maximum(count, 1)[:, None], count


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of every non-null language of ``docs``; what reaches the driver is the models' entries."""
    known = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    tri = materialise(trigram_counts(known, F.col(text_col), F.col(lang_col).cast("string")), "trigrams")
    bi = tri.groupBy("lang", "b", "c").agg(F.count("*").alias("n"))  # different characters before b c
    ctx2 = tri.groupBy("lang", "a", "b").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    ctx1 = bi.groupBy("lang", "b").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    uni = bi.groupBy("lang", "c").agg(F.count("*").alias("n"))

    def cell(*parts):
        packed = F.lit(0).cast("long")
        for p in parts:
            packed = F.shiftleft(packed, 21).bitwiseOR(F.col(p))
        return packed

    hashed = _slot_udf()
    names = [r[0] for r in tri.select("lang").distinct().orderBy("lang").collect()]
    model = Model(names)
    if not names:
        return model

    def table(df: DataFrame, parts, sums):
        rows = df.select("lang", hashed(cell(*parts)).alias("k"), *(F.col(s) for s in sums)).toPandas().sort_values(["lang", "k"])
        return {n: tuple(g[c].to_numpy() for c in g.columns[1:]) for n, g in rows.groupby("lang")}

    def discount(df: DataFrame):
        got = {r["lang"]: r for r in df.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") == 2).alias("two")).collect()}
        return {n: got[n]["one"] / max(1, got[n]["one"] + 2 * got[n]["two"]) or 0.5 for n in names}

    d3, d2, d1 = discount(tri), discount(bi), discount(uni)
    model.fit(table(tri, "abc", ["n"]), table(ctx2, "ab", ["total", "types"]), table(bi, "bc", ["n"]),
              table(ctx1, "b", ["total", "types"]), table(uni, "c", ["n"]), {n: {3: d3[n], 2: d2[n], 1: d1[n]} for n in names})
    return model


def _slot_udf():
    @F.arrow_udf("long")
    def run(packed: pa.Array) -> pa.Array:
        return pa.array(slot(packed.to_numpy(zero_copy_only=False)))

    return run


def judge(model: Model, texts: list[bytes | None]) -> list[tuple]:
    """(language, score, cross-entropy, rejected) of each text."""
    out: list[tuple] = [("und", 0.0, None, True)] * len(texts)
    plain = [(i, t.decode()) for i, t in enumerate(texts) if t]
    for part in _pair_slices(plain):
        entropy, count = model.entropies([t for _, t in part])
        for (i, t), h, n in zip(part, entropy, count, strict=True):
            if not model.langs or not any(map(str.isalpha, t)):
                continue
            best = int(h.argmin())
            score = 1.0 / float(np.exp(-np.minimum((h - h[best]) * min(int(n), MAX_EVIDENCE), 700)).sum())
            out[i] = (model.langs[best], score, float(h[best]), bool(h[best] > model.ceiling[best]))
    return out


def _pair_slices(pairs):
    part, size = [], 0
    for p in pairs:
        part.append(p)
        size += len(p[1])
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def predict_udf(model: Model):
    """text -> struct<lang, score, entropy, rejected>."""
    fields = [("lang", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()), ("rejected", pa.bool_())]

    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for at in range(0, len(texts), 256):
            rows += judge(model, strings(texts.slice(at, 256)))
        cols = list(zip(*rows, strict=True)) if rows else [()] * 4
        return pa.StructArray.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])

    return F.arrow_udf(run, "struct<lang:string,score:double,entropy:double,rejected:boolean>").asNondeterministic()


def calibrate(model: Model, docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Sets each language's ceiling from all of its learning documents."""
    if not model.langs:
        return model
    known = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    scored = known.select(F.col(lang_col).cast("string").alias("own"), predict_udf(model)(F.col(text_col)).alias("p"))
    rows = scored.filter("p.lang = own AND p.entropy IS NOT NULL").groupBy("own").agg(F.percentile_approx("p.entropy", QUANTILE, QUANTILE_ACCURACY).alias("h")).collect()
    for r in rows:
        model.ceiling[model.langs.index(r["own"])] = r["h"] * MARGIN
    return model


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predictions for every row, learned from the rows where ``learn`` holds: the id column,
    ``lang_pred``, ``score``, ``entropy`` and ``rejected``."""
    known = docs.filter(learn)
    model = calibrate(train(known, text_col, lang_col), known, text_col, lang_col)
    return docs.select(F.col(id_col), predict_udf(model)(F.col(text_col)).alias("p")).select(
        id_col, F.col("p.lang").alias("lang_pred"), "p.score", "p.entropy", "p.rejected")
