"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words (runs outside ASCII white space) and word pairs are hashed into ``buckets`` cells. One pass
counts the cells over every document (raw multinomial) and over the trusted ones (target
multinomial), added up inside each task before the shuffle, so at most ``buckets`` rows leave a task.
The model is one integer weight per cell, ``round(SCALE * ln((c + PRIOR) / (e + PRIOR)))``, where c
is the cell's count in the target and e the count expected there from the raw share: the log ratio of
the two multinomials, drawn towards zero where little is expected. A document's score is the sum of its n-gram weights divided by their number; weights are
integers, so the sum does not depend on order and the threshold decides every document alike.

The target is fitted on at most about ``max_trusted`` labelled documents (a hash of the id chooses
them when there are more), so their ids are a broadcast of bounded size. The raw counts cover all rows.

Defined cases: a null or empty text, or one without a word, has zero counts, no n-gram, score 0 and
fails the base rules; repeated rows are scored alike; an empty corpus gives no rows; null ids are kept
as null and are never trusted; without any trusted document all weights are zero, so the base rules
alone decide; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.llm.common import map_batches, strings

BUCKETS = 1 << 16
SCALE = 1 << 16
# Counts by which a cell's ratio is drawn towards one.
PRIOR = 4.0
# Least mean log ratio (natural log) of a kept document. Labelled prose scores from -0.07 up, labelled
# junk from -0.14 down, on a thousand documents as on ten thousand.
THRESHOLD = -0.09
MAX_TRUSTED = 20_000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_CACHE_WORDS = 300_000

VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_ngrams long, llr_fixed long, base_failed boolean, kept boolean")


class Hasher:
    """28-bit word hashes (leading md5 digits) with a bounded cache."""

    def __init__(self):
        self.seen: dict[bytes, int] = {}

    def __call__(self, words) -> np.ndarray:
        seen = self.seen
        if len(seen) > _CACHE_WORDS:
            seen.clear()
        out = []
        for w in words:
            h = seen.get(w)
            if h is None:
                h = seen[w] = int(hashlib.md5(w).hexdigest()[:7], 16)
            out.append(h)
        return np.array(out, dtype=np.int64)


def ngram_cells(ids: np.ndarray, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Cells of all single words, then of all neighbouring pairs."""
    h = hashes[ids]
    return np.concatenate([h % buckets, (h[:-1] * 31 + h[1:] + 7) % buckets])


def number_words(text: bytes | None) -> tuple[list[bytes], np.ndarray, list[bytes]]:
    """Words, their indices into the distinct words, and the distinct words."""
    words = (text or b"").split()
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    return words, ids, list(index)


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words lying in a 3-word window that occurs at least twice in the text."""
    if len(ids) < 4:
        return 0
    keys = (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys) + 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line in seen:
            n += 1
        elif line and not line.isspace():
            seen.add(line)
    return n


def code_points(raw: bytes) -> int:
    return len(raw) if raw.isascii() else len(raw.decode())


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED, id_col: str = "doc_id") -> DataFrame:
    """Distinct non-null ids labelled ``quality = 1``, thinned by a hash of the id to about
    ``max_trusted`` when there are more."""
    ids = labels.filter((F.col("quality") == 1) & F.col(id_col).isNotNull()).select(id_col).distinct()
    n = ids.count()
    if n <= max_trusted:
        return ids
    cell = F.pmod(F.xxhash64(F.col(id_col), F.lit("trusted")), F.lit(1 << 30))
    return ids.filter(cell < int((1 << 30) * max_trusted / n))


def fit_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS,
                id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """One fixed-point weight per cell. Only the ``buckets`` summed cells reach the driver."""
    flagged = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(trusted.select(F.col(id_col).alias("id"), F.lit(True).alias("good"))), "id", "left",
    ).select("text", F.col("good").isNotNull().alias("good"))

    def count(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        hasher = Hasher()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for text, good in zip(strings(part.column(0)), part.column(1).to_pylist(), strict=True):
                    _, ids, distinct = number_words(text)
                    if len(ids):
                        n = np.bincount(ngram_cells(ids, hasher(distinct), buckets), minlength=buckets)
                        raw += n
                        if good:
                            target += n
        cells = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(raw[cells]), pa.array(target[cells])],
                                         names=["cell", "raw", "target"])

    cells = (flagged.mapInArrow(count, "cell long, raw long, target long")
             .groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))).toPandas()
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    raw[cells["cell"]] = cells["raw"]
    target[cells["cell"]] = cells["target"]
    if not target.any():
        return np.zeros(buckets, np.int64)
    ratio = np.log((target + PRIOR) / (raw * float(target.sum()) / float(raw.sum()) + PRIOR))
    return np.rint(ratio * SCALE).astype(np.int64)


def assess(text: bytes | None, weights: np.ndarray, hasher: Hasher, threshold: float = THRESHOLD) -> tuple:
    """The VERDICT row of one text."""
    text = text or b""
    words, ids, distinct = number_words(text)
    n = len(words)
    repeats = repeated_words(ids, len(distinct))
    cells = ngram_cells(ids, hasher(distinct), len(weights)) if n else np.zeros(0, np.int64)
    llr = int(weights[cells].sum())
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    return (n, code_points(b"".join(words)), len(_SYMBOLS.findall(text)), duplicate_lines(text), repeats,
            len(cells), llr, failed, not failed and llr >= threshold * SCALE * len(cells))


def verdict_udf(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD):
    """A scalar function from a text column to a VERDICT struct; non-deterministic only by
    declaration, so that a filter on it is not evaluated a second time."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    names = [f.split()[0] for f in VERDICT.split(", ")]
    hasher = Hasher()

    def judge(texts: pa.Array) -> pa.Array:
        rows = []
        for at in range(0, len(texts), 256):
            rows += [assess(t, shared.value, hasher, threshold) for t in strings(texts.slice(at, 256))]
        cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        kinds = [pa.int64()] * 7 + [pa.bool_()] * 2
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return F.arrow_udf(judge, "struct<" + ",".join(f.replace(" ", ":") for f in VERDICT.split(", ")) + ">").asNondeterministic()


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS,
                  max_trusted: int = MAX_TRUSTED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verdict of every row: the id column and the VERDICT columns."""
    weights = fit_weights(docs, trusted_ids(labels, max_trusted), buckets, id_col, text_col)
    judge = verdict_udf(docs, weights, threshold)
    return docs.select(F.col(id_col), judge(F.col(text_col)).alias("v")).select(id_col, "v.*")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` whose verdict is ``kept``, with their own columns; no shuffle of texts."""
    weights = fit_weights(docs, trusted_ids(labels, params.get("max_trusted", MAX_TRUSTED)), id_col=id_col, text_col=text_col)
    judge: Column = verdict_udf(docs, weights, params.get("threshold", THRESHOLD))(F.col(text_col))
    return docs.withColumn("__verdict", judge).filter("__verdict.kept").drop("__verdict")
