"""Secret scans: character Markov models of random strings and of ordinary identifiers, compared by
their log-likelihood ratio.

Base rules find assignments of credentials, access keys and long hexadecimal strings. Their values
are the labelled sample of random strings; every other run of token characters of the corpus is the
labelled sample of ordinary identifiers and words. Both models are first-order: a character given the
one before it, over the token characters. One pass counts the character pairs of both samples over
all texts, inside the tasks, so the numbers that leave a task are bounded by the square of the alphabet. The random model is mixed
half and half with the uniform distribution, as secrets come in alphabets that the sample may lack.

A second pass scores every run of at least ``MIN_TOKEN`` token characters, and where base spans lie in
a run, the parts beside them: the mean log ratio of the pairs must reach ``MIN_MEAN`` and their sum
``MIN_SUM``. A part that falls short as a whole may hold keys joined to ordinary characters, so its
stretches of at least ``MIN_TOKEN`` characters are asked: the one with the greatest sum of log ratios
above ``MIN_MEAN`` first, then what lies before and after it. A stretch ends at the borders of the
letter-digit words that it cuts, so no end of a key stays. All these are added as spans of kind
``random``; base spans always stay.

Defined cases: a null or empty text has no spans; spans are in code points, end exclusive, by start,
then by kind; an empty table gives no rows; without any base match the random model is uniform;
repeated rows give repeated results; null ids are kept; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.llm.common import map_batches, strings

# Fixed patterns and least lengths of the base kinds, in the order in which spans are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "random")

TOKEN_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
TOKEN = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
MIN_TOKEN, MIN_MEAN, MIN_SUM = 16, 3.0, 45.0
# Weight of a character's own frequency, mixed with the uniform one, against the pairs that begin alike.
PRIOR = 5.0
MASK = "[SECRET]"

_N = len(TOKEN_CHARS)
_CODE = np.full(256, _N, dtype=np.int64)
_CODE[np.frombuffer(TOKEN_CHARS.encode(), np.uint8)] = np.arange(_N)
_HEX_TABLE = bytes(104 if c in b"0123456789abcdef" else 32 for c in range(256))
_HEX_RUN = b"h" * 24
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def base_spans(raw: bytes, text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base matches; plain byte searches tell first whether a kind's
    pattern can match at all."""
    spans = []
    folded = raw.lower()
    if any(w in folded for w in _WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if b"AKIA" in raw:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    if _HEX_RUN in raw.translate(_HEX_TABLE):
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _pairs(raw: bytes) -> np.ndarray:
    codes = _CODE[np.frombuffer(raw, np.uint8)]
    return codes[:-1] * (_N + 1) + codes[1:]


def fit_ratio(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log ratio of a pair of token characters, random against ordinary; shape (N, N)."""
    size = (_N + 1) ** 2

    def count(batches):
        ordinary, random = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for raw in strings(batch.slice(at, 256).column(0)):
                    if not raw:
                        continue
                    ordinary += np.bincount(_pairs(raw), minlength=size)
                    text = raw.decode()
                    values = set()
                    for start, kind, end in base_spans(raw, text):
                        value = ASSIGN.match(text, start).start(2) if kind == 0 else start
                        values.add((value, end))
                    for a, b in _disjoint(values):
                        n = np.bincount(_pairs(text[a:b].encode()), minlength=size)
                        random += n
                        ordinary -= n
        cells = np.flatnonzero(ordinary + random)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(ordinary[cells]), pa.array(random[cells])],
                                         names=["cell", "ordinary", "random"])

    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(count, "cell long, ordinary long, random long")
            .groupBy("cell").agg(F.sum("ordinary").alias("ordinary"), F.sum("random").alias("random")).toPandas())
    models = []
    for name in ("random", "ordinary"):
        flat = np.zeros(size)
        flat[rows["cell"]] = rows[name]
        pairs = flat.reshape(_N + 1, _N + 1)[:_N, :_N]
        single = (pairs.sum(axis=0) / max(1.0, pairs.sum()) + 1 / _N) / 2
        models.append((pairs + PRIOR * single) / (pairs.sum(axis=1, keepdims=True) + PRIOR))
    return np.log(0.5 * models[0] + 0.5 / _N) - np.log(models[1])


def _disjoint(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def random_stretches(part: str, ratio: np.ndarray, min_mean: float = MIN_MEAN, min_sum: float = MIN_SUM) -> list[tuple[int, int]]:
    """Where token characters look random: the whole part, or the stretches inside it that do."""
    codes = _CODE[np.frombuffer(part.encode(), np.uint8)]
    scores = ratio[codes[:-1], codes[1:]]
    total = float(scores.sum())
    if total >= min_sum and total >= min_mean * len(scores):
        return [(0, len(part))]
    sums, over = (np.concatenate([[0.0], np.cumsum(x)]) for x in (scores, scores - min_mean))
    least = MIN_TOKEN - 1  # pairs
    found, todo = [], [(0, len(part))]
    while todo:
        a, b = todo.pop()
        if b - a < MIN_TOKEN:
            continue
        p = over[a:b]
        gain = p[least:] - np.minimum.accumulate(p[:len(p) - least])
        last = int(gain.argmax())
        if gain[last] < 0:
            continue
        first = int(p[:last + 1].argmin())
        x, y = a + first, a + last + least
        if sums[y] - sums[x] < min_sum:  # never at the module's thresholds: the least pairs at the least mean make the least sum
            continue
        y += 1
        while x > a and part[x - 1].isalnum() and part[x].isalnum():
            x -= 1
        while y < b and part[y].isalnum() and part[y - 1].isalnum():
            y += 1
        found.append((x, y))
        todo += [(a, x), (y, b)]
    return sorted(found)


def all_spans(raw: bytes | None, ratio: np.ndarray, min_mean: float = MIN_MEAN, min_sum: float = MIN_SUM) -> list[tuple[int, int, int]]:
    """Base spans and the runs, or stretches of runs, that look random, sorted."""
    if not raw:
        return []
    text = raw.decode()
    base = base_spans(raw, text)
    taken = _disjoint((a, b) for a, _, b in base)
    found = []
    for m in TOKEN.finditer(text):
        at, end = m.span()
        for x, y in [*(t for t in taken if at < t[1] and t[0] < end), (end, end)]:
            if x - at >= MIN_TOKEN:
                found += [(at + a, 3, at + b) for a, b in random_stretches(text[at:x], ratio, min_mean, min_sum)]
            at = max(at, y)
    return sorted(base + found)


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id column, counts ``n_assign``, ``n_access``, ``n_hex``, ``n_random``,
    ``base`` (base spans) and ``spans`` (all spans), each as kind:start:end joined by commas."""
    ratio = fit_ratio(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(cols):
        found = [all_spans(t, shared.value) for t in cols["text"]]
        counts = [[sum(k == kind for _, k, _ in s) for s in found] for kind in range(4)]
        base = [_join(x for x in s if x[1] < 3) for s in found]
        return {"id": cols["id"], "n_assign": counts[0], "n_access": counts[1], "n_hex": counts[2], "n_random": counts[3],
                "base": base, "base_sha256": [hashlib.sha256(b.encode()).hexdigest() for b in base], "spans": [_join(s) for s in found]}

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(picked, run, f"id {id_type}, n_assign long, n_access long, n_hex long, n_random long, base string, "
                       "base_sha256 string, spans string").withColumnRenamed("id", id_col)


def masked(raw: bytes | None, ratio: np.ndarray, mask: str = MASK) -> str | None:
    """The text with every span replaced by ``mask``; None stays None."""
    if raw is None:
        return None
    text, out, at = raw.decode(), [], 0
    for a, b in _disjoint((a, b) for a, _, b in all_spans(raw, ratio)):
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", mask: str = MASK) -> DataFrame:
    """``docs`` with the spans in ``text_col`` masked; ``chars_col``, if there, follows the new text
    where it changed. No row is dropped and no text shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_ratio(docs, text_col))

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(texts), 256):
            out += [masked(t, shared.value, mask) for t in strings(texts.slice(at, 256))]
        return pa.array(out, pa.string())

    new = docs.withColumn("__masked", F.arrow_udf(run, "string").asNondeterministic()(F.col(text_col)))
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        new = new.withColumn(chars_col, F.when(F.col("__masked") == F.col(text_col), F.col(chars_col))
                             .when(F.col("__masked").isNull(), F.col(chars_col)).otherwise(F.length("__masked").cast(kind)))
    return new.withColumn(text_col, F.col("__masked")).drop("__masked")
