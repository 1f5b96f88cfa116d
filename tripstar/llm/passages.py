"""Repeated passages by prefix-free parsing: every byte covered by a ``LENGTH``-byte string that also
starts anywhere else in the corpus is removed.

Parsing. A rolling hash runs over all ``TRIGGER`` -byte strings of a document. The position with the
least hash among the ``REACH`` positions from s on (the leftmost of equals) is the trigger of s. It
depends on the bytes of the 400-byte string at s alone, so equal strings have their triggers at equal
distances. The starts that share a trigger are consecutive; the stretch of text from the first of
them to the end of the last one's string is a phrase. The phrases of a document, in order, are its
parse; the distinct phrases with the number of their occurrences are the dictionary.

Corpus order is needed only as far as suffixes agree on 400 bytes, so ranks are replaced by classes of
equal strings, named by two 64-bit rolling hashes:

* dictionary: a phrase that occurs twice has all its suffixes of 400 bytes twice; its starts are done;
* parse: two starts can only agree if the texts that follow their triggers agree on the
  ``LENGTH - REACH + 1`` bytes that both strings hold. Phrases whose trigger context occurs once are
  dropped unread;
* suffixes of phrases: for a phrase with a repeated context that is no dictionary repeat (the first
  and last phrases of a passage), its 400-byte suffixes are looked up among those of the phrases with
  the same context, of which one occurrence stands for each dictionary entry: first in blocks of
  neighbouring starts, then, for the blocks that occur once (the very edge of a passage), one by one.

Every step is a grouped count with partial sums or a join. The joins of all phrases, blocks or strings with those
that repeat deal a hot one over several parts (:func:`among`); what occurs once, and one occurrence of what repeats, comes
out of the counts themselves; the later joins meet rows that stand for many. Only trigger
rows (one for about ``REACH / 2`` bytes) are shuffled, texts twice: to cut out the phrases in question and
to remove the bytes found.

Defined cases: a null text is empty; shorter texts than ``LENGTH`` lose nothing; repeated rows are
occurrences of each other; null ids are kept; strings never cross documents, and what is removed does
not alter what is judged; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstar.llm.common import map_batches, materialise, strings

LENGTH, TRIGGER, REACH_BITS = 400, 16, 8
REACH = 1 << REACH_BITS
# Distances to the trigger that are first looked up together, as a power of two.
BLOCK_BITS = 4
SLICE_BYTES = 1 << 19
# Parts that the rows of a key are dealt over where a single key may have a large share of them.
SALTS = 32
KEYS = ("id", "th")
# The two hashes of a phrase or block.
ENTRY = ("ka", "kb")


class RollingHash:
    """Hashes of any substring from prefix sums, modulo 2**64, with a random value for each byte."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1, 1 << 62)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(size, base % (1 << 64), dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.powers[:len(data)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.inverses[start]


_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _hashes() -> tuple[RollingHash, RollingHash]:
    return RollingHash(11), RollingHash(23)


def parse(texts: list[bytes], hashes, length: int, trigger: int, reach_bits: int):
    """The phrases of some documents: (document, trigger, first start, last start) relative to each
    document, and the arrays k1 (context), ka, kb (phrase)."""
    reach = 1 << reach_bits
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return (empty,) * 4, (empty.astype(np.uint64),) * 3
    one, two = hashes
    p1 = one.prefix(data)
    at = np.arange(len(data) - trigger + 1)
    gram = (p1[trigger:] - p1[:-trigger]) * one.inverses[:len(at)] * _MIX
    least = (gram & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    for bit in range(reach_bits):
        step = 1 << bit
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
    # starts whose string lies inside its document
    counts = np.maximum(0, sizes - length + 1)
    doc = np.repeat(np.arange(len(texts)), counts)
    if not len(doc):
        return (empty,) * 4, (empty.astype(np.uint64),) * 3
    first = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    starts = np.arange(len(doc)) + first
    anchors = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])])
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(doc)) - 1
    a, lo, hi, d = anchors[begin], starts[begin], starts[end], doc[begin]
    p2 = two.prefix(data)
    k1 = one.of(p1, a, a + (length - reach + 1))
    ka = one.of(p1, lo, hi + length)
    shape = (a - lo).astype(np.uint64) * _MIX + (hi - lo).astype(np.uint64) * _MIX2
    kb = two.of(p2, lo, hi + length) + shape
    base = offsets[d]
    return (d, a - base, lo - base, hi - base), (k1, ka, kb)


def _slices(texts: list[bytes]):
    """Ranges of documents of about SLICE_BYTES each."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_BYTES:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def phrases(keyed: DataFrame, length: int, trigger: int, reach_bits: int) -> DataFrame:
    """One row for each phrase of (id, th, text): id, th, a (trigger), lo, hi (first and last start), k1, ka, kb."""
    def run(batches):
        hashes = _hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = [t or b"" for t in strings(part.column(2))]
                for x, y in _slices(texts):
                    (d, a, lo, hi), (k1, ka, kb) = parse(texts[x:y], hashes, length, trigger, reach_bits)
                    rows = pa.array(d + x)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(rows), part.column(1).take(rows), pa.array(a.astype(np.int32)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
                         *(pa.array(k.view(np.int64)) for k in (k1, ka, kb))],
                        names=["id", "th", "a", "lo", "hi", "k1", "ka", "kb"])

    return keyed.mapInArrow(run, "id long, th long, a int, lo int, hi int, k1 long, ka long, kb long")


def contexts(wanted: DataFrame, keyed: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted phrases: id, th, lo, hi, a, open, data."""
    lists = wanted.groupBy(*KEYS).agg(F.collect_list(F.struct("lo", "hi", "a", "open")).alias("parts"))
    joined = keyed.join(lists, list(KEYS)).select("id", "th", F.col("text").cast("binary").alias("text"), F.explode("parts").alias("p"))
    return joined.select("id", "th", "p.*", F.expr(f"substring(text, p.lo + 1, p.hi - p.lo + {length})").alias("data"))


def blocks(phrase_bytes: DataFrame, length: int, bits: int) -> DataFrame:
    """The starts of each phrase in blocks of ``2**bits`` distances to the trigger: id, th, lo, open,
    block, first, last (starts), the hashes ka and kb of the text from the first start to the last one's
    end, and kc of the bytes that all strings of a whole block hold."""
    schema = "id long, th long, lo int, open boolean, first int, last int, ka long, kb long, kc long"

    def run(batches):
        one, two = _hashes()
        for batch in batches:
            rows = batch.select(["lo"]).to_pydict()
            his, anchors, datas = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("hi", "a", "data"))
            out = {n: [] for n in ("row", "first", "last")}
            hashed = []
            for i, (lo, hi, a, data) in enumerate(zip(rows["lo"], his, anchors, datas, strict=True)):
                number = np.arange((a - hi) >> bits, ((a - lo) >> bits) + 1)
                first = np.maximum(lo, a - ((number + 1) << bits) + 1)
                last = np.minimum(hi, a - (number << bits))
                raw = np.frombuffer(data, np.uint8)
                shape = (a - first).astype(np.uint64) * _MIX + (last - first).astype(np.uint64) * _MIX2
                p1 = one.prefix(raw)
                core = a - lo - (number << bits)
                hashed.append((one.of(p1, first - lo, last - lo + length), two.of(two.prefix(raw), first - lo, last - lo + length) + shape,
                               one.of(p1, core, core + length - (1 << bits) + 1) + number.astype(np.uint64) * _MIX))
                for n, v in (("row", np.full(len(number), i)), ("first", first), ("last", last)):
                    out[n].append(v)
            if not hashed:
                continue
            row = pa.array(np.concatenate(out["row"]))
            base = [batch.column(batch.schema.get_field_index(c)).take(row) for c in ("id", "th", "lo", "open")]
            rest = [pa.array(np.concatenate(out[n]).astype(np.int32)) for n in ("first", "last")]
            keys = [pa.array(np.concatenate([h[j] for h in hashed]).view(np.int64)) for j in (0, 1, 2)]
            yield pa.RecordBatch.from_arrays([*base, *rest, *keys],
                                             names=["id", "th", "lo", "open", "first", "last", "ka", "kb", "kc"])

    return phrase_bytes.mapInArrow(run, schema)


def strings_of(wanted: DataFrame, phrase_bytes: DataFrame, length: int) -> DataFrame:
    """Every string of ``length`` bytes of the wanted blocks (id, th, lo, first, last, open): id, th, s,
    open, ha, hb."""
    lists = wanted.groupBy("id", "th", "lo").agg(F.collect_list(F.struct("first", "last", "open")).alias("parts"))
    joined = phrase_bytes.select("id", "th", "lo", "data").join(lists, ["id", "th", "lo"])

    def run(batches):
        one, two = _hashes()
        for batch in batches:
            los, datas, parts = (batch.column(i).to_pylist() for i in (2, 3, 4))
            got = []
            for i, (lo, data, mine) in enumerate(zip(los, datas, parts, strict=True)):
                raw = np.frombuffer(data, np.uint8)
                p1, p2 = one.prefix(raw), two.prefix(raw)
                for p in mine:
                    at = np.arange(p["first"], p["last"] + 1)
                    got.append((np.full(len(at), i), at, np.full(len(at), p["open"]), one.of(p1, at - lo, at - lo + length), two.of(p2, at - lo, at - lo + length)))
            if got:
                row, at, is_open, ha, hb = (np.concatenate(x) for x in zip(*got, strict=True))
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(at.astype(np.int32)), pa.array(is_open), pa.array(ha.view(np.int64)),
                     pa.array(hb.view(np.int64))], names=["id", "th", "s", "open", "ha", "hb"])

    return joined.mapInArrow(run, "id long, th long, s int, open boolean, ha long, hb long")


def dealt(rows: DataFrame, keys: Sequence[str], place: str, *also: Column) -> tuple[DataFrame, DataFrame]:
    """The rows, those of a key dealt over ``SALTS`` parts by their document and place; and the keys with the number ``n`` of
    their rows, the ``parts`` that these are in as the bits of a number, and the aggregates ``also``."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "th", place), F.lit(SALTS)).cast("int"))
    return salted, salted.groupBy(*keys).agg(F.count("*").alias("n"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("parts"), *also)


def among(salted: DataFrame, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """The dealt rows that have one of the wanted keys: the join meets a hot key in all parts, and a common one in no more
    parts than it has rows."""
    parts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.getbit("parts", i) == 1)
    return salted.join(wanted.select(*keys, F.explode(parts).alias("salt")), [*keys, "salt"], "left_semi").drop("salt")


def repeated(rows: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """The rows whose key occurs more than once."""
    salted, seen = dealt(rows, keys, place)
    return among(salted, keys, seen.filter("n > 1"))


def repeated_spans(keyed: DataFrame, length: int = LENGTH, trigger: int = TRIGGER, reach_bits: int = REACH_BITS,
                   block_bits: int = BLOCK_BITS) -> DataFrame:
    """(id, th, spans): for each document with repeats, the stretches [start, end) covered by
    repeated strings; they may overlap."""
    rows = phrases(keyed, length, trigger, reach_bits)
    shared = materialise(repeated(rows, ("k1",), "a"), "phrases")
    # every dictionary entry with one of its occurrences; the context is a part of the phrase
    dealt_phrases, seen = dealt(shared, ENTRY, "lo", F.min(F.struct("id", "th", "lo", "hi", "a", "k1")).alias("x"))
    dictionary = materialise(seen, "dictionary")
    known, open_ = among(dealt_phrases, ENTRY, dictionary.filter("n > 1")), dictionary.filter("n = 1").select("x.*")
    # of the entries that repeat, those that share a context with an open phrase
    standing = dictionary.filter("n > 1").select("x.*").join(open_.select("k1").distinct(), "k1", "left_semi")
    wanted = open_.withColumn("open", F.lit(True)).unionByName(standing.withColumn("open", F.lit(False))).drop("k1")
    data = materialise(contexts(wanted, keyed, length), "contexts")
    cut = materialise(blocks(data, length, block_bits), "blocks")
    # blocks whose common bytes occur once hold no repeated string
    cut = materialise(repeated(cut, ("kc",), "first"), "shared-blocks")
    # every kind of block with one of its occurrences; the common bytes are a part of the block
    dealt_blocks, seen = dealt(cut, ENTRY, "first", F.min(F.struct("id", "th", "lo", "first", "last", "open", "kc")).alias("x"))
    kinds = materialise(seen, "kinds")
    closed = among(dealt_blocks.filter("open"), ENTRY, kinds.filter("n > 1"))
    left = kinds.filter("n = 1 AND x.open").select("x.*")
    # of the other blocks with the same common bytes, one of each kind is looked at
    beside = kinds.filter("n > 1 OR NOT x.open").select("x.*").join(left.select("kc").distinct(), "kc", "left_semi")
    asked = left.unionByName(beside.withColumn("open", F.lit(False))).drop("kc")
    single = materialise(strings_of(asked, data, length), "strings")
    found = (repeated(single, ("ha", "hb"), "s").filter("open")
             .select("id", "th", F.col("s").alias("start"), (F.col("s") + length).alias("end")))
    whole = known.select("id", "th", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))
    block = closed.select("id", "th", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    return whole.unionByName(block).unionByName(found).groupBy(*KEYS).agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def remove_spans(raw: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """The bytes outside all spans, and the number of maximal removed runs."""
    if not spans:
        return raw, 0
    out, at, runs = [], 0, 0
    end = -1
    for s in sorted((x["start"], x["end"]) for x in spans):
        if s[0] > end:
            if end >= 0:
                at = end
            out.append(raw[at:s[0]])
            runs += 1
            end = s[1]
        else:
            end = max(end, s[1])
    out.append(raw[end:])
    return b"".join(out), runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id column, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the
    remaining bytes) and ``kept_sha256``."""
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a row is named by its id and its text; rows that share both have the same repeats
    keyed = docs.select(F.xxhash64(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"), F.col(id_col).alias("doc"))
    spans = repeated_spans(keyed.select("id", "th", "text"), length)
    joined = keyed.join(spans, list(KEYS), "left").select("doc", "text", "spans")

    def run(cols):
        kept = [remove_spans(t, s) for t, s in zip(cols["text"], cols["spans"], strict=True)]
        return {"doc": cols["doc"], "n_bytes": [len(t) for t in cols["text"]],
                "n_removed": [len(t) - len(k) for t, (k, _) in zip(cols["text"], kept, strict=True)],
                "n_spans": [n for _, n in kept], "kept": [k for k, _ in kept],
                "kept_sha256": [hashlib.sha256(k).hexdigest() for k, _ in kept]}

    return map_batches(joined, run, f"doc {id_type}, n_bytes long, n_removed long, n_spans long, kept binary, "
                       "kept_sha256 string").withColumnRenamed("doc", id_col)
