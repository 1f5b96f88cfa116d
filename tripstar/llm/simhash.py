"""SimHash near-duplicates: byte-position inverted index with count filtering.

Fingerprints of 64 bits (8 bytes) link when at most ``max_bits`` = 3 bits differ. Three bits touch at
most three bytes, so linked fingerprints agree in at least 8 - 3 = 5 of the 8 byte positions. Exact
copies share one fingerprint, so everything below works on distinct fingerprints (the classes).

Index: a posting list is keyed by a set of byte positions and the bytes found there. Any five of
eight positions contain three of the first or three of the last half, so the eight triples inside
the halves reach every link. Lists of at most ``max_list`` fingerprints are compared: the shared
positional bytes of a pair are tallied, pairs with five or more stay, and their differing bits are
counted. A longer list is split by more of the same filter, without loss: two of the five other
positions must agree as well (ten sets), and after that, of the eight 3-bit groups of the last three
bytes, five must agree (56 sets); such a list holds at most 2**9 different fingerprints by
construction. Lists yield a spanning forest of their links, not all pairs.

Components come from alternating large-star and small-star rounds over the class graph; each round
is written to the checkpoint folder, and only a count and a checksum reach the driver.

Defined cases: a null or empty text, or one without a word, has fingerprint zero and links like any
other; fewer words than a shingle make one shingle of all words; repeated rows share a component;
a null id never names a component (a component without any id has a null ``component_id``); an empty
table gives no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.llm.common import materialise, strings

SHINGLE_WORDS, MAX_BITS, SEED = 3, 3, 42
MAX_LIST = 512
MAX_ROUNDS = 60


def fingerprint(text: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of the XXH64 values of all word shingles, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    if len(words) <= k:
        h = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        h = [digest(joined[a:b - 1], SEED) for a, b in zip([0, *ends], ends[k - 1:], strict=False)]
    raw = np.array(h, dtype=np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(raw), 4096):
        ones += np.unpackbits(raw[at:at + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint_udf(k: int = SHINGLE_WORDS):
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(texts), 256):
            out += [fingerprint(t, k) for t in strings(texts.slice(at, 256))]
        return pa.array(np.array(out, dtype=np.uint64).view(np.int64))

    return F.arrow_udf(run, "long")


def _byte(position: int):
    return F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255))


def _key(tag: int, parts) -> F.Column:
    """A struct of the position set's number and the bytes there, packed into one long."""
    packed = F.lit(0).cast("long")
    for p in parts:
        packed = F.shiftleft(packed, 8).bitwiseOR(p)
    return F.struct(F.lit(tag).cast("int").alias("t"), packed.alias("v"))


def _lists(keyed: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows (k, fp) of the short lists with two or more members, and those of the long lists (None
    if there are none)."""
    sized = keyed.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1")
    rows = materialise(keyed.join(sized, "k"), "lists")
    short, long = rows.filter(F.col("n") <= limit).select("k", "fp"), rows.filter(F.col("n") > limit).select("k", "fp")
    return short, None if long.isEmpty() else long


def _forest(rows: DataFrame, max_bits: int) -> DataFrame:
    """Verified links inside each list (rows of one key), as a spanning forest: columns a, b."""
    least_bytes = 8 - max_bits

    def links(k: np.ndarray, fp: np.ndarray):
        """Forest of whole lists, given side by side."""
        n = len(fp)
        starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
        left, right, at, shift = [], [], np.arange(n), 1
        while True:
            at = at[at + shift < ends[at]]
            if not len(at):
                break
            x = fp[at] ^ fp[at + shift]
            shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            pick = np.flatnonzero(shared >= least_bytes)
            pick = pick[np.bitwise_count(x[pick]) <= max_bits]
            left.append(at[pick])
            right.append(at[pick] + shift)
            shift += 1
        i = np.concatenate(left) if left else np.zeros(0, np.int64)
        j = np.concatenate(right) if right else np.zeros(0, np.int64)
        root = np.arange(n)
        while True:
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, root[i])
            low = low[low]
            if (low == root).all():
                break
            root = low
        own = np.flatnonzero(root != np.arange(n))
        return fp[own].view(np.int64), fp[root[own]].view(np.int64)

    def run(batches):
        keep_t, keep_v, keep_fp = (np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            t, v, fp = (np.concatenate([old, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)])
                        for i, old in enumerate((keep_t, keep_v, keep_fp)))
            change = np.flatnonzero((t[1:] != t[:-1]) | (v[1:] != v[:-1])) + 1
            cut = int(change[-1]) if len(change) else 0  # the last list may go on in the next batch
            keep_t, keep_v, keep_fp = t[cut:], v[cut:], fp[cut:]
            if cut:
                yield emit(t[:cut], v[:cut], fp[:cut])
        if len(keep_fp):
            yield emit(keep_t, keep_v, keep_fp)

    def emit(t, v, fp):
        number = np.cumsum(np.concatenate([[True], (t[1:] != t[:-1]) | (v[1:] != v[:-1])]))
        a, b = links(number, np.ascontiguousarray(fp).view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    flat = rows.select(F.col("k.t").cast("long").alias("t"), F.col("k.v").alias("v"), "fp")
    return flat.repartition("t", "v").sortWithinPartitions("t", "v", "fp").mapInArrow(run, "a long, b long")


def class_links(classes: DataFrame, max_bits: int = MAX_BITS, max_list: int = MAX_LIST) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``fp`` at ``max_bits`` = 3 or fewer bits."""
    if max_bits > 3:
        raise ValueError("the position sets below guarantee links of at most three bits")
    triples = [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3)]
    first = classes.select("fp", F.explode(F.array(*[_key(i, map(_byte, t)) for i, t in enumerate(triples)])).alias("k"))
    lists, long = _lists(first, max_list)
    if long is not None:
        # of the five other positions two more must agree
        short, long = _lists(_by_triple(long, triples).distinct(), max_list)
        lists = lists.unionByName(short)
        if long is not None:
            lists = lists.unionByName(_by_bits(long).select("k", "fp"))
    return _forest(lists, max_bits).distinct()


def _by_triple(long: DataFrame, triples) -> DataFrame:
    options = F.when(F.lit(False), F.array(_key(0, [])))
    for i, triple in enumerate(triples):
        rest = [p for p in range(8) if p not in triple]
        sets = [sorted((*triple, *pair)) for pair in combinations(rest, 2)]
        options = options.when(F.col("k.t") == i, F.array(*[_key(sum(1 << p for p in s), map(_byte, s)) for s in sets]))
    return long.select("fp", F.explode(options).alias("k"))


def _by_bits(long: DataFrame) -> DataFrame:
    """Lists of five shared bytes, split by five of the eight 3-bit groups of the other three bytes."""
    rest = F.lit(0).cast("long")
    for p in range(8):
        outside = F.shiftright("mask", p).bitwiseAND(F.lit(1)) == 0
        rest = F.when(outside, F.shiftleft(rest, 8).bitwiseOR(_byte(p))).otherwise(rest)
    groups = list(combinations(range(8), 5))
    keep = [sum(7 << (3 * g) for g in s) for s in groups]
    based = long.select("fp", F.col("k.t").alias("mask"), F.col("k.v").alias("v")).withColumn("rest", rest)
    picks = F.array(*[F.struct(F.lit(i).alias("s"), F.col("rest").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(keep)])
    out = based.select("fp", "mask", "v", F.explode(picks).alias("p"))
    # mask and set number fit one int; five bytes and 24 bits fit one long
    tag = F.col("mask").cast("long") * 64 + F.col("p.s")
    return out.select("fp", F.struct(tag.cast("int").alias("t"), F.shiftleft("v", 24).bitwiseOR(F.col("p.bits")).alias("v")).alias("k"))


def connected(links: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(node, root) of every node with a link, root being the smallest node of its component:
    large-star and small-star rounds until the edge set stands still."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct().checkpoint()
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = small.checkpoint()
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError("components did not settle")


def _rooted(prints: DataFrame, least: F.Column, max_bits: int) -> DataFrame:
    """(fp, least, root) of every class: the least value of its rows and its component's smallest print."""
    classes = materialise(prints.groupBy("fp").agg(F.min(least).alias("least")), "classes")
    roots = connected(class_links(classes.select("fp"), max_bits))
    return classes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id column, ``fp`` (the fingerprint as a signed long) and
    ``component_id`` (the smallest id reachable over links of at most ``max_bits`` bits)."""
    prints = materialise(docs.select(F.col(id_col), fingerprint_udf(shingle_words)(F.col(text_col)).alias("fp")), "fingerprints")
    named = _rooted(prints, F.col(id_col), max_bits)
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(ids, "root").select("fp", "component_id"), "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-copies: of each component one row stays, the one with the
    smallest id (null ids come last; of equal ids a hash of the text decides)."""
    names = [F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col)]
    key = {f"__key{i}": F.xxhash64(F.lit(i), *names) for i in (1, 2)}  # 128 bits tell a row's id and text
    prints = materialise(docs.select(F.col(id_col).alias("id"), *[c.alias(k) for k, c in key.items()],
                                     fingerprint_udf(shingle_words)(F.col(text_col)).alias("fp")), "fingerprints")
    least = F.struct(F.col("id").isNull().alias("nameless"), "id", *key)
    stay = _rooted(prints, least, max_bits).groupBy("root").agg(F.min("least").alias("least")).select(*[f"least.{k}" for k in key])
    # rows of the same id and text are one to the key
    return docs.withColumns(key).join(stay, [*key], "left_semi").dropDuplicates([*key]).drop(*key)
