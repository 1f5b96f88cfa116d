"""Benchmark decontamination: pigeonhole edit matching.

Texts are compared in lower case with every run of ASCII white space and punctuation as one space. A
test item of m characters may differ by k = floor(m * ``ERROR_RATE``) edits. It is cut into k + 1
pieces, of which k edits leave at least one untouched, so every approximate occurrence contains an
exact piece. One Aho-Corasick automaton finds all pieces of all items in a document in one pass; each
hit fixes a window of the document in which the item can lie, overlapping windows of an item are
joined, and Myers' bit-parallel recurrence gives the least edit distance of the item to any part of
the window.

The items are the query set. They are taken in blocks of at most ``BLOCK_CHARS`` characters (an item
longer than that is a block of its own), and each block's automaton is sent to the tasks: a broadcast
of bounded size, with one pass over the documents for each block, none of which is shuffled.

Defined cases: null or empty texts match nothing; items that are null or have no character left match
nothing; repeated items and repeated rows give a row each; null ids are kept; an empty document or item
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import string
from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tripstar.llm.common import strings

ERROR_RATE = 0.05
BLOCK_CHARS = 4_000_000

_SPACES = bytes(32 if c < 33 or chr(c) in string.punctuation else c for c in range(128)) + bytes(range(128, 256))


def normalise(raw: bytes | None) -> str:
    if not raw:
        return ""
    return b" ".join(raw.decode().lower().encode().translate(_SPACES).split()).decode()


def pieces_of(item: str, error_rate: float = ERROR_RATE) -> tuple[int, list[tuple[int, str]]]:
    """The error budget and the k + 1 pieces with their offsets."""
    k = int(len(item) * error_rate)
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return k, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Matcher:
    """Automaton and Myers masks of one block of items."""

    def __init__(self, items: list[tuple], error_rate: float):
        self.items, places = [], defaultdict(list)
        for item_id, text in items:
            if not text:
                continue
            k, pieces = pieces_of(text, error_rate)
            masks: dict[str, int] = defaultdict(int)
            for i, c in enumerate(text):
                masks[c] |= 1 << i
            number = len(self.items)
            self.items.append((item_id, len(text), k, dict(masks)))
            for offset, piece in pieces:
                places[piece].append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple]:
        """(item id, distance, end) of every item within its budget; end is where the best match ends."""
        if not self.items or not text:
            return []
        windows: dict[int, list[list[int]]] = defaultdict(list)
        for last, (n, where) in self.automaton.iter(text):
            for number, offset in where:
                _, m, k, _ = self.items[number]
                begin = last + 1 - n - offset
                a, b = max(0, begin - k), min(len(text), begin + m + k)
                mine = windows[number]
                if mine and a <= mine[-1][1] and a >= mine[-1][0]:
                    mine[-1][1] = max(b, mine[-1][1])
                else:
                    mine.append([a, b])
        out = []
        for number, mine in windows.items():
            item_id, m, k, masks = self.items[number]
            best = min((least_distance(masks, m, text, a, b) for a, b in mine), default=(k + 1, 0))
            if best[0] <= k:
                out.append((item_id, *best))
        return out


def least_distance(masks: dict[str, int], m: int, text: str, start: int, end: int) -> tuple[int, int]:
    """Myers: the least edit distance of the pattern to any part of text[start:end], and its end."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, (m, start)
    for i in range(start, end):
        eq = masks.get(text[i], 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mv_next = ph & xv
        pv = (mh << 1 | ~(xv | ph)) & full
        mv = mv_next
        if score < best[0]:
            best = (score, i + 1)
    return best


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int):
    """Blocks of (id, normalised text), streamed to the driver a partition at a time."""
    block, size = [], 0
    for row in items.select(F.col(id_col), F.col(text_col).cast("string")).toLocalIterator():
        text = normalise(None if row[1] is None else row[1].encode())
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row[0], text))
        size += len(text)
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS,
               id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item found in it: ``doc_id``, ``item_id`` (as given), ``distance`` and
    ``match_end`` (code points of the normalised text)."""
    spark = docs.sparkSession
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), items.schema[item_id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, distance int, match_end int"
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    found = None
    for block in item_blocks(items, item_id_col, item_text_col, block_chars):
        part = picked.mapInArrow(_searcher(spark.sparkContext.broadcast(block), error_rate, kinds), schema)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def _searcher(shared, error_rate: float, kinds: pa.Schema):
    def run(batches):
        matcher = Matcher(shared.value, error_rate)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows: list[tuple] = []
            for at in range(0, batch.num_rows, 256):
                for i, raw in enumerate(strings(texts.slice(at, 256)), at):
                    rows += [(i, *hit) for hit in matcher.find(normalise(raw))]
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(cols[0], pa.int64())), *(pa.array(c, f.type) for c, f in zip(cols[1:], list(kinds)[1:], strict=True))],
                schema=kinds)

    return run


def leak_udf(docs: DataFrame, items: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS,
             item_id_col: str = "item_id", item_text_col: str = "text"):
    """One boolean scalar function per block of items: whether a text holds an item of the block."""
    def make(shared):
        state: list[Matcher] = []

        def run(texts: pa.Array) -> pa.Array:
            if not state:
                state.append(Matcher(shared.value, error_rate))
            out = []
            for at in range(0, len(texts), 256):
                out += [bool(state[0].find(normalise(t))) for t in strings(texts.slice(at, 256))]
            return pa.array(out, pa.bool_())

        return F.arrow_udf(run, "boolean").asNondeterministic()

    context = docs.sparkSession.sparkContext
    return [make(context.broadcast(b)) for b in item_blocks(items, item_id_col, item_text_col, block_chars)]


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their own columns; nothing is shuffled."""
    for udf in leak_udf(docs, items, **params):
        docs = docs.withColumn("__leak", udf(F.col(text_col))).filter(~F.col("__leak")).drop("__leak")
    return docs
