"""Filter interaction audit: what every order of a set of filters removes, and which filter deserves the credit.

Each part of the corpus is cut into chunks of rows with ascending ids. A chunk keeps its sorted ids and, for
every filter, a posting list: the ascending places of the failing ids. Two more lists hold the rows that are
labelled good and toxic. A step of an order removes the ids of its filter's list that the union of the earlier
filters' lists lacks. The union of every subset is a galloping merge of its largest member's list into the
union of the others, the difference a galloping search of one list in the other: the shorter list's ids are
looked up in the longer one by doubling strides and a binary search inside the last stride, all ids of a merge
at once. Chunks are disjoint, so the sizes found in them are added up by Spark, and only sizes leave a chunk:
subsets times filters numbers. Orders are then read off the sizes (a step's numbers depend on the set of the
earlier filters, not on their order).

Which rows make up a chunk changes no sum, so no group is ever gathered: a part with a third of all rows, one id
on very many rows or one text in very many copies is spread over as many chunks as it takes. Repeated texts are
found by their SHA-256 with sums made before the shuffle; a text's rows, dealt over parts by their ids, then meet
its smallest id in a join.

Defined cases: a null text is empty, a null part is the empty string; a null id is larger than none and smaller
than none, so such a row is never a later copy and makes none; repeated rows count once each; labels that repeat
are true if any is; rows without a label are neither good nor toxic; an empty table gives no rows; columns
besides those named are not looked at.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.llm.common import materialise

# Rows of a chunk; its lists are this long at most.
CHUNK_ROWS = 1 << 16
# Parts that the rows of one text are dealt over when they meet its smallest id.
SALTS = 32


def corpus_flags(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, A, B, C, D, digest): the failure conditions of single texts, A under 200 words, B distinct
    words under half of the words, C over 3 % capitals A to Z, D a sign of ``#$%&*|``; words are runs without
    ASCII white space."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    n = F.size("words")
    return picked.withColumn("words", words).select(
        "id", "part", (n < 200).alias("A"), (100 * F.size(F.array_distinct("words")) < 50 * n).alias("B"),
        (100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > 3 * F.length("text")).alias("C"),
        F.col("text").rlike("[#$%&*|]").alias("D"), F.unhex(F.sha2("text", 256)).alias("digest"))


def later_copies(flags: DataFrame, name: str = "E", digest_col: str = "digest") -> DataFrame:
    """Adds ``name``: some row with a smaller id has the same digest. The digest goes."""
    # rows of a text are dealt over parts by their id, and the smallest id is brought to the parts that have rows
    dealt = flags.withColumn("__part", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    first = dealt.groupBy(digest_col).agg(F.min("id").alias("__first"), F.max("id").alias("__last"),
                                          F.bit_or(F.expr("shiftleft(1L, __part)")).alias("__parts")).filter("__first < __last")
    parts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.getbit("__parts", i) == 1)
    joined = dealt.join(first.select(digest_col, "__first", F.explode(parts).alias("__part")), [digest_col, "__part"], "left")
    return joined.withColumn(name, F.coalesce(F.col("id") > F.col("__first"), F.lit(False))).drop(digest_col, "__first", "__part")


def with_labels(flags: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``good`` (quality 1) and ``toxic`` (toxic 1)."""
    known = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    joined = flags.join(known.filter("good OR toxic"), "id", "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")})


def posting_lists(flags: DataFrame, filters: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per chunk: ``part``, ``n``, ``low`` and ``high`` id, ``ids`` ascending (nulls first), and for every
    filter and for ``good`` and ``toxic`` the ascending places in ``ids`` that carry the flag. Map-only."""
    names = [*filters, "good", "toxic"]
    kind = flags.schema["id"].dataType.simpleString()
    schema = f"part string, n long, low {kind}, high {kind}, ids array<{kind}>, " + ", ".join(f"`{c}` array<int>" for c in names)

    def chunk(table: pa.Table) -> pa.RecordBatch:
        table = table.sort_by([("id", "ascending")]) if table.column("id").null_count == 0 else \
            table.take(pa.compute.sort_indices(table.column("id"), null_placement="at_start"))
        ids = table.column("id").combine_chunks()
        known = ids.drop_null()
        places = [pa.array(np.flatnonzero(table.column(c).to_numpy()).astype(np.int32)) for c in names]
        low, high = (pa.array([known[i].as_py() if len(known) else None], ids.type) for i in (0, -1))
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, *places)]
        return pa.RecordBatch.from_arrays([table.column("part").slice(0, 1).combine_chunks(), pa.array([len(ids)], pa.int64()), low, high, *lists],
                                          names=["part", "n", "low", "high", "ids", *names])

    def run(batches):
        waiting: dict[str, list[pa.RecordBatch]] = {}
        held: dict[str, int] = {}
        for batch in batches:
            part_of = batch.column(0).dictionary_encode()
            codes = part_of.indices.to_numpy()
            for code, part in enumerate(part_of.dictionary.to_pylist()):
                rows = batch.take(pa.array(np.flatnonzero(codes == code)))
                for at in range(0, rows.num_rows, chunk_rows):
                    piece = rows.slice(at, chunk_rows)
                    if held.get(part, 0) + piece.num_rows > chunk_rows:
                        yield chunk(pa.Table.from_batches(waiting.pop(part)))
                        held[part] = 0
                    waiting.setdefault(part, []).append(piece)
                    held[part] = held.get(part, 0) + piece.num_rows
            # very many parts at once: the fullest go, so that a task never holds more than 16 chunks
            while sum(held.values()) > 16 * chunk_rows:
                part = max(held, key=held.get)
                yield chunk(pa.Table.from_batches(waiting.pop(part)))
                del held[part]
        for rows in waiting.values():
            yield chunk(pa.Table.from_batches(rows))

    return flags.select("part", "id", *names).mapInArrow(run, schema)


def gallop(keys: np.ndarray, into: np.ndarray) -> np.ndarray:
    """Which of the ascending ``keys`` are in the ascending list ``into``. Every key starts where the one a
    stride before it ended: strides double until they pass the key, then the last stride is halved."""
    found = np.zeros(len(keys), dtype=bool)
    if not len(keys) or not len(into):
        return found
    # a few keys are placed by bisection; between two of them all keys gallop at once from the first one's place
    step = max(1, int(len(keys) ** 0.5))
    anchors = np.searchsorted(into, keys[::step])
    low = np.repeat(anchors, step)[:len(keys)]
    stride, high, live = 1, low.copy(), np.arange(len(keys))
    while len(live):
        at = low[live] + stride
        inside = at < len(into)
        passed = ~inside
        passed[inside] = into[at[inside]] >= keys[live[inside]]
        done = live[passed]
        high[done] = np.minimum(low[done] + stride, len(into))
        live = live[~passed]
        low[live] += stride
        stride *= 2
    while True:
        wide = np.flatnonzero(low < high)
        if not len(wide):
            break
        middle = (low[wide] + high[wide]) // 2
        less = into[middle] < keys[wide]
        low[wide[less]] = middle[less] + 1
        high[wide[~less]] = middle[~less]
    there = low < len(into)
    found[there] = into[low[there]] == keys[there]
    return found


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The ascending places in both lists; the shorter list's are looked up in the longer."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return small[gallop(small, large)]


def without(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The places of ``a`` that ``b`` lacks."""
    if len(a) <= len(b):
        return a[~gallop(a, b)]
    keep = np.ones(len(a), dtype=bool)
    keep[np.searchsorted(a, common(a, b))] = False
    return a[keep]


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The places of either list: what the longer list lacks is put into its places there."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    new = small[~gallop(small, large)]
    return np.insert(large, np.searchsorted(large, new), new)


def subset_sizes(lists: DataFrame, filters: list[str]) -> DataFrame:
    """(part, earlier, filter, kept, removed, redundant, good_lost, toxic_lost) for every filter and every set of
    other filters applied before it, as a bit mask of the filters' numbers. Rows of chunks are added up."""
    k = len(filters)
    masks = sorted(range(1 << k), key=lambda m: (m.bit_count(), m))
    schema = "part string, earlier int, filter int, kept long, removed long, redundant long, good_lost long, toxic_lost long"

    def sizes(n: int, posting: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> list[tuple]:
        unions = {0: np.zeros(0, dtype=np.int32)}
        for mask in masks[1:]:
            top = max((f for f in range(k) if mask >> f & 1), key=lambda f: len(posting[f]))
            unions[mask] = union(unions[mask & ~(1 << top)], posting[top])
        out = []
        for mask in masks:
            for f in range(k):
                if mask >> f & 1:
                    continue
                gone = without(posting[f], unions[mask])
                out.append((mask, f, n - len(unions[mask]) - len(gone), len(gone), len(posting[f]) - len(gone),
                            len(common(gone, good)), len(common(gone, toxic))))
        return out

    def run(batches):
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            found, parts = [], []
            for i in range(batch.num_rows):
                posting = [c[i].values.to_numpy() for c in columns[2:]]
                rows = sizes(columns[1][i].as_py(), posting[:k], *posting[k:])
                found += rows
                parts += [columns[0][i].as_py()] * len(rows)
            if found:
                numbers = [pa.array(x, pa.int32() if j < 2 else pa.int64()) for j, x in enumerate(zip(*found, strict=True))]
                yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), *numbers],
                                                 names=["part", "earlier", "filter", "kept", "removed", "redundant", "good_lost", "toxic_lost"])

    found = lists.select("part", "n", *filters, "good", "toxic").mapInArrow(run, schema)
    return found.groupBy("part", "earlier", "filter").agg(*[F.sum(c).alias(c) for c in ("kept", "removed", "redundant", "good_lost", "toxic_lost")])


def audit_orders(sizes: DataFrame, filters: list[str]) -> DataFrame:
    """One row per part, order and step: ``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``,
    ``unique_fails``, ``good_lost``, ``toxic_lost`` and ``shapley``, the filter's removals over all orders."""
    spark, k = sizes.sparkSession, len(filters)
    steps = [("".join(filters[f] for f in order), i + 1, sum(1 << f for f in order[:i]), order[i])
             for order in permutations(range(k)) for i in range(k)]
    orders = spark.createDataFrame(steps, "filter_order string, step int, earlier int, filter int")
    # in how many orders a set comes right before a filter: its own orders times those of the rest
    times = F.factorial(F.bit_count("earlier")) * F.factorial(F.lit(k - 1) - F.bit_count("earlier"))
    # the earlier filters are all but the filter itself
    alone = F.expr(f"earlier = {(1 << k) - 1} - shiftleft(1, filter)")
    per_filter = sizes.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * times).alias("shapley"), F.max(F.when(alone, F.col("removed"))).alias("unique_fails"))
    full = sizes.join(per_filter, ["part", "filter"])
    return full.join(orders, ["earlier", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(flags: DataFrame, filters: list[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Audit of flagged rows (``id``, ``part``, the filters' columns, ``good``, ``toxic``); the posting lists are
    written once to the scratch folder. Starts a job."""
    lists = materialise(posting_lists(flags, filters, chunk_rows), "postings")
    return audit_orders(subset_sizes(lists, filters), filters)


def audit_documents(docs: DataFrame, labels: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The five filters A to E over documents; E fails later copies of a text."""
    flags = materialise(corpus_flags(docs), "flags")
    return audit(with_labels(later_copies(flags), labels), list("ABCDE"), chunk_rows)
