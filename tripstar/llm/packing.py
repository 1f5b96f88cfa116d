"""Packing with a controlled mixture: deficit round-robin over source queues.

Every document becomes token ids and an end id; the documents of a source form its queue. Each window
of ``window`` tokens takes from every live queue its target share, in whole tokens; what rounding
leaves over or short is the queue's deficit, carried to the next window, so after any number of
windows a queue is within one token per queue of its target. The order of service is the one of the
virtual finishing times ``(j + 1/2) / weight`` of a queue's j-th token. That makes the tokens taken
from each queue before any window a closed expression of the window's number (:class:`Mixture`), so
each partition starts with the carried deficits of its first window without seeing other windows.
When a queue runs dry the rest share its part (a new phase; there are at most as many phases as
queues). Without stated targets the shares are those of the corpus, so all queues end together.

Documents are cut at window borders only. The remainder after the last full window is laid out in
sequences whose lengths are powers of two, which need no padding.

Order inside a queue: cells (a hash of the id) first, ids inside a cell. Only token sums by queue and
cell, ``cells`` times the number of sources, reach the driver; texts and ids never do.

Defined cases: a null or empty text is the end id alone; null sources form a queue of their own; null
ids are packed like others; repeated rows are packed once each; an empty table gives no rows; other
columns are not looked at. Special-token strings in a text get the ids that the tokenizer gives them.
"""

from __future__ import annotations

import pickle
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.llm.common import materialise
from tripstar.llm.encoding import id_bytes, process_tokenizer

WINDOW, END_ID, CELLS = 2048, 1, 4096


class Mixture:
    """Tokens served from each queue before any point of the packed stream."""

    def __init__(self, totals: list[int], targets: list[float] | None = None):
        share = list(map(Fraction, targets or totals))
        whole = sum(share) or Fraction(1)
        self.total = sum(totals)
        bits = max(8, min(30, 60 - self.total.bit_length()))  # 2 * tokens * weight must fit 63 bits
        self.weights = np.array([max(1, round(x / whole * (1 << bits))) for x in share], dtype=np.int64)
        left = list(totals)
        done, served = 0, [0] * len(totals)
        self.phases: list[tuple[int, np.ndarray, np.ndarray]] = []  # first token, served before, live weights
        while any(left):
            live = [i for i, r in enumerate(left) if r]
            w = [int(x) for x in self.weights]
            end = min(Fraction(2 * left[i] + 1, 2 * w[i]) for i in live)
            weights = np.array([w[i] if left[i] else 0 for i in range(len(w))], dtype=np.int64)
            self.phases.append((done, np.array(served, dtype=np.int64), weights))
            for i in live:
                # tokens j of the queue with (2j + 1) / 2w < end
                n = max(0, -((w[i] * 2 * end.numerator - end.denominator) // (-2 * end.denominator)))
                n = min(n, left[i])
                left[i] -= n
                served[i] += n
                done += n
        self.first = np.array([p[0] for p in self.phases], dtype=np.int64)

    def served(self, tokens: np.ndarray) -> np.ndarray:
        """For each stream length (a row), the tokens that each queue (a column) has given to it."""
        tokens = np.minimum(np.asarray(tokens, dtype=np.int64), self.total)
        out = np.zeros((len(tokens), len(self.weights)), dtype=np.int64)
        if not self.phases:
            return out
        phase = np.searchsorted(self.first, tokens, side="right") - 1
        for p in np.unique(phase):
            rows = np.flatnonzero(phase == p)
            begin, before, w = self.phases[p]
            out[rows] = before + self._share(tokens[rows] - begin, w)
        return out

    @staticmethod
    def _share(k: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The first k tokens by virtual finishing time: how many of each queue."""
        live = np.flatnonzero(w)
        v, whole = w[live], int(w.sum())
        n = (2 * k[:, None] * v + whole - 1) // (2 * whole)
        short = k - n.sum(axis=1)
        while (short > 0).any():
            rows = np.flatnonzero(short > 0)
            after = ((2 * n[rows] + 1) * whole - 2 * k[rows, None] * v) / v
            n[rows, after.argmin(axis=1)] += 1
            short[rows] -= 1
        while (short < 0).any():
            rows = np.flatnonzero(short < 0)
            last = ((2 * n[rows] - 1) * whole - 2 * k[rows, None] * v) / v
            last[n[rows] == 0] = -np.inf
            pick = len(live) - 1 - last[:, ::-1].argmax(axis=1)
            n[rows, pick] -= 1
            short[rows] += 1
        out = np.zeros((len(k), len(w)), dtype=np.int64)
        out[:, live] = n
        return out

    def window_of(self, queue: int, token: int, window: int) -> int:
        """The window that takes the queue's token of this number."""
        low, high = 0, max(0, -(-self.total // window) - 1)
        while low < high:
            points = np.unique(np.linspace(low, high, 33, dtype=np.int64))
            passed = self.served((points + 1) * window)[:, queue] > token
            at = int(passed.argmax()) if passed.any() else len(points) - 1
            high = int(points[at])
            low = int(points[at - 1]) + 1 if at else low
            if at == 0:
                break
        return high


def tail_cuts(length: int) -> list[int]:
    """Ends of the power-of-two sequences that make up a last window of this length."""
    ends, at = [], 0
    for bit in reversed(range(length.bit_length())):
        if length >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, ids, n): ids as little-endian bytes, the end id included, n their number."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, source string, ids binary, n long"
    picked = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))

    def run(batches):
        coder = process_tokenizer(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, n = coder.encode_flat(part.column(2), end_id)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), id_bytes(ids, n), pa.array(n)],
                                                 names=["id", "source", "ids", "n"])

    return picked.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, targets: dict[str | None, float] | None = None,
         end_id: int = END_ID, cells: int = CELLS, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", with_ids: bool = False) -> DataFrame:
    """One row per piece: the id column, ``source``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, if asked for, ``ids`` (array of int).
    ``targets`` gives the token share of every source; the default is the corpus' own."""
    wide = _wide(tokenizer)
    tokens = materialise(tokenize(docs, tokenizer, end_id, id_col, text_col, source_col).withColumn(
        "cell", F.pmod(F.xxhash64("id", F.crc32("ids")), F.lit(cells)).cast("int")), "tokens")
    sums = tokens.groupBy("source", "cell").agg(F.sum("n").alias("n")).collect()
    names = sorted({r["source"] for r in sums}, key=lambda s: (s is not None, s or ""))
    number = {s: i for i, s in enumerate(names)}
    totals, starts = [0] * len(names), {}
    for r in sorted(sums, key=lambda r: (number[r["source"]], r["cell"])):
        q = number[r["source"]]
        starts[(q, r["cell"])] = totals[q]
        totals[q] += r["n"]
    mix = Mixture(totals, [targets.get(s, 0) for s in names] if targets else None)
    full, rest = divmod(mix.total, window)
    cuts = tail_cuts(rest)
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps((mix, number, starts)))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {id_type}, source string, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long" + (", ids array<int>" if with_ids else ""))
    dtype = "<u4" if wide else "<u2"

    def place(batches):
        mix, number, starts = pickle.loads(shared.value)
        state, at = None, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                sources, cells_, n = (part.column(i).to_pylist() for i in (1, 4, 3))
                queue, begin = [], []
                for source, cell, size in zip(sources, cells_, n, strict=True):
                    if (source, cell) != state:
                        state, at = (source, cell), starts[(number[source], cell)]
                    queue.append(number[source])
                    begin.append(at)
                    at += size
                tokens_ = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype=dtype).astype("<u4")
                begin, n, queue = (np.array(x, dtype=np.int64) for x in (begin, n, queue))
                first = np.concatenate([[0], np.cumsum(n)])
                # rows of one queue that follow one another without a gap share their windows
                edge = np.flatnonzero((queue[1:] != queue[:-1]) | (begin[1:] != begin[:-1] + n[:-1])) + 1
                for x, y in zip([0, *edge], [*edge, len(n)], strict=True):
                    row, start, length, sequence, offset = lay(mix, int(queue[x]), begin[x:y], n[x:y])
                    row += x
                    where = first[row] + start
                    view = memoryview(tokens_).cast("B")
                    crc = [zlib.crc32(view[a:b]) for a, b in zip((where * 4).tolist(), ((where + length) * 4).tolist(), strict=True)]
                    cols = [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)), pa.array(start), pa.array(length),
                            pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(sequence), pa.array(offset)]
                    names = ["id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                    if with_ids:
                        names.append("ids")
                        cols.append(pa.array([tokens_[a:a + c].astype(np.int32) for a, c in zip(where, length, strict=True)], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(cols, names=names)

    def lay(mix, q, begin, n):
        """Pieces of consecutive documents of a queue: row, start, length, sequence, offset."""
        last = int(begin[-1] + n[-1])
        low, high = mix.window_of(q, int(begin[0]), window), mix.window_of(q, last - 1, window)
        pieces = []
        for base in range(low, high + 1, 4096):
            top = min(high, base + 4095)
            served = mix.served(np.arange(base, top + 2, dtype=np.int64) * window)
            own = served[:, q]
            before = np.diff(served[:, :q].sum(axis=1))
            borders = own
            if top == full:
                # the last window's sequences end inside it
                inner = own[-2] + np.array(cuts, dtype=np.int64) - before[-1]
                borders = np.concatenate([own, inner[(inner > own[-2]) & (inner < own[-1])]])
            a, b = max(int(begin[0]), int(own[0])), min(last, int(own[-1]))
            points = np.unique(np.concatenate([[a, b], borders, begin]))
            points = points[(points >= a) & (points <= b)]
            if len(points) < 2:
                continue
            at = points[:-1]
            k = np.searchsorted(own, at, side="right") - 1
            row = np.searchsorted(begin, at, side="right") - 1
            offset, sequence = before[k] + at - own[k], k + base
            tail = np.flatnonzero(sequence == full)
            if len(tail):
                j = np.searchsorted(cuts, offset[tail], side="right")
                sequence[tail] += j
                offset[tail] -= np.array([0, *cuts])[j]
            pieces.append((row, at - begin[row], np.diff(points), sequence, offset))
        return tuple(np.concatenate(x) for x in zip(*pieces, strict=True))

    # neighbouring cells meet in a task, so that its documents share windows
    ordered = tokens.repartitionByRange("source", "cell").sortWithinPartitions("source", "cell", "id")
    return ordered.select("id", "source", "ids", "n", "cell").mapInArrow(place, schema).withColumnRenamed("id", id_col)


def _wide(tokenizer: str) -> bool:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).get_vocab_size() > 1 << 16
