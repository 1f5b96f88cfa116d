"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups are equal texts (null counts as empty). Their sizes are added up by a 128-bit digest of the
text, with partial sums before the shuffle. Packing needs the sizes in falling order at one place, so
the groups are first brought down to a number of units that does not grow with the data: a group of
at least ``1 / (shards * fine)`` of all bytes is a unit of its own (there can be no more than
``shards * fine`` of those); all smaller groups are dealt by their digest over ``shards * fine``
bundles, each an indivisible unit made of whole groups. At most ``2 * shards * fine`` units, a bound
set by parameters alone, reach the driver.

Units, largest first, enter the bin whose remaining capacity is the tightest that still holds them,
found by a descent in a balanced (treap) tree of remaining capacities. With a given capacity this
minimises the number of fixed-capacity shards (:func:`best_fit_decreasing`); for a given number of
shards the smallest capacity that needs no more bins is found by bisection, which makes the shards
near equal (:func:`equal_shards`). A unit larger than an even share gets a bin of its own.

Positions inside a shard are counted over ``(shard, cell)`` groups, ``cell`` being a hash of the id,
so that one shard or one huge group of copies is numbered by many tasks.

Defined cases: null texts have size ``overhead`` and CRC 0; null ids are kept and numbered like others;
repeated rows are rows of one group and get slots of their own; an empty table gives no rows; fewer
groups than shards leave shards empty; other columns are not looked at.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS, FINE, OVERHEAD = 24, 512, 8
CELLS = 256


class CapacityTree:
    """Treap of (remaining capacity, bin); all operations take logarithmic expected time."""

    def __init__(self, seed: int = 7):
        self.root, self.random = None, random.Random(seed)

    def _split(self, node, key):
        """Nodes with smaller keys, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, remaining: int, bin_no: int) -> None:
        left, right = self._split(self.root, (remaining, bin_no))
        self.root = self._merge(self._merge(left, [(remaining, bin_no), self.random.random(), None, None]), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest (remaining, bin) with ``remaining >= size``."""
        best, node = None, self.root
        while node is not None:
            if node[0] >= (size, -1):
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is None:
            return None
        left, rest = self._split(self.root, best)
        _, right = self._split(rest, (best[0], best[1] + 1))
        self.root = self._merge(left, right)
        return best


def best_fit_decreasing(sizes: list[int], capacity: int, max_bins: int | None = None) -> list[int] | None:
    """Bin of each size (given in falling order); a size beyond the capacity gets a bin of its own.
    None if more than ``max_bins`` bins would be opened."""
    tree, out, bins = CapacityTree(), [], 0
    for size in sizes:
        slot = tree.take(size)
        if slot is None:
            if max_bins is not None and bins >= max_bins:
                return None
            slot = (max(capacity, size), bins)
            bins += 1
        tree.add(slot[0] - size, slot[1])
        out.append(slot[1])
    return out


def equal_shards(sizes: list[int], shards: int) -> list[int]:
    """Bins of falling ``sizes`` under the smallest capacity that best-fit-decreasing fills with at
    most ``shards`` bins. Sizes beyond an even share of what is left take a bin each and leave the
    others to share the rest evenly."""
    if not sizes:
        return []
    if shards > 1 and len(sizes) > 1 and sizes[0] * shards > sum(sizes):
        return [0, *(1 + b for b in equal_shards(sizes[1:], shards - 1))]
    low, high = max(1, -(-sum(sizes) // shards)), sum(sizes)
    best = best_fit_decreasing(sizes, high, shards)
    while low < high:
        mid = (low + high) // 2
        found = best_fit_decreasing(sizes, mid, shards)
        if found is None:
            low = mid + 1
        else:
            best, high = found, mid
    return best


def assign_shards(docs: DataFrame, shards: int = SHARDS, capacity: int | None = None, fine: int = FINE,
                  overhead: int = OVERHEAD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id column, ``size``, ``text_crc32``, ``shard`` and ``slot``. With
    ``capacity`` the number of shards follows from it; else ``shards`` near-equal shards are made."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.md5(text.cast("binary")).alias("digest"),
        (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(CELLS)).cast("int").alias("cell"))
    sizes = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    share = -(-total // capacity) if capacity else shards
    limit = max(1, total // (share * fine)) if total else 1
    bundle = F.concat(F.lit("b"), F.pmod(F.xxhash64("digest"), F.lit(share * fine)).cast("string"))
    members = sizes.select("digest", "bytes", F.when(F.col("bytes") > limit, F.col("digest")).otherwise(bundle).alias("unit"))
    units = sorted(((r["bytes"], r["unit"]) for r in members.groupBy("unit").agg(F.sum("bytes").alias("bytes")).toLocalIterator()),
                   key=lambda u: (-u[0], u[1]))
    falling = [b for b, _ in units]
    bins = best_fit_decreasing(falling, capacity) if capacity else equal_shards(falling, shards)
    spark = docs.sparkSession
    plan = F.broadcast(spark.createDataFrame([(u, s) for (_, u), s in zip(units, bins, strict=True)], "unit string, shard int"))
    big = plan.filter(~F.col("unit").startswith("b") | (F.length("unit") == 32)).select(F.col("unit").alias("digest"), F.col("shard").alias("own"))
    placed = (rows.join(F.broadcast(big), "digest", "left").withColumn("unit", bundle)
              .join(plan, "unit", "left").withColumn("shard", F.coalesce("own", "shard")))
    placed = placed.select("id", "size", "text_crc32", "shard", "cell")
    return number_slots(placed).select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")


def number_slots(placed: DataFrame) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard, by cells first and ids inside a cell."""
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "cell").orderBy("id", "text_crc32", "size")
    return placed.withColumn("at", F.row_number().over(inside) - 1).join(starts, ["shard", "cell"]).withColumn(
        "slot", (F.col("start") + F.col("at")).cast("long"))
