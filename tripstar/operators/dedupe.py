"""Deterministic de-duplication on a natural key.

The survivor of each key group is the row with the smallest tie-break tuple (ascending, NULLs
first), so any run, any input order and any engine keep the same row. It is computed as an
aggregate -- ``min(struct(tie-break..., rest...))`` per key -- rather than ``row_number()`` over a
window: the aggregate has a map-side partial step, so a hot key (even a third of all rows)
collapses to one row per map task before the shuffle, while a window would sort the whole hot
group inside one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: Iterable[str], order_by: Iterable[str] | None = None, count_col: str | None = None) -> DataFrame:
    """One row per distinct ``keys``; survivor = smallest ``order_by`` tuple (default: every
    non-key column in schema order). Remaining columns break any tie last. Output keeps the
    input column order; ``count_col`` adds the number of rows that a survivor stands for."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by is not None else rest
    payload = order + [c for c in rest if c not in order]
    if not payload and count_col is None:
        return df.dropDuplicates(keys)
    aggs = [F.min(F.struct(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(payload)])).alias("_best")] if payload else []
    if count_col is not None:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*[
        F.col(f"`{c}`") if c in keys else F.col(f"_best._{payload.index(c)}").alias(c) for c in df.columns
    ], *([count_col] if count_col is not None else []))
