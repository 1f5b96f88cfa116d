"""Previews: the only row limit of the library, as the feature itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tripstar.functions.columns import timestamps_as_strings


def preview(df: DataFrame, order_by: Sequence[str], n: int = 50) -> DataFrame:
    """Top ``n`` rows in a total order, timestamps rendered as text (for clients that mishandle
    timestamp types). ``orderBy + limit`` plans as a per-task top-n heap plus one small merge."""
    return timestamps_as_strings(df.orderBy(*order_by).limit(n))
