"""Column-level building blocks (pure Spark SQL expressions, no Python UDFs)."""

from tripstar.functions.columns import (  # noqa: F401
    date_key,
    geometry_moments,
    moments_centroid,
    spatial_cell,
    timestamps_as_strings,
    whole_seconds_between,
)
