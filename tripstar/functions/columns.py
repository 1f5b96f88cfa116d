"""Column expressions shared by the operators.

All of these compile to native Catalyst expressions (whole-stage codegen where Spark supports
it); the GeoJSON geometry maths uses ``from_json`` plus higher-order array functions instead of
a per-row Python geometry library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(ts: Column | str) -> Column:
    """``yyyyMMdd`` as INT, computed arithmetically (no string formatting per row)."""
    ts = _c(ts)
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def whole_seconds_between(start: Column | str, end: Column | str) -> Column:
    """Seconds from ``start`` to ``end``, each side truncated to whole seconds first
    (``unix_timestamp`` semantics; works for TIMESTAMP and TIMESTAMP_NTZ)."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))).cast("bigint")


def spatial_cell(lat: Column | str, lon: Column | str, level: int) -> Column:
    """Grid cell id ``"level/x/y"`` of a point on an equirectangular 2^level x 2^level grid.

    NULL when either coordinate is NULL, NaN or out of range (the null guard of a point-to-cell
    function). The top/right edges (lat = 90, lon = 180) fall into the last cell."""
    if not 0 <= level <= 30:
        raise ValueError(f"level must be in [0, 30], got {level}")
    lat, lon = _c(lat), _c(lon)
    n = float(2**level)
    x = F.least(F.floor((lon + 180.0) / 360.0 * n), F.lit(2**level - 1).cast("bigint"))
    y = F.least(F.floor((lat + 90.0) / 180.0 * n), F.lit(2**level - 1).cast("bigint"))
    ok = (
        lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
        & lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    )
    return F.when(ok, F.concat_ws("/", F.lit(str(level)), x.cast("string"), y.cast("string")))


# ---------------------------------------------------------------------------------------------
# GeoJSON polygon moments
# ---------------------------------------------------------------------------------------------

_RING = T.ArrayType(T.ArrayType(T.DoubleType()))
GEOJSON_POLYGON = T.ArrayType(_RING)
GEOJSON_MULTI = T.ArrayType(GEOJSON_POLYGON)
GEOJSON_ENVELOPE = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])


def _zero() -> Column:
    return F.struct(F.lit(0.0).alias("a2"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))


def _ring_moments(ring: Column, is_outer: Column) -> Column:
    """Shoelace moments of one closed ring: ``struct(a2, mx, my)`` with ``a2`` twice the signed
    area and ``mx``/``my`` = ``a2`` * centroid. One ``aggregate`` over the edge indices (no
    intermediate arrays); coordinates are taken relative to the ring's first point to avoid
    cancellation. Outer rings count positive and holes negative whatever their winding."""
    ox, oy = ring[0][0], ring[0][1]
    n = F.size(ring)
    edges = F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))

    def step(acc: Column, i: Column) -> Column:
        p, q = ring[i], ring[i + 1]
        x1, y1, x2, y2 = p[0] - ox, p[1] - oy, q[0] - ox, q[1] - oy
        c = x1 * y2 - x2 * y1
        return F.struct(
            (acc.a2 + c).alias("a2"),
            (acc.mx + (x1 + x2) * c).alias("mx"),
            (acc.my + (y1 + y2) * c).alias("my"),
        )

    local = F.aggregate(edges, _zero(), step)
    sign = F.signum(local.a2) * F.when(is_outer, F.lit(1.0)).otherwise(F.lit(-1.0))
    return F.struct(
        (sign * local.a2).alias("a2"),
        (sign * (local.a2 * ox + local.mx / 3.0)).alias("mx"),
        (sign * (local.a2 * oy + local.my / 3.0)).alias("my"),
    )


def _add(acc: Column, m: Column) -> Column:
    return F.struct((acc.a2 + m.a2).alias("a2"), (acc.mx + m.mx).alias("mx"), (acc.my + m.my).alias("my"))


def geometry_moments(geojson: Column | str) -> Column:
    """``struct(a2, mx, my)`` of a GeoJSON Polygon / MultiPolygon string (ring 0 of each polygon
    is its shell, later rings are holes). NULL for NULL, unparsable or other geometry types.
    Moments add up across geometries, so several parts of one zone combine with ``sum``."""
    env = F.from_json(_c(geojson), GEOJSON_ENVELOPE)
    polygons = (
        F.when(env.type == "Polygon", F.array(F.from_json(env.coordinates, GEOJSON_POLYGON)))
        .when(env.type == "MultiPolygon", F.from_json(env.coordinates, GEOJSON_MULTI))
    )
    per_polygon = F.transform(
        polygons,
        lambda poly: F.aggregate(
            F.transform(poly, lambda ring, i: _ring_moments(ring, i == 0)), _zero(), _add
        ),
    )
    return F.aggregate(per_polygon, _zero(), _add)


def moments_centroid(a2: Column, mx: Column, my: Column) -> tuple[Column, Column, Column]:
    """``(area, lat, lon)`` from summed moments; zero area gives NULL centroid."""
    return F.abs(a2) / 2.0, F.try_divide(my, a2), F.try_divide(mx, a2)


def timestamps_as_strings(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP / TIMESTAMP_NTZ column to STRING (client-side preview helper)."""
    ts_types = (T.TimestampType, T.TimestampNTZType)
    return df.select([
        F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, ts_types) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
