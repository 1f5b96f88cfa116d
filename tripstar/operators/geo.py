"""Zone reference and geospatial enrichment.

* zone lookup standardisation (rename, ``N/A`` -> NULL),
* per-geometry centroid / area from GeoJSON (``from_json`` + higher-order functions),
* combination of several geometry rows per zone by summing moments (an ordinary aggregate),
* the zone reference table (dimension rows, one per lookup id), its spatial cell,
* role-playing pickup / dropoff enrichment of rides and rides per spatial cell.

Cells are computed once per zone and joined, never per ride.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar import schemas
from tripstar.functions.columns import geometry_moments, moments_centroid, spatial_cell
from tripstar.functions.projection import LambertConic, geojson_to_degrees
from tripstar.operators.standardise import rename_columns

# Default grid level of zone cells: 2^16 columns over 360 degrees, ~0.0055 degrees (~500 m at
# New York's latitude) per cell, the scale of a resolution-8 hexagon.
DEFAULT_CELL_LEVEL = 16


def standardise_zone_lookup(lookup: DataFrame) -> DataFrame:
    """``LocationID, Borough, Zone, service_zone`` -> ``location_id, borough, zone_name,
    service_zone``; the text ``N/A`` (missing in the published file) becomes NULL."""
    df = rename_columns(lookup, schemas.ZONE_LOOKUP_RENAMES)
    text = ("borough", "zone_name", "service_zone")
    return df.select(
        F.col("location_id").try_cast("int").alias("location_id"),
        *[F.when(F.col(c) != "N/A", F.col(c)).alias(c) for c in text],
    )


def project_geometry(geometry: DataFrame, projection: LambertConic) -> DataFrame:
    """Geometry rows in map coordinates -> degrees, before anything is computed from them: the area centroid
    of the projected shape is another point, and cells and the published GeoJSON are in degrees."""
    return geometry.withColumn("polygon_geojson", geojson_to_degrees("polygon_geojson", projection))


def geometry_centroids(geometry: DataFrame, level: int = DEFAULT_CELL_LEVEL) -> DataFrame:
    """Per geometry row: ``area`` (square degrees), ``centroid_lat``, ``centroid_lon`` (area
    centroid, may lie outside the shape), and ``geo_hash`` = spatial cell of the centroid.
    Zero-area or unparsable geometry gives NULLs."""
    # the moments struct is materialised once as a column; its fields are read afterwards
    out = geometry.withColumn("_m", geometry_moments("polygon_geojson"))
    area, lat, lon = moments_centroid(F.col("_m.a2"), F.col("_m.mx"), F.col("_m.my"))
    out = out.withColumns({"area": area, "centroid_lat": lat, "centroid_lon": lon}).drop("_m")
    out = out.withColumn("geo_hash", spatial_cell("centroid_lat", "centroid_lon", level))
    return out.withColumn("h3_resolution", F.when(F.col("geo_hash").isNotNull(), F.lit(level)))


def zone_geometry_join(lookup: DataFrame, geometry: DataFrame, level: int = DEFAULT_CELL_LEVEL) -> DataFrame:
    """Lookup LEFT JOIN geometry on ``location_id`` with per-geometry centroid and cell.

    A zone with several geometry rows yields several rows (fan-out); a zone without any yields
    one row with NULL geometry columns. The geometry is the large side and its texts are far larger than
    the planner's guess: it is merged, never broadcast. Zones with geometry and those without are joined
    apart, as the parts of a hot zone can be dealt over tasks in an inner join only."""
    geo = geometry_centroids(geometry, level).select(
        "location_id", "polygon_geojson", "centroid_lat", "centroid_lon", "geo_hash", "h3_resolution")
    added = [c for c in geo.columns if c != "location_id"]
    found = lookup.join(geo.hint("merge"), "location_id").select(*lookup.columns, *added)
    # ids without any geometry row, told on the geometry's ids alone
    ids = geometry.select("location_id").distinct()
    missing = lookup.join(ids, "location_id", "left_anti").select(
        *lookup.columns, *[F.lit(None).cast(geo.schema[c].dataType).alias(c) for c in added])
    return found.unionByName(missing)


def zones_without_geometry(lookup: DataFrame, geometry: DataFrame) -> DataFrame:
    """Lookup rows with no geometry: no geometry row, or none with a polygon."""
    return lookup.join(geometry.filter("polygon_geojson IS NOT NULL").select("location_id").distinct(), "location_id", "left_anti")


def combine_zone_geometry(geometry: DataFrame, level: int = DEFAULT_CELL_LEVEL) -> DataFrame:
    """One row per ``location_id``: centroid of the union of all its geometry rows (moments
    summed, i.e. area-weighted), ``parts``, and as ``polygon_geojson`` the largest part (ties:
    smallest text). Moments are added as decimals, so the cell of a centroid does not depend on the order
    of the parts. ``sum``/``max`` are partial aggregates, so a zone with very many parts never
    gathers them in one place."""
    parts = geometry.select("location_id", "polygon_geojson", geometry_moments("polygon_geojson").alias("_m"))
    parts = parts.select(
        "location_id", "polygon_geojson",
        F.col("_m.a2").alias("a2"), F.col("_m.mx").alias("mx"), F.col("_m.my").alias("my"),
        F.round(F.abs(F.col("_m.a2")) / 2.0, 8).alias("area8"),
    )
    agg = parts.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("parts"),
        *[F.sum(F.col(m).cast("decimal(38,15)")).cast("double").alias(m) for m in ("a2", "mx", "my")],
        F.max(F.struct("area8", "polygon_geojson")).alias("largest"),
    )
    area, lat, lon = moments_centroid(F.col("a2"), F.col("mx"), F.col("my"))
    return agg.select(
        "location_id", "parts",
        F.col("largest.polygon_geojson").alias("polygon_geojson"),
        area.alias("area"), lat.alias("centroid_lat"), lon.alias("centroid_lon"),
        spatial_cell(lat, lon, level).alias("geo_hash"),
        F.lit(level).alias("h3_resolution"),
    )


def build_zone_reference(lookup: DataFrame, geometry: DataFrame, level: int = DEFAULT_CELL_LEVEL) -> DataFrame:
    """Zone reference / ``dim_zone`` rows: one per lookup id (a primary key, unlike the raw
    fan-out join), 9 columns in dimension order. ``h3_resolution`` is NULL when a zone has no
    geometry, as its cell is."""
    combined = combine_zone_geometry(geometry, level).drop("parts", "area")
    out = lookup.join(combined, "location_id", "left")
    out = out.withColumn("h3_resolution", F.when(F.col("geo_hash").isNotNull(), F.col("h3_resolution")))
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.DIM_ZONE.fields])


def enrich_pickup_dropoff(rides: DataFrame, zones: DataFrame,
                          pu_col: str = "pu_location_id", do_col: str = "do_location_id") -> DataFrame:
    """Add ``start_lat/start_lon/start_geo_hash`` (pickup zone) and ``end_lat/end_lon/
    end_geo_hash`` (dropoff zone): the zone dimension joined twice in two roles. ``zones`` must
    be unique per ``location_id`` (a dimension); it is projected to 4 columns, without
    the polygons, and left to the planner: from a published dimension it is broadcast by its size."""
    z = zones.select("location_id", "centroid_lat", "centroid_lon", "geo_hash")
    pu = z.withColumnsRenamed({"location_id": pu_col, "centroid_lat": "start_lat",
                               "centroid_lon": "start_lon", "geo_hash": "start_geo_hash"})
    do = z.withColumnsRenamed({"location_id": do_col, "centroid_lat": "end_lat",
                               "centroid_lon": "end_lon", "geo_hash": "end_geo_hash"})
    return rides.join(pu, pu_col, "left").join(do, do_col, "left").select(
        *rides.columns, "start_lat", "start_lon", "start_geo_hash", "end_lat", "end_lon", "end_geo_hash")


def rides_by_cell(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Rides per pickup spatial cell (NULL cell = zone unknown or without geometry): rides are
    aggregated per zone first, then mapped to cells and re-aggregated."""
    per_zone = fact.groupBy("pu_location_id").agg(F.count(F.lit(1)).alias("rides"))
    cells = zones.select(F.col("location_id").alias("pu_location_id"), "geo_hash")
    return (per_zone.join(cells, "pu_location_id", "left")
            .groupBy(F.col("geo_hash").alias("cell"))
            .agg(F.sum("rides").alias("rides"), F.count(F.lit(1)).alias("zones")))
