"""Ride-shaped inputs derived by Spark from the shared TPC-H-like tables.

The shared test tables hold no ride data, so the bronze ride feed, the zone lookup and the zone
geometries are *derived* from ``lineitem``, ``part`` and ``region``. Every derivation is a plain
projection of a full table scan, so its work grows with the tables. The exact same definitions
appear as SQL in the oracle, which is how both engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _add_seconds(seconds: Column, ts: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def bronze_rides(spark: SparkSession, sf_dir: str, with_month: bool = False) -> DataFrame:
    """Raw HVFHV-shaped ride rows: one per ``lineitem`` row, plus a re-sent copy of every
    line whose order key is a multiple of 20 (duplicates for the dedupe step, tips + 1). First lines
    of some orders break one rule each or leave its column NULL (``l_orderkey % 500``, see
    :func:`_spoiled`). ``with_month`` adds ``source_month``, the month of the ship date: the file a
    row came in, whatever its pickup time.

    The copy is produced with ``explode`` over a one- or two-element array, so ``lineitem``
    is scanned once (a ``union`` would scan it twice)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )
    copies = F.when(F.col("l_orderkey") % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    b = li.withColumn("dup", F.explode(copies)).withColumns({
        "off_s": ((F.col("l_orderkey") * 37 + F.col("l_linenumber") * 3607) % 86400).cast("int"),
        "q": F.col("l_quantity").cast("int"),
    })
    ln, q = F.col("l_linenumber"), F.col("q")
    b = b.withColumn("request_datetime", _add_seconds(F.col("off_s"), F.col("l_shipdate")))
    b = b.withColumn(
        "pickup_datetime",
        _add_seconds(F.when((ln == 7) & (q > 45), F.lit(-30)).otherwise(120 + ln), F.col("request_datetime")),
    )
    b = b.withColumn(
        "dropoff_datetime",
        _add_seconds(F.when((ln == 6) & (q == 1), F.lit(0)).otherwise(q * 60 + ln), F.col("pickup_datetime")),
    )
    supp = F.col("l_suppkey")
    out = b.select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        F.when(supp % 50 == 49, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("HV000"), (2 + supp % 4).cast("string"))).alias("hvfhs_license_num"),
        F.concat(F.lit("B0"), (supp % 9).cast("string")).alias("dispatching_base_num"),
        F.concat(F.lit("B0"), (supp % 7).cast("string")).alias("originating_base_num"),
        "request_datetime",
        F.when(F.col("l_returnflag") == "R", F.lit(None))
        .otherwise(_add_seconds(F.lit(60), F.col("request_datetime"))).alias("on_scene_datetime"),
        "pickup_datetime",
        "dropoff_datetime",
        (F.col("l_partkey") % 267).cast("bigint").alias("PULocationID"),
        (1 + supp % 265).cast("bigint").alias("DOLocationID"),
        ((q * 50 + F.col("l_orderkey") % 50) / F.lit(100.0)).alias("trip_miles"),
        (q * 60).cast("bigint").alias("trip_time"),
        F.col("l_extendedprice").alias("base_passenger_fare"),
        F.col("l_tax").alias("tolls"),
        F.col("l_discount").alias("bcf"),
        F.col("l_tax").alias("sales_tax"),
        F.lit(2.75).alias("congestion_surcharge"),
        F.when((ln == 3) & (F.col("l_returnflag") == "A"), F.lit(None).cast("double"))
        .otherwise(F.lit(2.5)).alias("airport_fee"),
        F.when((ln == 5) & (q == 13), F.lit(-1.0))
        .otherwise(F.col("l_discount") * 10 + F.col("dup")).alias("tips"),
        (F.col("l_extendedprice") * 0.75).alias("driver_pay"),
        F.lit("N").alias("shared_request_flag"),
        F.lit("N").alias("shared_match_flag"),
        F.lit(" ").alias("access_a_ride_flag"),
        F.lit("N").alias("wav_request_flag"),
        F.when(ln == 1, F.lit("Y")).otherwise(F.lit("N")).alias("wav_match_flag"),
    )
    out = _spoiled(out)
    month = [F.date_format("l_shipdate", "yyyy-MM").alias("source_month")] if with_month else []
    return out.select(*[c for c in out.columns if c not in ("l_orderkey", "l_linenumber", "l_shipdate")], *month)


# For l_orderkey % 500, the column spoiled on first lines and its value.
SPOILED = {
    1: ("request_datetime", None), 2: ("pickup_datetime", None), 3: ("dropoff_datetime", None),
    4: ("DOLocationID", 0), 5: ("DOLocationID", None), 6: ("PULocationID", None),
    7: ("trip_time", 0), 8: ("trip_time", None),
    **{10 + i: (c, -1.0) for i, c in enumerate((
        "trip_miles", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay"))},
    **{20 + i: (c, None) for i, c in enumerate((
        "trip_miles", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay"))},
}


def _spoiled(df: DataFrame) -> DataFrame:
    case = F.col("l_orderkey") % 500
    out = {}
    for c in df.columns:
        value = F.col(c)
        for k, (name, bad) in SPOILED.items():
            if name == c:
                value = F.when((F.col("l_linenumber") == 1) & (case == k), F.lit(bad).cast(df.schema[c].dataType)).otherwise(value)
        out[c] = value
    return df.withColumns(out)


# ---------------------------------------------------------------------------------------------
# Zones. One location id per ``part`` residue class: ids 1..265 (the TLC zone id range).
# ---------------------------------------------------------------------------------------------

# Ids without geometry in the derived geometry feed (as some TLC ids have none).
IDS_WITHOUT_GEOMETRY = (57, 264, 265)


def _zone_id() -> Column:
    return (1 + F.col("p_partkey") % 265).cast("int")


def zone_lookup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup as published (``LocationID, Borough, Zone, service_zone``; the text ``N/A``
    marks an unknown service zone). One row per distinct derived id; borough = region name."""
    ids = table(spark, sf_dir, "part").select(_zone_id().alias("LocationID")).distinct()
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    lid = F.col("LocationID")
    return ids.join(region, (lid % 5) == region.r_regionkey, "left").select(
        "LocationID",
        F.col("r_name").alias("Borough"),
        F.concat(F.lit("Zone_"), lid.cast("string")).alias("Zone"),
        F.when(lid >= 264, F.lit("N/A"))
        .when(lid == 1, F.lit("EWR"))
        .when(lid % 3 == 0, F.lit("Yellow Zone"))
        .when(lid % 3 == 1, F.lit("Boro Zone"))
        .otherwise(F.lit("Airports")).alias("service_zone"),
    )


def _deg(milli: Column) -> Column:
    """Milli-degrees (integer) -> fixed 3-decimal text, identical in Spark and DuckDB."""
    return (milli.cast("decimal(12,0)") / 1000).cast("decimal(10,3)").cast("string")


def _ring(points: list[tuple[str, str]]) -> Column:
    """GeoJSON ring text from columns that already hold the coordinate texts."""
    parts: list[Column] = [F.lit("[")]
    for i, (x, y) in enumerate(points):
        parts += [F.lit(",[" if i else "["), F.col(x), F.lit(","), F.col(y), F.lit("]")]
    parts.append(F.lit("]"))
    return F.concat(*parts)


def _square(x0: str, y0: str, x1: str, y1: str, clockwise: Column) -> Column:
    ccw = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return F.when(clockwise, _ring(ccw[::-1])).otherwise(_ring(ccw))


def zone_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON geometry rows ``(location_id, polygon_geojson)``: one per ``part`` row, so a zone
    has several parts (with a NULL polygon for ``IDS_WITHOUT_GEOMETRY``). Shapes: a square of side
    ``4 * p_size`` milli-degrees; every 10th part (key % 10 = 3) a two-square MultiPolygon, key %
    10 = 7 a square with an off-centre hole, key % 97 = 0 a zero-area square; key % 4 = 1 rings
    run clockwise."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    k = F.col("p_partkey")
    p = p.select(
        _zone_id().alias("location_id"),
        (-74250 + (k % 23) * 10).alias("x0"),
        (40500 + (k % 31) * 10).alias("y0"),
        F.when(k % 97 == 0, F.lit(0)).otherwise(F.col("p_size")).alias("h"),
        (k % 10).alias("shape"),
        (k % 4 == 1).alias("cw"),
    )
    # coordinate texts are computed once per row as columns; the rings only concatenate them
    x0, y0, h = F.col("x0"), F.col("y0"), F.col("h")
    p = p.select("location_id", "shape", "cw", *[_deg(v).alias(n) for n, v in (
        ("ax", x0), ("bx", x0 + 4 * h), ("ay", y0), ("by", y0 + 4 * h),
        ("sx", x0 + 100), ("tx", x0 + 100 + 4 * h),
        ("hx", x0 + h), ("ix", x0 + 2 * h), ("hy", y0 + h), ("iy", y0 + 2 * h))])
    cw = F.col("cw")
    p = p.select("location_id", "shape",
                 _square("ax", "ay", "bx", "by", cw).alias("outer"),
                 _square("sx", "ay", "tx", "by", cw).alias("second"),
                 _square("hx", "hy", "ix", "iy", ~cw).alias("hole"))
    outer, second, hole = F.col("outer"), F.col("second"), F.col("hole")
    geojson = (
        F.when(F.col("shape") == 3,
               F.concat(F.lit('{"type": "MultiPolygon", "coordinates": [['), outer, F.lit("],["), second, F.lit("]]}")))
        .when(F.col("shape") == 7,
              F.concat(F.lit('{"type": "Polygon", "coordinates": ['), outer, F.lit(","), hole, F.lit("]}")))
        .otherwise(F.concat(F.lit('{"type": "Polygon", "coordinates": ['), outer, F.lit("]}")))
    )
    return p.select("location_id", F.when(~F.col("location_id").isin(*IDS_WITHOUT_GEOMETRY), geojson).alias("polygon_geojson"))


def projected_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON geometry rows in map feet, one per ``part`` row: a square of side ``400 * p_size`` on a grid over the
    city; key % 4 = 1 rings run clockwise, key % 97 = 0 squares have no area, key % 89 = 0 have no shape."""
    k, side = F.col("p_partkey"), F.when(F.col("p_partkey") % 97 == 0, F.lit(0)).otherwise(400 * F.col("p_size"))
    x, y = 930_000 + (k % 23) * 5_000, 130_000 + (k % 31) * 5_000
    p = table(spark, sf_dir, "part").select("p_partkey", _zone_id().alias("location_id"), *[
        v.cast("string").alias(n) for n, v in (("ax", x), ("bx", x + side), ("ay", y), ("by", y + side))])
    ring = F.concat(F.lit('{"type": "Polygon", "coordinates": ['), _square("ax", "ay", "bx", "by", k % 4 == 1), F.lit("]}"))
    return p.select("p_partkey", "location_id", F.when(k % 89 != 0, ring).alias("polygon_geojson"))
