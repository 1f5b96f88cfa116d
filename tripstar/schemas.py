"""Declared schemas of every layer, and the column maps of the standardisation step.

Timestamps are ``TIMESTAMP_NTZ``: the source files carry local wall-clock times without a zone,
and Spark >= 3.4 reads them as NTZ; keeping NTZ end to end avoids any session-zone shift.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_TS, _DATE, _B = T.TimestampNTZType(), T.DateType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw bronze ride columns (TLC high-volume for-hire vehicle trip records).
BRONZE_RIDES = _struct(
    ("hvfhs_license_num", _S),
    ("dispatching_base_num", _S),
    ("originating_base_num", _S),
    ("request_datetime", _TS),
    ("on_scene_datetime", _TS),
    ("pickup_datetime", _TS),
    ("dropoff_datetime", _TS),
    ("PULocationID", _L),
    ("DOLocationID", _L),
    ("trip_miles", _D),
    ("trip_time", _L),
    ("base_passenger_fare", _D),
    ("tolls", _D),
    ("bcf", _D),
    ("sales_tax", _D),
    ("congestion_surcharge", _D),
    ("airport_fee", _D),
    ("tips", _D),
    ("driver_pay", _D),
    ("shared_request_flag", _S),
    ("shared_match_flag", _S),
    ("access_a_ride_flag", _S),
    ("wav_request_flag", _S),
    ("wav_match_flag", _S),
)

# Declared silver columns, in order.
SILVER_RIDES = _struct(
    ("trip_id", _L),
    ("hvfhs_license_num", _S),
    ("request_datetime", _TS),
    ("on_scene_datetime", _TS),
    ("start_time", _TS),
    ("end_time", _TS),
    ("pu_location_id", _I),
    ("do_location_id", _I),
    ("distance", _D),
    ("reported_duration_sec", _L),
    ("base_passenger_fare", _D),
    ("tolls", _D),
    ("bcf", _D),
    ("sales_tax", _D),
    ("congestion_surcharge", _D),
    ("airport_fee", _D),
    ("tips", _D),
    ("driver_pay", _D),
)

# Derived silver columns appended after the declared ones.
SILVER_DERIVED = _struct(("trip_duration_sec", _L), ("year", _I), ("month", _I), ("day", _I))

# Raw name -> silver name (identity entries omitted).
RIDE_RENAMES = {
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "pickup_datetime": "start_time",
    "dropoff_datetime": "end_time",
    "trip_miles": "distance",
    "trip_time": "reported_duration_sec",
}

# Operational columns removed before validation.
OPERATIONAL_COLUMNS = (
    "dispatching_base_num",
    "originating_base_num",
    "shared_request_flag",
    "shared_match_flag",
    "access_a_ride_flag",
    "wav_request_flag",
    "wav_match_flag",
)

# Natural key of a ride, used for dedupe and the stable trip id.
NATURAL_KEY = ("hvfhs_license_num", "request_datetime", "start_time", "end_time", "pu_location_id", "do_location_id")

FACT_RIDES = _struct(
    ("trip_id", _L),
    ("date_key", _I),
    ("pu_location_id", _I),
    ("do_location_id", _I),
    ("hvfhs_license_num", _S),
    ("start_time", _TS),
    ("end_time", _TS),
    ("trip_duration_sec", _L),
    ("reported_duration_sec", _L),
    ("distance", _D),
    ("pickup_hour", _I),
    ("year", _I),
    ("month", _I),
    ("day", _I),
)
FACT_PARTITION_COLUMNS = ("year", "month", "day")

DIM_DATE = _struct(
    ("date_key", _I),
    ("full_date", _DATE),
    ("year", _I),
    ("month", _I),
    ("day", _I),
    ("day_of_week", _S),
    ("is_weekend", _B),
)

DIM_ZONE = _struct(
    ("location_id", _I),
    ("borough", _S),
    ("zone_name", _S),
    ("service_zone", _S),
    ("polygon_geojson", _S),
    ("centroid_lat", _D),
    ("centroid_lon", _D),
    ("geo_hash", _S),
    ("h3_resolution", _I),
)

# Zone lookup as published (CSV header names) and its rename to dimension names.
ZONE_LOOKUP = _struct(("LocationID", _I), ("Borough", _S), ("Zone", _S), ("service_zone", _S))
ZONE_LOOKUP_RENAMES = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone_name"}


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE`` / ``spark.read.schema`` from a StructType."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
