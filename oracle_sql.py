"""DuckDB oracle SQL for every registered query.

Written independently of the Spark operators: the inputs (ride feed over ``lineitem``, zones
over ``part`` + ``region``) follow the same published fixture definitions, while validation,
de-duplication (``row_number``), star joins and aggregates are plain SQL, and geometry
centroids come from closed-form area/centroid formulas of the generated shapes instead of
parsing the GeoJSON.
"""

from __future__ import annotations

# Fixed values shared with the library (must agree for equal results).
CELL_LEVEL = 16
GEO_DECIMALS = 6
BASE_URL = "https://d37ci6vzurychx.cloudfront.net/trip-data/fhvhv_tripdata_"

NATURAL_KEY = "hvfhs_license_num, request_datetime, start_time, end_time, pu_location_id, do_location_id"
TIEBREAK = ("on_scene_datetime, distance, reported_duration_sec, base_passenger_fare, tolls, bcf, sales_tax, "
            "congestion_surcharge, airport_fee, tips, driver_pay, trip_duration_sec, year, month, day")

RULES = [
    ("license_present", "hvfhs_license_num IS NOT NULL"),
    ("request_present", "request_datetime IS NOT NULL"),
    ("pickup_present", "pickup_datetime IS NOT NULL"),
    ("dropoff_present", "dropoff_datetime IS NOT NULL"),
    ("request_not_after_pickup", "request_datetime <= pickup_datetime"),
    ("pickup_before_dropoff", "pickup_datetime < dropoff_datetime"),
    ("pickup_zone_in_range", "PULocationID BETWEEN 1 AND 265"),
    ("dropoff_zone_in_range", "DOLocationID BETWEEN 1 AND 265"),
    ("trip_time_positive", "trip_time > 0"),
] + [(f"{c}_non_negative", f"{c} >= 0.0") for c in (
    "trip_miles", "base_passenger_fare", "tolls", "bcf", "sales_tax",
    "congestion_surcharge", "airport_fee", "tips", "driver_pay")]

COND = " AND ".join(f"({p})" for _, p in RULES)
FAILED = "concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT ({p}) THEN '{n}' END, CASE WHEN ({p}) IS NULL THEN '{n}_null' END" for n, p in RULES) + ")"

PREPARED_COLS = ("hvfhs_license_num, request_datetime, on_scene_datetime, pickup_datetime, dropoff_datetime, "
                 "PULocationID, DOLocationID, trip_miles, trip_time, base_passenger_fare, tolls, bcf, sales_tax, "
                 "congestion_surcharge, airport_fee, tips, driver_pay")


def _deg(m: str) -> str:
    return f"CAST(CAST(CAST({m} AS DECIMAL(12,0)) / 1000 AS DECIMAL(10,3)) AS VARCHAR)"


def _ring(points) -> str:
    parts = ["'['"]
    for i, (x, y) in enumerate(points):
        parts.append(f"'{',' if i else ''}['")
        parts += [_deg(x), "','", _deg(y), "']'"]
    parts.append("']'")
    return " || ".join(parts)


def _square(x0: str, y0: str, s: str, cw: str) -> str:
    ccw = [(x0, y0), (f"({x0} + {s})", y0), (f"({x0} + {s})", f"({y0} + {s})"), (x0, f"({y0} + {s})"), (x0, y0)]
    return f"(CASE WHEN {cw} THEN {_ring(ccw[::-1])} ELSE {_ring(ccw)} END)"


_OUTER = _square("x0", "y0", "(4 * h)", "cw")
_SECOND = _square("(x0 + 100)", "y0", "(4 * h)", "cw")
_HOLE = _square("(x0 + h)", "(y0 + h)", "h", "(NOT cw)")
GEOJSON = (
    "CASE WHEN shape = 3 THEN '{\"type\": \"MultiPolygon\", \"coordinates\": [[' || " + _OUTER + " || '],[' || "
    + _SECOND + " || ']]}' "
    "WHEN shape = 7 THEN '{\"type\": \"Polygon\", \"coordinates\": [' || " + _OUTER + " || ',' || " + _HOLE
    + " || ']}' ELSE '{\"type\": \"Polygon\", \"coordinates\": [' || " + _OUTER + " || ']}' END"
)


def cell(lat: str, lon: str, level: int = CELL_LEVEL) -> str:
    n = 2 ** level
    return (f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL AND NOT isnan({lat}) AND NOT isnan({lon}) "
            f"AND {lat} BETWEEN -90.0 AND 90.0 AND {lon} BETWEEN -180.0 AND 180.0 THEN concat_ws('/', '{level}', "
            f"CAST(least(CAST(floor(({lon} + 180.0) / 360.0 * {float(n)}) AS BIGINT), {n - 1}) AS VARCHAR), "
            f"CAST(least(CAST(floor(({lat} + 90.0) / 180.0 * {float(n)}) AS BIGINT), {n - 1}) AS VARCHAR)) END")


_AMOUNTS = ("trip_miles", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee",
            "tips", "driver_pay")
_BAD = {"request_datetime": [(1, "NULL")], "pickup_datetime": [(2, "NULL")], "dropoff_datetime": [(3, "NULL")],
        "DOLocationID": [(4, "0"), (5, "NULL")], "PULocationID": [(6, "NULL")], "trip_time": [(7, "0"), (8, "NULL")],
        **{c: [(10 + i, "-1.0E0"), (20 + i, "NULL")] for i, c in enumerate(_AMOUNTS)}}
SPOIL = ", ".join(
    "CASE " + " ".join(f"WHEN l_linenumber = 1 AND l_orderkey % 500 = {k} THEN {v}" for k, v in cases) + f" ELSE {c} END AS {c}"
    for c, cases in _BAD.items())

CTE = f"""
WITH b AS (
  SELECT *, CAST((l_orderkey * 37 + l_linenumber * 3607) % 86400 AS INTEGER) AS off_s, CAST(l_quantity AS INTEGER) AS q
  FROM (SELECT *, 0 AS dup FROM lineitem UNION ALL SELECT *, 1 AS dup FROM lineitem WHERE l_orderkey % 20 = 0) u),
r AS (SELECT *, l_shipdate + to_seconds(off_s) AS request_datetime FROM b),
p AS (SELECT *, request_datetime + to_seconds(CASE WHEN l_linenumber = 7 AND q > 45 THEN -30 ELSE 120 + l_linenumber END)
        AS pickup_datetime FROM r),
d AS (SELECT *, pickup_datetime + to_seconds(CASE WHEN l_linenumber = 6 AND q = 1 THEN 0 ELSE q * 60 + l_linenumber END)
        AS dropoff_datetime, request_datetime + to_seconds(60) AS scene FROM p),
clean AS (SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS source_month,
  CASE WHEN l_suppkey % 50 = 49 THEN NULL ELSE concat('HV000', CAST(2 + l_suppkey % 4 AS VARCHAR)) END AS hvfhs_license_num,
  concat('B0', CAST(l_suppkey % 9 AS VARCHAR)) AS dispatching_base_num,
  concat('B0', CAST(l_suppkey % 7 AS VARCHAR)) AS originating_base_num,
  request_datetime, CASE WHEN l_returnflag = 'R' THEN NULL ELSE scene END AS on_scene_datetime,
  pickup_datetime, dropoff_datetime,
  CAST(l_partkey % 267 AS BIGINT) AS PULocationID, CAST(1 + l_suppkey % 265 AS BIGINT) AS DOLocationID,
  (q * 50 + l_orderkey % 50) / 100.0E0 AS trip_miles, CAST(q * 60 AS BIGINT) AS trip_time,
  l_extendedprice AS base_passenger_fare, l_tax AS tolls, l_discount AS bcf, l_tax AS sales_tax,
  2.75E0 AS congestion_surcharge,
  CASE WHEN l_linenumber = 3 AND l_returnflag = 'A' THEN NULL ELSE 2.5E0 END AS airport_fee,
  CASE WHEN l_linenumber = 5 AND q = 13 THEN -1.0E0 ELSE l_discount * 10 + dup END AS tips,
  l_extendedprice * 0.75E0 AS driver_pay,
  'N' AS shared_request_flag, 'N' AS shared_match_flag, ' ' AS access_a_ride_flag,
  'N' AS wav_request_flag, CASE WHEN l_linenumber = 1 THEN 'Y' ELSE 'N' END AS wav_match_flag
FROM d),
spoiled AS (SELECT * REPLACE ({SPOIL}) FROM clean),
bronze AS (SELECT * EXCLUDE (l_orderkey, l_linenumber, source_month) FROM spoiled),
prepared AS (SELECT hvfhs_license_num, request_datetime, coalesce(on_scene_datetime, request_datetime) AS on_scene_datetime,
  pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, trip_time, base_passenger_fare, tolls, bcf,
  sales_tax, congestion_surcharge, airport_fee, tips, driver_pay FROM bronze),
flagged AS (SELECT *, ({COND}) AS is_valid FROM prepared),
valid AS (SELECT {PREPARED_COLS} FROM flagged WHERE is_valid),
quarantine AS (SELECT {PREPARED_COLS}, 'failed_data_quality_validation' AS quarantine_reason, {FAILED} AS failed_rules
  FROM flagged WHERE NOT coalesce(is_valid, false)),
std AS (SELECT hvfhs_license_num, request_datetime, on_scene_datetime, pickup_datetime AS start_time,
  dropoff_datetime AS end_time, TRY_CAST(PULocationID AS INTEGER) AS pu_location_id,
  TRY_CAST(DOLocationID AS INTEGER) AS do_location_id, trip_miles AS distance, trip_time AS reported_duration_sec,
  base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay FROM valid),
derived AS (SELECT *, date_diff('second', start_time, end_time) AS trip_duration_sec,
  CAST(year(start_time) AS INTEGER) AS year, CAST(month(start_time) AS INTEGER) AS month,
  CAST(day(start_time) AS INTEGER) AS day FROM std),
silver AS (SELECT * FROM derived QUALIFY row_number() OVER (PARTITION BY {NATURAL_KEY}
  ORDER BY {', '.join(c.strip() + ' ASC NULLS FIRST' for c in TIEBREAK.split(','))}) = 1),
fact AS (SELECT CAST(strftime(start_time, '%Y%m%d') AS INTEGER) AS date_key, pu_location_id, do_location_id,
  hvfhs_license_num, start_time, end_time, trip_duration_sec, reported_duration_sec, distance,
  CAST(hour(start_time) AS INTEGER) AS pickup_hour, year, month, day FROM silver),
dim_date AS (SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
  CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
  CAST(day(full_date) AS INTEGER) AS day, dayname(full_date) AS day_of_week, dayofweek(full_date) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT CAST(start_time AS DATE) AS full_date FROM silver) t),
zone_ids AS (SELECT DISTINCT CAST(1 + p_partkey % 265 AS INTEGER) AS LocationID FROM part),
lookup_raw AS (SELECT z.LocationID, r.r_name AS Borough, concat('Zone_', CAST(z.LocationID AS VARCHAR)) AS Zone,
  CASE WHEN z.LocationID >= 264 THEN 'N/A' WHEN z.LocationID = 1 THEN 'EWR' WHEN z.LocationID % 3 = 0 THEN 'Yellow Zone'
       WHEN z.LocationID % 3 = 1 THEN 'Boro Zone' ELSE 'Airports' END AS service_zone
  FROM zone_ids z LEFT JOIN region r ON z.LocationID % 5 = r.r_regionkey),
lookup AS (SELECT LocationID AS location_id, Borough AS borough, Zone AS zone_name,
  CASE WHEN service_zone <> 'N/A' THEN service_zone END AS service_zone FROM lookup_raw),
geo_parts AS (SELECT CAST(1 + p_partkey % 265 AS INTEGER) AS location_id, -74250 + (p_partkey % 23) * 10 AS x0,
  40500 + (p_partkey % 31) * 10 AS y0, CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE p_size END AS h,
  p_partkey % 10 AS shape, p_partkey % 4 = 1 AS cw
  FROM part),
geometry_all AS (SELECT location_id, {GEOJSON} AS polygon_geojson,
  CASE WHEN shape = 3 THEN 32.0 * h * h WHEN shape = 7 THEN 15.0 * h * h ELSE 16.0 * h * h END AS a_m,
  CASE WHEN shape = 3 THEN x0 + 2 * h + 50.0 WHEN shape = 7 THEN x0 + 61.0 * h / 30.0 ELSE x0 + 2.0 * h END AS cx_m,
  CASE WHEN shape = 7 THEN y0 + 61.0 * h / 30.0 ELSE y0 + 2.0 * h END AS cy_m
  FROM geo_parts),
geometry AS (SELECT location_id, CASE WHEN location_id NOT IN (57, 264, 265) THEN polygon_geojson END AS polygon_geojson,
  CASE WHEN location_id NOT IN (57, 264, 265) THEN a_m END AS a_m, cx_m, cy_m FROM geometry_all),
geometry_c AS (SELECT location_id, polygon_geojson, a_m * 1e-6 AS area,
  CASE WHEN a_m > 0 THEN cy_m / 1000.0 END AS centroid_lat, CASE WHEN a_m > 0 THEN cx_m / 1000.0 END AS centroid_lon
  FROM geometry),
zone_combined AS (SELECT location_id, count(*) AS parts,
  arg_max(polygon_geojson, (round(a_m * 1e-6, 8), polygon_geojson)) AS polygon_geojson,
  CASE WHEN sum(a_m) > 0 THEN sum(a_m * cy_m) / sum(a_m) / 1000.0 END AS centroid_lat,
  CASE WHEN sum(a_m) > 0 THEN sum(a_m * cx_m) / sum(a_m) / 1000.0 END AS centroid_lon
  FROM geometry GROUP BY location_id),
zone_ref AS (SELECT l.location_id, l.borough, l.zone_name, l.service_zone, c.polygon_geojson,
  c.centroid_lat, c.centroid_lon, {cell('c.centroid_lat', 'c.centroid_lon')} AS geo_hash,
  CASE WHEN ({cell('c.centroid_lat', 'c.centroid_lon')}) IS NOT NULL THEN {CELL_LEVEL} END AS h3_resolution
  FROM lookup l LEFT JOIN zone_combined c ON l.location_id = c.location_id)
"""


def r6(col: str, alias: str | None = None) -> str:
    return f"round({col}, {GEO_DECIMALS}) AS {alias or col.split('.')[-1]}"


ZONE_REF_OUT = (f"location_id, borough, zone_name, service_zone, polygon_geojson, {r6('centroid_lat')}, "
                f"{r6('centroid_lon')}, geo_hash, h3_resolution")
FACT_NO_ID = ("date_key, pu_location_id, do_location_id, hvfhs_license_num, start_time, end_time, trip_duration_sec, "
              "reported_duration_sec, distance, pickup_hour, year, month, day")
SILVER_NO_ID = ("hvfhs_license_num, request_datetime, on_scene_datetime, start_time, end_time, pu_location_id, "
                "do_location_id, distance, reported_duration_sec, base_passenger_fare, tolls, bcf, sales_tax, "
                "congestion_surcharge, airport_fee, tips, driver_pay, trip_duration_sec, year, month, day")
BRONZE_COLS = ("hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime, "
               "pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, trip_time, "
               "base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay, "
               "shared_request_flag, shared_match_flag, access_a_ride_flag, wav_request_flag, wav_match_flag")
_TOTAL = "CAST(sum(CAST(distance AS DECIMAL(18,6))) AS DOUBLE)"
TOTALS = (f"{_TOTAL} AS total_distance, {_TOTAL} / count(distance) AS avg_distance, "
          "CAST(sum(trip_duration_sec) AS DOUBLE) / count(trip_duration_sec) AS avg_duration_sec")
STATS = "count(*) AS rides, " + TOTALS


def _q(body: str) -> str:
    return CTE + body


_null_profile = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, "
    f"CAST(count(*) AS BIGINT) AS n_rows FROM bronze" for c in [x.strip() for x in BRONZE_COLS.split(",")])

_preview_cols = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c in ("request_datetime", "on_scene_datetime", "start_time", "end_time") else c
    for c in [x.strip() for x in SILVER_NO_ID.split(",")])

_enrich = f"""SELECT s.hvfhs_license_num, s.request_datetime, s.start_time, s.end_time, s.pu_location_id,
  s.do_location_id, {r6('pz.centroid_lat', 'start_lat')}, {r6('pz.centroid_lon', 'start_lon')},
  pz.geo_hash AS start_geo_hash, {r6('dz.centroid_lat', 'end_lat')}, {r6('dz.centroid_lon', 'end_lon')},
  dz.geo_hash AS end_geo_hash
  FROM silver s LEFT JOIN zone_ref pz ON s.pu_location_id = pz.location_id
  LEFT JOIN zone_ref dz ON s.do_location_id = dz.location_id"""

_orphans = """
SELECT 'date_key' AS foreign_key, CAST(count(*) AS BIGINT) AS orphan_rows, CAST(count(DISTINCT date_key) AS BIGINT) AS orphan_keys
  FROM fact WHERE date_key NOT IN (SELECT date_key FROM dim_date)
UNION ALL SELECT 'pu_location_id', CAST(count(*) AS BIGINT), CAST(count(DISTINCT pu_location_id) AS BIGINT)
  FROM fact WHERE pu_location_id NOT IN (SELECT location_id FROM zone_ref)
UNION ALL SELECT 'do_location_id', CAST(count(*) AS BIGINT), CAST(count(DISTINCT do_location_id) AS BIGINT)
  FROM fact WHERE do_location_id NOT IN (SELECT location_id FROM zone_ref)"""

_MONTHLY_QUARANTINE = f"""SELECT {PREPARED_COLS}, CASE WHEN source_month[6:7] >= '07' THEN 0.75E0 END AS cbd_congestion_fee,
  'failed_data_quality_validation' AS quarantine_reason, {FAILED} AS failed_rules, source_month
  FROM (SELECT * REPLACE (coalesce(on_scene_datetime, request_datetime) AS on_scene_datetime) FROM spoiled) m
  WHERE NOT coalesce({COND}, false)"""

_RESENT = """SELECT * EXCLUDE (l_orderkey, l_linenumber)
  REPLACE (strftime(strptime(source_month || '-01', '%Y-%m-%d') {sign} INTERVAL 1 MONTH, '%Y-%m') AS source_month, tips + {tips} AS tips)
  FROM spoiled WHERE trip_time % {every} = 0"""
_CROSS = f"""SELECT * FROM (
  SELECT *, date_diff('second', start_time, end_time) AS trip_duration_sec, CAST(year(start_time) AS INTEGER) AS year,
    CAST(month(start_time) AS INTEGER) AS month, CAST(day(start_time) AS INTEGER) AS day
  FROM (SELECT hvfhs_license_num, request_datetime, coalesce(on_scene_datetime, request_datetime) AS on_scene_datetime,
      pickup_datetime AS start_time, dropoff_datetime AS end_time, TRY_CAST(PULocationID AS INTEGER) AS pu_location_id,
      TRY_CAST(DOLocationID AS INTEGER) AS do_location_id, trip_miles AS distance, trip_time AS reported_duration_sec,
      base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay, source_month
    FROM (SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM spoiled
      UNION ALL {_RESENT.format(sign='+', tips='-0.5E0', every=7)} UNION ALL {_RESENT.format(sign='-', tips='1.0E0', every=11)}) sent
    WHERE {COND}) valid_sent) typed
  QUALIFY row_number() OVER (PARTITION BY {NATURAL_KEY}
    ORDER BY source_month, {', '.join(c.strip() + ' ASC NULLS FIRST' for c in TIEBREAK.split(','))}) = 1"""

# NAD83 / New York Long Island (EPSG 2263) by its published parameters, in metres here; feet are converted first.
_FT, _A, _E2 = "(1200.0E0 / 3937.0E0)", "6378137.0E0", "(2.0E0 / 298.257222101E0 - 1.0E0 / (298.257222101E0 * 298.257222101E0))"


def _cone_t(degrees: str) -> str:
    s = f"sin(radians({degrees}))"
    return f"(tan(pi() / 4 - radians({degrees}) / 2) / pow((1 - sqrt({_E2}) * {s}) / (1 + sqrt({_E2}) * {s}), sqrt({_E2}) / 2))"


def _cone_m(degrees: str) -> str:
    return f"(cos(radians({degrees})) / sqrt(1 - {_E2} * pow(sin(radians({degrees})), 2)))"


_P1, _P2, _P0 = "(41.0E0 + 2.0E0 / 60)", "(40.0E0 + 40.0E0 / 60)", "(40.0E0 + 10.0E0 / 60)"
# the latitude by iterating its defining equation, other than the series of the library
_PROJECTED = f"""
WITH RECURSIVE cone AS (SELECT *, {_A} * m1 / (n * pow(t1, n)) AS r1, {_A} * m1 / (n * pow(t1, n)) * pow(t0, n) AS r0
  FROM (SELECT *, ln(m1 / m2) / ln(t1 / t2) AS n FROM (SELECT {_cone_m(_P1)} AS m1, {_cone_m(_P2)} AS m2, {_cone_t(_P1)} AS t1,
    {_cone_t(_P2)} AS t2, {_cone_t(_P0)} AS t0, sqrt({_E2}) AS e) a) b),
squares AS (SELECT p_partkey, CAST(1 + p_partkey % 265 AS INTEGER) AS location_id, 930000 + (p_partkey % 23) * 5000 AS x,
  130000 + (p_partkey % 31) * 5000 AS y, CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE 400 * p_size END AS h FROM part),
corners AS (SELECT p_partkey, i, {_FT} * (x + CASE WHEN i IN (1, 2) THEN h ELSE 0 END) - 300000.0E0 AS east,
  {_FT} * (y + CASE WHEN i IN (2, 3) THEN h ELSE 0 END) AS north FROM squares, range(4) c(i)),
cones AS (SELECT p_partkey, i, e, pow(sqrt(east * east + (r0 - north) * (r0 - north)) / r1, 1 / n) AS t,
  degrees(atan2(east, r0 - north) / n) - 74 AS lon FROM corners, cone),
turns AS (SELECT p_partkey, i, e, t, lon, pi() / 2 - 2 * atan(t) AS phi, 0 AS turn FROM cones
  UNION ALL SELECT p_partkey, i, e, t, lon, pi() / 2 - 2 * atan(t * pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2)), turn + 1
  FROM turns WHERE turn < 8),
points AS (SELECT p_partkey, i, lon, degrees(phi) AS lat FROM turns WHERE turn = 8),
edges AS (SELECT a.p_partkey, a.lon - o.lon AS x1, a.lat - o.lat AS y1, b.lon - o.lon AS x2, b.lat - o.lat AS y2, o.lon AS ox, o.lat AS oy
  FROM points a JOIN points b ON b.p_partkey = a.p_partkey AND b.i = (a.i + 1) % 4 JOIN points o ON o.p_partkey = a.p_partkey AND o.i = 0),
moments AS (SELECT p_partkey, any_value(ox) AS ox, any_value(oy) AS oy, sum(x1 * y2 - x2 * y1) AS a2,
  sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS mx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS my FROM edges GROUP BY p_partkey)
SELECT s.p_partkey, s.location_id, CASE WHEN s.p_partkey % 89 <> 0 THEN round(abs(a2) / 2, 8) END AS area,
  CASE WHEN s.p_partkey % 89 <> 0 AND h > 0 THEN round(oy + my / (3 * a2), 6) END AS centroid_lat,
  CASE WHEN s.p_partkey % 89 <> 0 AND h > 0 THEN round(ox + mx / (3 * a2), 6) END AS centroid_lon
FROM squares s JOIN moments m ON m.p_partkey = s.p_partkey"""

ORACLE_SQL: dict[str, str] = {
    "zone_centroid_projected": _PROJECTED,
    "bronze_scan_merge_schema": _q(f"""SELECT hvfhs_license_num, dispatching_base_num, originating_base_num,
  request_datetime, on_scene_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles,
  trip_time, base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge,
  airport_fee, tips, driver_pay, shared_request_flag, shared_match_flag, access_a_ride_flag, wav_request_flag,
  wav_match_flag, CASE WHEN source_month[6:7] >= '07' THEN 0.75E0 END AS cbd_congestion_fee,
  source_month FROM spoiled"""),
    "zone_csv_scan": _q(f"SELECT {ZONE_REF_OUT} FROM zone_ref"),
    "partition_glob_scan": _q(f"SELECT {FACT_NO_ID} FROM fact"),
    "gold_partitioned_roundtrip": _q(f"SELECT {FACT_NO_ID} FROM fact"),
    "zone_lookup_standardise": _q("SELECT location_id, borough, zone_name, service_zone FROM lookup"),
    "monthly_source_manifest": _q(f"""SELECT concat('{BASE_URL}', strftime(m, '%Y-%m'), '.parquet') AS url,
  strftime(m, '%Y-%m') AS source_month FROM (SELECT unnest(generate_series(make_date(lo, 1, 1),
  make_date(hi, 12, 1), INTERVAL 1 MONTH)) AS m FROM (SELECT min(year(pickup_datetime)) AS lo,
  max(year(pickup_datetime)) AS hi FROM bronze) y) t"""),
    "standardise_rides": _q("""SELECT hvfhs_license_num, request_datetime, on_scene_datetime, pickup_datetime AS start_time,
  dropoff_datetime AS end_time, TRY_CAST(PULocationID AS INTEGER) AS pu_location_id,
  TRY_CAST(DOLocationID AS INTEGER) AS do_location_id, trip_miles AS distance, trip_time AS reported_duration_sec,
  base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay FROM prepared"""),
    "lenient_cast": _q("""SELECT hvfhs_license_num, TRY_CAST(dispatching_base_num AS INTEGER) AS dispatching_base_num,
  TRY_CAST(CAST(request_datetime AS VARCHAR) AS TIMESTAMP) AS request_datetime,
  TRY_CAST(CAST(pickup_datetime AS VARCHAR) AS TIMESTAMP) AS pickup_datetime,
  TRY_CAST(CAST(PULocationID AS VARCHAR) AS INTEGER) AS PULocationID,
  TRY_CAST(CAST(DOLocationID AS VARCHAR) AS INTEGER) AS DOLocationID,
  TRY_CAST(CAST(trip_miles AS VARCHAR) AS DOUBLE) AS trip_miles,
  TRY_CAST(CAST(trip_time AS VARCHAR) AS BIGINT) AS trip_time,
  TRY_CAST(CAST(base_passenger_fare AS VARCHAR) AS DOUBLE) AS base_passenger_fare,
  TRY_CAST(CAST(tips AS VARCHAR) AS DOUBLE) AS tips FROM bronze"""),
    "drop_operational_columns": _q("""SELECT hvfhs_license_num, request_datetime, on_scene_datetime, pickup_datetime,
  dropoff_datetime, PULocationID, DOLocationID, trip_miles, trip_time, base_passenger_fare, tolls, bcf, sales_tax,
  congestion_surcharge, airport_fee, tips, driver_pay FROM bronze"""),
    "null_fill_on_scene": _q("""SELECT hvfhs_license_num, request_datetime, on_scene_datetime, pickup_datetime,
  PULocationID, DOLocationID FROM prepared"""),
    "trip_id_unique": _q("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS distinct_ids FROM silver"),
    "derive_trip_columns": _q("""SELECT hvfhs_license_num, start_time, end_time, reported_duration_sec,
  trip_duration_sec, year, month, day FROM derived"""),
    "valid_rides": _q("SELECT * FROM valid"),
    "quarantine_rides": _q("SELECT * FROM quarantine"),
    "unknown_validity_rides": _q(f"SELECT {PREPARED_COLS} FROM flagged WHERE is_valid IS NULL"),
    "quarantine_reason_counts": _q("""SELECT rule, CASE
    WHEN replace(rule, '_null', '') = 'license_present' THEN 'provider'
    WHEN replace(rule, '_null', '') IN ('request_present', 'pickup_present', 'dropoff_present',
      'request_not_after_pickup', 'pickup_before_dropoff') THEN 'timestamps'
    WHEN replace(rule, '_null', '') IN ('pickup_zone_in_range', 'dropoff_zone_in_range') THEN 'zone'
    WHEN replace(rule, '_null', '') IN ('trip_time_positive', 'duration_consistent') THEN 'duration'
    WHEN replace(rule, '_null', '') LIKE '%_non_negative' THEN 'amounts' ELSE 'other' END AS reason_class,
  CAST(count(*) AS BIGINT) AS n_rows
  FROM (SELECT unnest(string_split(failed_rules, ',')) AS rule FROM quarantine) t GROUP BY rule"""),
    "duration_mismatch": _q("""SELECT hvfhs_license_num, CAST(count(*) AS BIGINT) AS mismatched_rides,
  max(abs(trip_duration_sec - reported_duration_sec)) AS max_abs_diff_sec FROM silver
  WHERE NOT (abs(trip_duration_sec - reported_duration_sec) <= 5) GROUP BY hvfhs_license_num"""),
    "split_reconciliation": _q("""SELECT input_rows, valid_rows, on_null, quarantine_rows, lost_rows,
  valid_rows + quarantine_rows + lost_rows = input_rows AS reconciles FROM (
  SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(count_if(is_valid) AS BIGINT) AS valid_rows, 'quarantine' AS on_null,
    CAST(count_if(NOT is_valid) + count_if(is_valid IS NULL) AS BIGINT) AS quarantine_rows, CAST(0 AS BIGINT) AS lost_rows
  FROM flagged
  UNION ALL
  SELECT CAST(count(*) AS BIGINT), CAST(count_if(is_valid) AS BIGINT), 'drop', CAST(count_if(NOT is_valid) AS BIGINT),
    CAST(count_if(is_valid IS NULL) AS BIGINT) FROM flagged) t"""),
    "dedupe_rides": _q(f"SELECT {SILVER_NO_ID} FROM silver"),
    "silver_rides": _q(f"SELECT {SILVER_NO_ID} FROM silver"),
    "pipeline_counts": _q("""SELECT CAST(count(*) AS BIGINT) AS bronze_rows, CAST(count_if(is_valid) AS BIGINT) AS valid_rows,
  CAST(count(*) - count_if(is_valid) AS BIGINT) AS quarantine_rows, CAST(count_if(is_valid IS NULL) AS BIGINT) AS unknown_rows,
  (SELECT CAST(count(*) AS BIGINT) FROM silver) AS silver_rows FROM flagged"""),
    "preview_as_strings": _q(f"SELECT {_preview_cols} FROM silver ORDER BY {NATURAL_KEY} LIMIT 50"),
    "null_profile": _q(_null_profile),
    "fact_rides": _q(f"SELECT {FACT_NO_ID} FROM fact"),
    "dim_date": _q("SELECT * FROM dim_date"),
    "dim_zone": _q(f"SELECT {ZONE_REF_OUT} FROM zone_ref"),
    "kpi_totals": _q(f"SELECT CAST(count(*) AS BIGINT) AS total_rides, {TOTALS} FROM fact"),
    "daily_rides_trend": _q("""SELECT f.date_key, d.full_date, d.day_of_week, d.is_weekend, CAST(count(*) AS BIGINT) AS rides
  FROM fact f LEFT JOIN dim_date d ON f.date_key = d.date_key GROUP BY f.date_key, d.full_date, d.day_of_week, d.is_weekend"""),
    "rides_by_hour": _q("SELECT pickup_hour, CAST(count(*) AS BIGINT) AS rides FROM fact GROUP BY pickup_hour"),
    "rides_by_provider": _q("SELECT hvfhs_license_num, CAST(count(*) AS BIGINT) AS rides FROM fact GROUP BY hvfhs_license_num"),
    "rides_by_pickup_zone": _q(f"""SELECT f.pu_location_id, z.zone_name, z.borough, {r6('z.centroid_lat')},
  {r6('z.centroid_lon')}, CAST(count(*) AS BIGINT) AS rides FROM fact f LEFT JOIN zone_ref z ON f.pu_location_id = z.location_id
  GROUP BY f.pu_location_id, z.zone_name, z.borough, z.centroid_lat, z.centroid_lon"""),
    "rides_by_zone_pair": _q("""SELECT f.pu_location_id, pz.zone_name AS pu_zone_name, f.do_location_id,
  dz.zone_name AS do_zone_name, CAST(count(*) AS BIGINT) AS rides FROM fact f
  LEFT JOIN zone_ref pz ON f.pu_location_id = pz.location_id LEFT JOIN zone_ref dz ON f.do_location_id = dz.location_id
  GROUP BY f.pu_location_id, pz.zone_name, f.do_location_id, dz.zone_name"""),
    "rides_by_weekday_flag": _q("""SELECT d.is_weekend, d.day_of_week, CAST(count(*) AS BIGINT) AS rides,
  CAST(count(DISTINCT f.date_key) AS BIGINT) AS days FROM fact f LEFT JOIN dim_date d ON f.date_key = d.date_key
  GROUP BY d.is_weekend, d.day_of_week"""),
    "fact_orphan_keys": _q(_orphans),
    "agg_trips_daily": _q(f"SELECT date_key, {STATS} FROM fact GROUP BY date_key"),
    "agg_trips_by_zone": _q(f"SELECT pu_location_id, {STATS} FROM fact GROUP BY pu_location_id"),
    "agg_trips_by_hour": _q(f"SELECT pickup_hour, {STATS} FROM fact GROUP BY pickup_hour"),
    "agg_trips_by_company": _q(f"SELECT hvfhs_license_num, {STATS} FROM fact GROUP BY hvfhs_license_num"),
    "zone_geometry_join": _q(f"""SELECT l.location_id, l.borough, l.zone_name, l.service_zone, g.polygon_geojson,
  {r6('g.centroid_lat')}, {r6('g.centroid_lon')}, {cell('g.centroid_lat', 'g.centroid_lon')} AS geo_hash,
  CASE WHEN ({cell('g.centroid_lat', 'g.centroid_lon')}) IS NOT NULL THEN {CELL_LEVEL} END AS h3_resolution
  FROM lookup l LEFT JOIN geometry_c g ON l.location_id = g.location_id"""),
    "zones_without_geometry": _q("""SELECT * FROM lookup WHERE location_id NOT IN (SELECT location_id FROM geometry WHERE polygon_geojson IS NOT NULL)"""),
    "zone_centroid_from_geojson": _q(f"""SELECT location_id, round(area, 8) AS area, {r6('centroid_lat')},
  {r6('centroid_lon')} FROM geometry_c"""),
    "spatial_cell": _q(f"""SELECT location_id, {cell('centroid_lat', 'centroid_lon', 8)} AS cell_8,
  {cell('centroid_lat', 'centroid_lon', 16)} AS cell_16, {cell('centroid_lat', 'centroid_lon', 20)} AS cell_20
  FROM zone_combined"""),
    "dim_zone_with_cell": _q(f"SELECT {ZONE_REF_OUT} FROM zone_ref"),
    "enrich_pickup_dropoff": _q(_enrich),
    "rides_by_cell": _q("""SELECT z.geo_hash AS cell, CAST(count(*) AS BIGINT) AS rides,
  CAST(count(DISTINCT f.pu_location_id) AS BIGINT) AS zones FROM fact f LEFT JOIN zone_ref z
  ON f.pu_location_id = z.location_id GROUP BY z.geo_hash"""),
    "quarantine_rides_drop_mode": _q(f"SELECT {PREPARED_COLS}, 'failed_data_quality_validation' AS quarantine_reason, "
                                     f"{FAILED} AS failed_rules FROM flagged WHERE NOT is_valid"),
    "source_file_scan": _q("SELECT source_month, CAST(count(*) AS BIGINT) AS n_rows FROM spoiled GROUP BY source_month"),
    "landing_append": _q(f"SELECT {BRONZE_COLS} FROM bronze"),
    "csv_as_strings": _q("""SELECT CAST(LocationID AS VARCHAR) AS "LocationID", Borough AS "Borough", Zone AS "Zone", service_zone FROM lookup_raw"""),
    "zone_centroids_csv": _q(f"SELECT location_id, {r6('centroid_lat')}, {r6('centroid_lon')} FROM zone_ref"),
    "zone_csv_float_resolution": _q(f"SELECT {ZONE_REF_OUT} FROM zone_ref"),
    "cross_file_dedupe": _q(_CROSS),
    "quarantine_history_rerun": _q(f"""SELECT CASE WHEN source_month[6:7] >= '07' THEN '2' ELSE '1' END AS run_id, source_month,
  CAST(count(*) AS BIGINT) AS n_rows FROM ({_MONTHLY_QUARANTINE}) q GROUP BY source_month"""),
    "incremental_months_silver": _q(f"SELECT {SILVER_NO_ID}, strftime(request_datetime, '%Y-%m') AS source_month FROM silver"),
    "incremental_months_quarantine": _q(f"{_MONTHLY_QUARANTINE}"),
    "incremental_months_fact": _q(f"SELECT {FACT_NO_ID} FROM fact"),
    "catalog_fact_after_sync": _q(f"SELECT {FACT_NO_ID} FROM fact"),
    "lake_trip_ids_unique": _q("""SELECT n AS n_rows, n AS distinct_ids FROM (SELECT CAST((SELECT count(*) FROM silver) +
  (SELECT count(*) FROM quarantine) AS BIGINT) AS n) t"""),
    "published_agg_daily": _q(f"SELECT date_key, {STATS} FROM fact GROUP BY date_key"),
    "published_agg_by_zone": _q(f"SELECT pu_location_id, {STATS} FROM fact GROUP BY pu_location_id"),
    "published_agg_by_hour": _q(f"SELECT pickup_hour, {STATS} FROM fact GROUP BY pickup_hour"),
    "published_agg_by_company": _q(f"SELECT hvfhs_license_num, {STATS} FROM fact GROUP BY hvfhs_license_num"),
    "published_dim_date": _q("SELECT * FROM dim_date"),
    "silver_geo_rides": _q(_enrich),
    "quarantine_history": _q(f"""SELECT CASE WHEN source_month IN (SELECT source_month FROM (SELECT source_month,
  row_number() OVER (ORDER BY source_month) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT source_month FROM spoiled)) WHERE i <= n // 2)
  THEN '1' ELSE '2' END AS run_id, source_month, CAST(count(*) AS BIGINT) AS n_rows
  FROM ({_MONTHLY_QUARANTINE}) q GROUP BY source_month"""),
}

ORACLE_SQL["manifest_text"] = f"SELECT url FROM ({ORACLE_SQL['monthly_source_manifest']}) m"
