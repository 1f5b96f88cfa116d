"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator / report.

Each query rebuilds its inputs from the shared test tables (``lineitem`` -> bronze rides,
``part`` + ``region`` -> zones), so its work grows with the tables. Queries over frames are one
lazy plan and start no job. Queries of the write, catalog and chain operators write below the
session's checkpoint directory and read back what they wrote; those of one lake share it within a
session (:func:`_lake`).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar import schemas
from tripstar.functions.columns import spatial_cell
from tripstar.functions.projection import NEW_YORK_LONG_ISLAND_FT
from tripstar.operators import gold as G
from tripstar.operators import metrics as M
from tripstar.operators import rules as R
from tripstar.operators.dedupe import dedupe
from tripstar.operators.geo import (
    DEFAULT_CELL_LEVEL, build_zone_reference, combine_zone_geometry, enrich_pickup_dropoff,
    geometry_centroids, project_geometry, rides_by_cell, standardise_zone_lookup, zone_geometry_join, zones_without_geometry,
)
from tripstar.operators.limits import preview
from tripstar.operators.standardise import (
    derive_trip_columns, drop_operational_columns, fill_on_scene, lenient_cast, standardise_rides,
)
from tripstar.paths import LakePaths, scratch_path, written_size
from tripstar.plans import silver as S
from tripstar.plans.lake import CODEC, vacuum
from tripstar.plans.ownership import SILVER_ORDER
from tripstar.plans.pipeline import build_reference, run_bronze_to_silver, run_pipeline
from tripstar.plans.publish import read_table, write_table
from tripstar.plans.reports import register_report_views
from tripstar.sources import files, testdata
from tripstar.sources.manifest import monthly_source_manifest
from tripstar.streaming.landing import land_new_files

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
DURATION_TOLERANCE_SEC = 5
PREVIEW_ROWS = 50
GEO_DECIMALS = 6
FEED_ROW_GROUP = 4 << 20
FEED = T.StructType([*schemas.BRONZE_RIDES, T.StructField("source_month", T.StringType())])
_GEO_COLS = ("centroid_lat", "centroid_lon", "start_lat", "start_lon", "end_lat", "end_lon")


def round_geo(df: DataFrame) -> DataFrame:
    """Round centroid coordinates (computed by shoelace sums, so last bits depend on summation
    order) to a fixed number of decimals for reproducible comparison."""
    return df.withColumns({c: F.round(c, GEO_DECIMALS) for c in _GEO_COLS if c in df.columns})


class Inputs:
    """Lazily built frames of one (spark, sf_dir); attributes are plain lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def bronze(self) -> DataFrame:
        return feed(self.spark, self.sf_dir).drop("source_month")

    @cached_property
    def prepared(self) -> DataFrame:
        return S.prepare(self.bronze)

    @cached_property
    def valid(self) -> DataFrame:
        return R.valid_rows(self.prepared)

    @cached_property
    def derived(self) -> DataFrame:
        return derive_trip_columns(standardise_rides(self.valid))

    @cached_property
    def silver(self) -> DataFrame:
        return S.validated_silver(self.valid)

    @cached_property
    def fact(self) -> DataFrame:
        return G.fact_rides(self.silver)

    @cached_property
    def dim_date(self) -> DataFrame:
        return G.dim_date(self.silver)

    @cached_property
    def lookup_raw(self) -> DataFrame:
        return testdata.zone_lookup_raw(self.spark, self.sf_dir)

    @cached_property
    def lookup(self) -> DataFrame:
        return standardise_zone_lookup(self.lookup_raw)

    @cached_property
    def geometry(self) -> DataFrame:
        return testdata.zone_geometry(self.spark, self.sf_dir)

    @cached_property
    def zone_reference(self) -> DataFrame:
        return build_zone_reference(self.lookup, self.geometry)

    @cached_property
    def dim_zone(self) -> DataFrame:
        return G.dim_zone(self.zone_reference)


def _silver_out(df: DataFrame) -> DataFrame:
    return df.drop("trip_id")


# --------------------------------------------------------------------------- sources / sinks

# What was written in this session: (application, tables, what) -> path, number and bytes of its files.
_written: dict[tuple[str, str, str], tuple[str, tuple[int, int] | None]] = {}


def _once(spark, sf_dir: str, what: str, write: Callable[[str], None]) -> str:
    """Where ``what`` was written in this session. It is written again if files of it are gone: the checkpoint
    directory belongs to the session's owner, who may clear it between queries."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    path, size = _written.get(key, (None, None))
    if path is None or size is None or written_size(spark, path) != size:
        path = scratch_path(spark, what)
        write(path)
        _written[key] = path, written_size(spark, path)
    return path


def feed(spark, sf_dir) -> DataFrame:
    """The ride feed with its source month, derived from the shared tables once in a session and then read. The shared
    tables are small files, so the row groups are, too: all task slots of a small session read the feed."""
    def write(path):
        derived_feed(spark, sf_dir).write.option("parquet.block.size", FEED_ROW_GROUP).option("compression", CODEC).parquet(path)
    return files.read_bronze(spark, _once(spark, sf_dir, "feed", write), FEED)


def derived_feed(spark, sf_dir) -> DataFrame:
    """The same rows derived anew, for queries that would otherwise hold them on disk beside their own tables: the feed
    is three times as large as the table that it comes from."""
    rides = testdata.bronze_rides(spark, sf_dir, with_month=True)
    return rides.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEED])


def _eras(rides: DataFrame) -> list[DataFrame]:
    """From July on, files have a column that earlier ones lack."""
    late = F.substring("source_month", 6, 2) >= "07"
    return [rides.filter(~late), rides.filter(late).withColumn("cbd_congestion_fee", F.lit(0.75))]


def _landed(spark, sf_dir) -> str:
    """Monthly bronze files of both eras, in the order of requests: the time columns are then far smaller."""
    def write(root):
        for era in _eras(derived_feed(spark, sf_dir)):
            write_table(era, root, ("source_month",), mode="append", sort_within=("request_datetime",))
    return _once(spark, sf_dir, "bronze_eras", write)


def q_bronze_scan_merge_schema(spark, sf_dir):
    """Monthly bronze files, the later ones with ``cbd_congestion_fee``, read back as one table."""
    merged = files.read_bronze(spark, _landed(spark, sf_dir))
    return merged.select(*[f.name for f in schemas.BRONZE_RIDES.fields], "cbd_congestion_fee",
                         F.col("source_month").cast("string").alias("source_month"))


def q_source_file_scan(spark, sf_dir):
    """Rows per landing partition, told from the file each row came from."""
    rows = files.read_with_source_file(spark, _landed(spark, sf_dir))
    month = F.regexp_extract("source_file", r"source_month=([0-9]{4}-[0-9]{2})/", 1)
    return rows.groupBy(month.alias("source_month")).agg(F.count(F.lit(1)).alias("n_rows"))


def q_landing_append(spark, sf_dir):
    """Two landings in turn: each run appends the files that are new, and those once."""
    def write(root):
        rides = Inputs(spark, sf_dir).bronze
        for name, odd in (("first", 0), ("second", 1)):
            rides.filter(F.pmod(F.xxhash64("base_passenger_fare", "dropoff_datetime"), F.lit(2)) == odd).write.parquet(f"{root}/landing/{name}")
            land_new_files(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", schemas.BRONZE_RIDES)
    root = _once(spark, sf_dir, "landing", write)
    return spark.read.parquet(f"{root}/bronze").drop("source_file")


def q_csv_as_strings(spark, sf_dir):
    """The zone lookup file with every column as text."""
    path = _once(spark, sf_dir, "lookup_csv", lambda p: Inputs(spark, sf_dir).lookup_raw.write.option("header", True).csv(p))
    return files.read_csv_as_strings(spark, path)


def q_zone_centroids_csv(spark, sf_dir):
    """The centroid file of the enrichment variant: id and point."""
    def write(path):
        points = Inputs(spark, sf_dir).zone_reference.select(F.col("location_id").alias("LocationID"), F.col("centroid_lat").alias("lat"),
                                                             F.col("centroid_lon").alias("lon"))
        points.write.option("header", True).csv(path)
    return round_geo(files.read_zone_centroids_csv(spark, _once(spark, sf_dir, "centroid_csv", write)))


def q_zone_csv_float_resolution(spark, sf_dir):
    """A zone reference file that writes the resolution as ``16.0``, as some producers do."""
    def write(path):
        files.write_zone_reference_csv(Inputs(spark, sf_dir).zone_reference.withColumn("h3_resolution", F.col("h3_resolution").cast("double")), path)
    return round_geo(files.read_zone_reference_csv(spark, _once(spark, sf_dir, "zone_csv_float", write)))


def q_manifest_text(spark, sf_dir):
    """The URL list as a text file, one line each."""
    path = _once(spark, sf_dir, "manifest", lambda p: files.write_text_lines(q_monthly_source_manifest(spark, sf_dir), "url", p))
    return spark.read.text(path).select(F.col("value").alias("url"))


# --------------------------------------------------------------------------- the chain

CORRECTED_MONTH = "1995-03"


def _lake(spark, sf_dir) -> tuple[LakePaths, str]:
    """A lake loaded in three increments of source months. One month first comes with every ride a
    second time on days that do not exist, and is then loaded again as it should be."""
    def write(root):
        paths = LakePaths(root)
        inp = Inputs(spark, sf_dir)
        build_reference(spark, paths, inp.lookup, inp.geometry)
        bronze = files.read_bronze(spark, _landed(spark, sf_dir))
        months = sorted(str(r[0]) for r in bronze.select("source_month").distinct().collect())
        shift = F.make_dt_interval(F.lit(40_000))
        times = ("request_datetime", "on_scene_datetime", "pickup_datetime", "dropoff_datetime")
        again = bronze.filter(F.col("source_month") == CORRECTED_MONTH).withColumns({c: F.col(c) + shift for c in times})
        third = -(-len(months) // 3)
        starts = range(0, len(months), third)
        for at in starts:
            run_pipeline(spark, paths, bronze.unionByName(again), database=_database(root) if at == starts[-1] else None, months=months[at:at + third])
        register_report_views(spark, _database(root), prefix=f"{_database(root)}_")
        run_pipeline(spark, paths, bronze, database=_database(root), months=[CORRECTED_MONTH])
    root = _once(spark, sf_dir, "lake", write)
    return LakePaths(root), _database(root)


def _database(root: str) -> str:
    return "lake_" + root.rsplit("-", 1)[-1]


def q_incremental_months_silver(spark, sf_dir):
    """Silver of the lake that was loaded month by month."""
    paths, _ = _lake(spark, sf_dir)
    return _silver_out(read_table(spark, paths.silver_rides)).withColumn("source_month", F.col("source_month").cast("string"))


def q_incremental_months_quarantine(spark, sf_dir):
    """Quarantine of the same lake: rows without a pickup time and the column that came later included."""
    paths, _ = _lake(spark, sf_dir)
    return read_table(spark, paths.quarantine_rides).drop("trip_id").withColumn("source_month", F.col("source_month").cast("string"))


def q_incremental_months_fact(spark, sf_dir):
    paths, _ = _lake(spark, sf_dir)
    return read_table(spark, paths.gold("fact_rides")).drop("trip_id")


def q_catalog_fact_after_sync(spark, sf_dir):
    """The catalog's fact table after a month was loaded again."""
    _, database = _lake(spark, sf_dir)
    return spark.table(f"{database}.fact_rides").drop("trip_id")


def q_lake_trip_ids_unique(spark, sf_dir):
    """Ids over all months of silver and of quarantine."""
    paths, _ = _lake(spark, sf_dir)
    both = read_table(spark, paths.silver_rides).select("trip_id").unionByName(read_table(spark, paths.quarantine_rides).select("trip_id"))
    return M.id_uniqueness(both)


def q_published_agg_daily(spark, sf_dir):
    return spark.table(f"{_lake(spark, sf_dir)[1]}.agg_trips_daily")


def q_published_agg_by_zone(spark, sf_dir):
    return spark.table(f"{_lake(spark, sf_dir)[1]}.agg_trips_by_zone")


def q_published_agg_by_hour(spark, sf_dir):
    return spark.table(f"{_lake(spark, sf_dir)[1]}.agg_trips_by_hour")


def q_published_agg_by_company(spark, sf_dir):
    return spark.table(f"{_lake(spark, sf_dir)[1]}.agg_trips_by_company")


def q_published_dim_date(spark, sf_dir):
    return spark.table(f"{_lake(spark, sf_dir)[1]}.dim_date")


def q_silver_geo_rides(spark, sf_dir):
    """Silver with coordinates and cells of both ends, written and read back."""
    paths, _ = _lake(spark, sf_dir)

    def write(path):
        rides = read_table(spark, paths.silver_rides)
        # silver is read in the layout of its files, so its rows are not shuffled to be written by month again
        write_table(enrich_pickup_dropoff(rides, files.read_zone_reference_csv(spark, paths.zone_reference)), path, ("source_month",),
                    sort_within=SILVER_ORDER, rebalance=False)
    geo = read_table(spark, _once(spark, sf_dir, "silver_geo", write))
    return round_geo(geo.select("hvfhs_license_num", "request_datetime", "start_time", "end_time", "pu_location_id", "do_location_id",
                                "start_lat", "start_lon", "start_geo_hash", "end_lat", "end_lon", "end_geo_hash"))


def q_quarantine_history(spark, sf_dir):
    """Two runs over half of the months each, appended to one quarantine and told apart by run."""
    def write(root):
        bronze = files.read_bronze(spark, _landed(spark, sf_dir))
        months = sorted(str(r[0]) for r in bronze.select("source_month").distinct().collect())
        half = len(months) // 2
        for run, part in (("1", months[:half]), ("2", months[half:])):
            run_bronze_to_silver(spark, LakePaths(root), bronze, months=part, quarantine_mode="append", run_id=run)
    root = _once(spark, sf_dir, "history", write)
    history = read_table(spark, LakePaths(root).quarantine_rides)
    return history.groupBy(F.col("run_id").cast("string").alias("run_id"), F.col("source_month").cast("string").alias("source_month")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def q_quarantine_history_rerun(spark, sf_dir):
    """A run of the history that first came with every row twice, and was then run again under its id."""
    def write(root):
        rides = feed(spark, sf_dir)
        late = F.substring("source_month", 6, 2) >= "07"
        for run, part in (("1", rides.filter(~late)), ("2", rides.filter(late).unionByName(rides.filter(late))), ("2", rides.filter(late))):
            run_bronze_to_silver(spark, LakePaths(root), part, quarantine_mode="append", run_id=run)
    root = _once(spark, sf_dir, "history_rerun", write)
    return read_table(spark, LakePaths(root).quarantine_rides).groupBy("run_id", "source_month").agg(F.count(F.lit(1)).alias("n_rows"))


def _resent(rides: DataFrame) -> DataFrame:
    """The feed with rides that come again in the file of the next month or of the month before, with other tips."""
    def moved(months: int, tips: float, which) -> DataFrame:
        month = F.date_format(F.add_months(F.to_date(F.concat("source_month", F.lit("-01"))), months), "yyyy-MM")
        return rides.filter(which).withColumns({"source_month": month, "tips": F.col("tips") + tips})
    return rides.unionByName(moved(1, -0.5, F.col("trip_time") % 7 == 0)).unionByName(moved(-1, 1.0, F.col("trip_time") % 11 == 0))


def q_cross_file_dedupe(spark, sf_dir):
    """Silver of a feed whose files hold rides of one another, loaded in three increments, the last months first;
    the middle ones are loaded once more in the end."""
    def write(root):
        rides = _resent(derived_feed(spark, sf_dir))
        months = sorted(r[0] for r in rides.select("source_month").distinct().collect())
        third = -(-len(months) // 3)
        parts = [months[at:at + third] for at in range(0, len(months), third)]
        for part in (*parts[::-1], parts[len(parts) // 2]):
            run_bronze_to_silver(spark, LakePaths(root), rides, months=part)
            vacuum(spark, root, keep=1)  # months are written anew by every load that shares rides with them
    root = _once(spark, sf_dir, "cross_file", write)
    return _silver_out(read_table(spark, LakePaths(root).silver_rides))


def q_zone_csv_scan(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    path = _once(spark, sf_dir, "zone_csv", lambda p: files.write_zone_reference_csv(inp.zone_reference, p))
    return round_geo(files.read_zone_reference_csv(spark, path))


def _written_fact(spark, inp: Inputs) -> str:
    return _once(spark, inp.sf_dir, "fact", lambda p: write_table(inp.fact, p, schemas.FACT_PARTITION_COLUMNS))


def q_partition_glob_scan(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    root = _written_fact(spark, inp)
    return files.read_partition_glob(spark, root, "*").select(*inp.fact.columns).drop("trip_id")


def q_gold_partitioned_roundtrip(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    root = _written_fact(spark, inp)
    return spark.read.parquet(root).select(*inp.fact.columns).drop("trip_id")


def q_zone_lookup_standardise(spark, sf_dir):
    return Inputs(spark, sf_dir).lookup


def q_monthly_source_manifest(spark, sf_dir):
    """URLs for every month of the years the ride feed spans (bounds derived from the data)."""
    bronze = Inputs(spark, sf_dir).bronze
    bounds = bronze.agg(F.min(F.year("pickup_datetime")).alias("start_year"),
                        F.max(F.year("pickup_datetime")).alias("end_year"))
    return monthly_source_manifest(bounds)


# --------------------------------------------------------------------------- silver

def q_standardise_rides(spark, sf_dir):
    return standardise_rides(Inputs(spark, sf_dir).prepared)


def q_lenient_cast(spark, sf_dir):
    """Text-typed landing (every column a string) cast back to typed columns; ``dispatching_base_num``
    text such as ``B03`` cast to INT is malformed and becomes NULL instead of failing."""
    b = Inputs(spark, sf_dir).bronze
    text = b.select([F.col(c).cast("string").alias(c) for c in b.columns])
    target = {f.name: f.dataType for f in schemas.BRONZE_RIDES.fields}
    target.update({"PULocationID": T.IntegerType(), "DOLocationID": T.IntegerType(),
                   "dispatching_base_num": T.IntegerType()})
    return lenient_cast(text, target).select(
        "hvfhs_license_num", "dispatching_base_num", "request_datetime", "pickup_datetime",
        "PULocationID", "DOLocationID", "trip_miles", "trip_time", "base_passenger_fare", "tips")


def q_drop_operational_columns(spark, sf_dir):
    return drop_operational_columns(Inputs(spark, sf_dir).bronze)


def q_null_fill_on_scene(spark, sf_dir):
    b = Inputs(spark, sf_dir).bronze
    return fill_on_scene(b).select("hvfhs_license_num", "request_datetime", "on_scene_datetime",
                                   "pickup_datetime", "PULocationID", "DOLocationID")


def q_trip_id_unique(spark, sf_dir):
    return M.id_uniqueness(Inputs(spark, sf_dir).silver)


def q_derive_trip_columns(spark, sf_dir):
    return Inputs(spark, sf_dir).derived.select(
        "hvfhs_license_num", "start_time", "end_time", "reported_duration_sec",
        "trip_duration_sec", "year", "month", "day")


def q_valid_rides(spark, sf_dir):
    return Inputs(spark, sf_dir).valid


def q_quarantine_rides(spark, sf_dir):
    return R.quarantine_rows(Inputs(spark, sf_dir).prepared)


def q_quarantine_rides_drop_mode(spark, sf_dir):
    """Quarantine in the mode that leaves out rows which cannot be judged."""
    return R.quarantine_rows(Inputs(spark, sf_dir).prepared, on_null="drop")


def q_unknown_validity_rides(spark, sf_dir):
    return R.unknown_rows(Inputs(spark, sf_dir).prepared)


def q_quarantine_reason_counts(spark, sf_dir):
    return R.reason_counts(R.quarantine_rows(Inputs(spark, sf_dir).prepared))


def q_duration_mismatch(spark, sf_dir):
    """Silver rides whose computed and reported durations differ by more than the tolerance,
    per provider."""
    silver = Inputs(spark, sf_dir).silver
    _, ok = R.duration_rule(DURATION_TOLERANCE_SEC)
    diff = F.abs(F.col("trip_duration_sec") - F.col("reported_duration_sec"))
    return (silver.filter(~ok).groupBy("hvfhs_license_num")
            .agg(F.count(F.lit(1)).alias("mismatched_rides"), F.max(diff).alias("max_abs_diff_sec")))


def q_split_reconciliation(spark, sf_dir):
    return S.split_counts(Inputs(spark, sf_dir).prepared)


def q_dedupe_rides(spark, sf_dir):
    return dedupe(Inputs(spark, sf_dir).derived, schemas.NATURAL_KEY)


def q_silver_rides(spark, sf_dir):
    return _silver_out(Inputs(spark, sf_dir).silver)


def q_pipeline_counts(spark, sf_dir):
    return S.pipeline_counts(Inputs(spark, sf_dir).prepared)


def q_preview_as_strings(spark, sf_dir):
    return preview(_silver_out(Inputs(spark, sf_dir).silver), list(schemas.NATURAL_KEY), PREVIEW_ROWS)


def q_null_profile(spark, sf_dir):
    return M.null_profile(Inputs(spark, sf_dir).bronze)


# --------------------------------------------------------------------------- gold

def q_fact_rides(spark, sf_dir):
    return Inputs(spark, sf_dir).fact.drop("trip_id")


def q_dim_date(spark, sf_dir):
    return Inputs(spark, sf_dir).dim_date


def q_dim_zone(spark, sf_dir):
    """dim_zone as published: the zone reference goes through its CSV file and back."""
    inp = Inputs(spark, sf_dir)
    path = _once(spark, sf_dir, "zone_csv", lambda p: files.write_zone_reference_csv(inp.zone_reference, p))
    return round_geo(G.dim_zone(files.read_zone_reference_csv(spark, path)))


def q_kpi_totals(spark, sf_dir):
    return M.kpi_totals(Inputs(spark, sf_dir).fact)


def q_daily_rides_trend(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return M.daily_rides_trend(inp.fact, inp.dim_date)


def q_rides_by_hour(spark, sf_dir):
    return M.rides_by_hour(Inputs(spark, sf_dir).fact)


def q_rides_by_provider(spark, sf_dir):
    return M.rides_by_provider(Inputs(spark, sf_dir).fact)


def q_rides_by_pickup_zone(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return round_geo(M.rides_by_pickup_zone(inp.fact, inp.dim_zone))


def q_rides_by_zone_pair(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return M.rides_by_zone_pair(inp.fact, inp.dim_zone)


def q_rides_by_weekday_flag(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return M.rides_by_weekday_flag(inp.fact, inp.dim_date)


def q_fact_orphan_keys(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return M.fact_orphan_keys(inp.fact, inp.dim_date, inp.dim_zone)


def q_agg_trips_daily(spark, sf_dir):
    return M.agg_trips_daily(Inputs(spark, sf_dir).fact)


def q_agg_trips_by_zone(spark, sf_dir):
    return M.agg_trips_by_zone(Inputs(spark, sf_dir).fact)


def q_agg_trips_by_hour(spark, sf_dir):
    return M.agg_trips_by_hour(Inputs(spark, sf_dir).fact)


def q_agg_trips_by_company(spark, sf_dir):
    return M.agg_trips_by_company(Inputs(spark, sf_dir).fact)


# --------------------------------------------------------------------------- zones / geo

def q_zone_geometry_join(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return round_geo(zone_geometry_join(inp.lookup, inp.geometry))


def q_zones_without_geometry(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return zones_without_geometry(inp.lookup, inp.geometry)


def q_zone_centroid_from_geojson(spark, sf_dir):
    """Per geometry row: area (rounded) and area centroid."""
    g = geometry_centroids(Inputs(spark, sf_dir).geometry)
    return round_geo(g.select("location_id", F.round("area", 8).alias("area"), "centroid_lat", "centroid_lon"))


def q_zone_centroid_projected(spark, sf_dir):
    """Per geometry row in map feet: centroid and area in degrees, of the shape brought into degrees first."""
    g = geometry_centroids(project_geometry(testdata.projected_geometry(spark, sf_dir), NEW_YORK_LONG_ISLAND_FT))
    return round_geo(g.select("p_partkey", "location_id", F.round("area", 8).alias("area"), "centroid_lat", "centroid_lon"))


def q_spatial_cell(spark, sf_dir):
    """Grid cell of every zone's combined centroid at three levels."""
    z = combine_zone_geometry(Inputs(spark, sf_dir).geometry)
    return z.select("location_id", *[
        spatial_cell("centroid_lat", "centroid_lon", lvl).alias(f"cell_{lvl}") for lvl in (8, DEFAULT_CELL_LEVEL, 20)
    ])


def q_dim_zone_with_cell(spark, sf_dir):
    return round_geo(Inputs(spark, sf_dir).zone_reference)


def q_enrich_pickup_dropoff(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    rides = inp.silver.select("hvfhs_license_num", "request_datetime", "start_time", "end_time",
                              "pu_location_id", "do_location_id")
    # the published dimension: the planner knows the size of its file
    path = _once(spark, sf_dir, "zone_csv", lambda p: files.write_zone_reference_csv(inp.zone_reference, p))
    return round_geo(enrich_pickup_dropoff(rides, files.read_zone_reference_csv(spark, path)))


def q_rides_by_cell(spark, sf_dir):
    inp = Inputs(spark, sf_dir)
    return rides_by_cell(inp.fact, inp.dim_zone)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
