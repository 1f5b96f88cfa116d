"""The monthly chain: bronze -> silver (+ quarantine) -> gold -> catalog.

The unit of loading is the **source month**: the month of the file a row came in, whatever its pickup
time says (it may be NULL or lie in another month). Silver and quarantine are partitioned by it, so a
month is replaced whole, with rows that cannot be dated. Silver has a ride once, whichever files hold it
(:mod:`tripstar.plans.ownership`). The fact table is partitioned by day; a run rebuilds every day on which
the loaded months have or had rides, or on which rides changed hands between months, from all of silver.

All tables of a run are published together by one rename of the lake's manifest (:mod:`tripstar.plans.lake`):
a run that breaks off leaves the lake as it was and is repaired by running it again. Row counts are
observed by the tasks that write the rows, so no output is read again to count it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.functions.projection import LambertConic
from tripstar.operators import gold as G
from tripstar.operators import metrics as M
from tripstar.operators import rules as R
from tripstar.operators.geo import DEFAULT_CELL_LEVEL, build_zone_reference, enrich_pickup_dropoff, project_geometry
from tripstar.operators.standardise import add_quarantine_id
from tripstar.paths import LakePaths
from tripstar.plans import ownership
from tripstar.plans.lake import Commit, vacuum
from tripstar.plans.publish import register_gold_tables, sync_catalog
from tripstar.plans.reports import refresh_report_views
from tripstar.plans.silver import MONTH, month_rides, prepare
from tripstar.schemas import FACT_PARTITION_COLUMNS
from tripstar.sources.files import read_bronze, read_zone_reference_csv, write_zone_reference_csv

UNKNOWN_MONTH = "unknown"
# Partition column of the quarantine history.
RUN = "run_id"
SILVER, QUARANTINE, SILVER_GEO = ownership.SILVER, "quarantine/rides", "silver/rides_geo"


@dataclass
class PipelineResult:
    counts: dict[str, int] = field(default_factory=dict)
    version: int = 0  # of the manifest that the run published


def with_source_month(bronze: DataFrame) -> DataFrame:
    """Adds or cleans ``source_month`` (``yyyy-MM``): the landing partition if there is one, else the
    month in the file's name, else that of the pickup; ``unknown`` if none can be told."""
    month: Column = F.date_format("pickup_datetime", "yyyy-MM")
    if MONTH in bronze.columns:
        month = F.col(MONTH).cast("string")
    else:
        try:
            bronze.select("_metadata.file_name")
        except AnalysisException:
            pass  # not read from files
        else:
            name = F.regexp_extract(F.col("_metadata.file_name"), r"([0-9]{4}-[0-9]{2})\.[^/]*$", 1)
            month = F.when(name != "", name).otherwise(month)
    known = month.rlike("^[0-9]{4}-(0[1-9]|1[0-2])$")
    return bronze.withColumn(MONTH, F.when(known, month).otherwise(F.lit(UNKNOWN_MONTH)))


def build_reference(spark: SparkSession, paths: LakePaths, zone_lookup: DataFrame, zone_geometry: DataFrame,
                    level: int = DEFAULT_CELL_LEVEL, projection: LambertConic | None = None) -> None:
    """Zone reference CSV from a standardised lookup and GeoJSON geometry rows, in degrees or in the map
    coordinates of ``projection``."""
    if projection is not None:
        zone_geometry = project_geometry(zone_geometry, projection)
    write_zone_reference_csv(build_zone_reference(zone_lookup, zone_geometry, level), paths.zone_reference)


def _day_directory(day: int) -> str:
    """The fact partition of a day (yyyymmdd; 0 is a ride without a time)."""
    values = (day // 10000, day // 100 % 100, day % 100) if day else ("__HIVE_DEFAULT_PARTITION__",) * 3
    return "/".join(f"{c}={v}" for c, v in zip(FACT_PARTITION_COLUMNS, values, strict=True))


def _load_silver(commit: Commit, prepared: DataFrame, rules: list, months: list[str] | None) -> tuple[dict, set[int], list[str]]:
    """Silver of these source months (all if None): counts, the days that need a new fact table, and the months
    whose silver changed."""
    days_before = dict(commit.notes.get("month_days", {}))
    if months is None:
        commit.forget(ownership.SHADOWED)
    counts: dict[str, int] = {}
    for some in [None] if months is None else ownership.batches(months):
        valid = R.valid_rows(prepared if some is None or some == months else prepared.filter(F.col(MONTH).isin(*some)), rules)
        found = commit.write(
            SILVER, month_rides(valid, "__copies"), (MONTH,), None if some is None else [ownership.partition(m) for m in some],
            observe={"silver_rows": F.count(F.lit(1)), "valid_rows": F.sum("__copies")}, drop=["__copies"], rebalance=False,
            sort_within=ownership.SILVER_ORDER)
        counts = {n: counts.get(n, 0) + v for n, v in found.items()}
    replace = None if months is None else [ownership.partition(m) for m in months]
    found = ownership.month_days(commit.read(SILVER, replace))
    loaded = sorted({*days_before, *found}) if months is None else months
    days_now = {**{m: d for m, d in days_before.items() if m not in loaded}, **found}
    settled = ownership.settle(commit, loaded, {} if months is None else days_before, days_now)
    commit.clear_superseded()
    commit.notes["month_days"] = days_now
    counts["silver_rows"] -= settled.lost
    days = settled.days.union(*(d.get(m, ()) for m in loaded for d in (days_before, found)))
    return counts, days, sorted({*loaded, *settled.months})


def _load_quarantine(commit: Commit, prepared: DataFrame, rules: list, on_null: str, months: list[str] | None,
                     append_run: str | None) -> dict:
    """Quarantine of these source months, or of the run in the history: counts of failed and unknown rows.
    Rows that cannot be judged are counted in either mode, by the tasks that write the others."""
    rows = add_quarantine_id(R.quarantine_rows(prepared, rules), F.col(MONTH)).withColumn("__unknown", R.validity(rules).isNull())
    by, replace = (MONTH,), None if months is None else [ownership.partition(m) for m in months]
    if append_run is not None:
        rows, by, replace = rows.withColumn(RUN, F.lit(append_run)), (RUN, MONTH), [f"{RUN}={append_run}"]
    counts = commit.write(
        QUARANTINE, rows, by, replace, drop=["__unknown"], keep=None if on_null == "quarantine" else ~F.col("__unknown"),
        observe={"failed_rows": F.count_if(~F.col("__unknown")), "unknown_rows": F.count_if(F.col("__unknown"))})
    return {**counts, "quarantine_rows": counts["failed_rows"] + (counts["unknown_rows"] if on_null == "quarantine" else 0)}


def run_bronze_to_silver(spark: SparkSession, paths: LakePaths, bronze: DataFrame | None = None,
                         on_null: str = "quarantine", months: Sequence[str] | None = None,
                         quarantine_mode: str = "overwrite", run_id: str | None = None,
                         enrich_geo: bool = False, commit: Commit | None = None) -> dict:
    """Silver and quarantine writes; with ``enrich_geo`` also silver rides with pickup / dropoff
    coordinates and cells at ``paths.silver_rides_geo``. ``months`` loads these source months and
    replaces their partitions; without it all of silver is replaced. ``quarantine_mode="append"`` keeps
    a history of runs by ``run_id`` (a name of its own by default): running an id again replaces its rows,
    and the manifest records months and counts of every run. Returns row counts and the days touched.
    The tables are published here, or with the others of ``commit`` by whoever made it."""
    if on_null not in ("quarantine", "drop"):
        raise ValueError(f"on_null must be 'quarantine' or 'drop', got {on_null!r}")
    if quarantine_mode not in ("overwrite", "append"):
        raise ValueError(f"quarantine_mode must be 'overwrite' or 'append', got {quarantine_mode!r}")
    own, commit = commit is None, commit or Commit(spark, paths.root)
    run = None if quarantine_mode == "overwrite" else run_id or commit.name
    if run is not None and not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError(f"run_id may have letters, digits and _ . - only, got {run!r}")
    months = None if months is None else sorted(set(months))
    bronze = with_source_month(read_bronze(spark, paths.bronze_rides) if bronze is None else bronze)
    if months is not None:
        bronze = bronze.filter(F.col(MONTH).isin(*months))
    prepared, rules = prepare(bronze), R.ride_rules()
    counts, days, changed = _load_silver(commit, prepared, rules, months)
    counts.update(_load_quarantine(commit, prepared, rules, on_null, months, run))
    counts["bronze_rows"] = counts["valid_rows"] + counts["failed_rows"] + counts["unknown_rows"]
    if enrich_geo:
        # months that won or lost rides are written anew with the loaded ones
        under = None if months is None else [ownership.partition(m) for m in changed]
        zones = read_zone_reference_csv(spark, paths.zone_reference)
        # the rows come in the layout of silver's files: no exchange deals them out again
        commit.write(SILVER_GEO, enrich_pickup_dropoff(commit.read(SILVER, under), zones), (MONTH,), under, rebalance=False,
                     sort_within=ownership.SILVER_ORDER)
        counts["silver_geo_rows"] = commit.read(SILVER_GEO).count()
    if run is not None:
        commit.now["runs"][run] = {"months": months, "counts": counts, "version": commit.now["number"]}
    if own:
        commit.publish()
    if months is not None:
        counts = {**counts, "days": sorted(days)}
    return counts


def _all_days(commit: Commit) -> set[int]:
    return set().union(*commit.notes.get("month_days", {}).values())


def _rides_on(commit: Commit, days: set[int]) -> DataFrame:
    """Fact rows of these days, from the source months that have them."""
    sources = [ownership.partition(m) for m, d in commit.notes.get("month_days", {}).items() if not days.isdisjoint(d)]
    return G.fact_rides(commit.read(SILVER, sources).filter(ownership.day_of().isin(*days)))


def run_silver_to_gold(spark: SparkSession, paths: LakePaths, database: str | None = None,
                       days: Sequence[int] | None = None, commit: Commit | None = None) -> dict[str, int]:
    """Fact table, dimensions and pre-aggregates from silver. ``days`` (yyyymmdd) rebuilds these days alone: the
    fact table and the additive base of the pre-aggregates replace their partitions, and everything
    else is rolled up from the base, so the cost follows the days, not the history: of silver only the source
    months that have these days are read."""
    own, commit = commit is None, commit or Commit(spark, paths.root)
    fact, base_table, parts = "gold/fact_rides", "gold/agg_base", list(FACT_PARTITION_COLUMNS)
    if commit.entry(fact) is None:
        days = None
    if days is None:
        rides = dated = G.fact_rides(commit.read(SILVER))
        replace = months = None
    elif days:
        replace = [_day_directory(d) for d in sorted(set(days))]
        # the base is far smaller than the fact table, so whole calendar months of it are replaced
        months = sorted({d.rsplit("/", 1)[0] for d in replace})
        rides, dated = _rides_on(commit, set(days)), _rides_on(commit, {d for d in _all_days(commit) if _day_directory(d).rsplit("/", 1)[0] in months})
    if days is None or days:
        # fact files sorted by pickup zone inside each day: zone-filtered reads skip row groups
        commit.write(fact, rides, parts, replace, sort_within=("pu_location_id",))
        commit.write(base_table, M.base_aggregate(dated), parts[:2], months)
    base = commit.read(base_table)
    dates = base.select(F.make_date("year", "month", "day").alias("start_time"))
    zones = read_zone_reference_csv(spark, paths.zone_reference)
    n = {"n": F.count(F.lit(1))}
    counts = {"dim_date": commit.write("gold/dim_date", G.dim_date(dates), observe=n)["n"],
              "dim_zone": commit.write("gold/dim_zone", G.dim_zone(zones), observe=n)["n"]}
    for name, key in M.PREAGGREGATES.items():
        found = commit.write(f"gold/{name}", M.roll_up(base, key), observe={**n, "rides": F.sum("rides")})
        counts[name], counts["fact_rides"] = found["n"], found["rides"]
    if own:
        commit.publish()
        if database:
            publish_catalog(spark, paths, database)
    return counts


def publish_catalog(spark: SparkSession, paths: LakePaths, database: str) -> dict[str, int]:
    """The catalog's gold tables follow the last published version; report views of this session with them."""
    register_gold_tables(spark, database, paths.gold(""))
    ran = sync_catalog(spark, database, paths.root)
    # statistics let the planner size the dimensions (broadcast decisions) without scanning
    for dim in ("dim_date", "dim_zone"):
        spark.sql(f"ANALYZE TABLE {database}.{dim} COMPUTE STATISTICS")
    refresh_report_views(spark, database)
    return ran


def run_pipeline(spark: SparkSession, paths: LakePaths, bronze: DataFrame | None = None,
                 database: str | None = None, on_null: str = "quarantine", months: Sequence[str] | None = None,
                 quarantine_mode: str = "overwrite", run_id: str | None = None, enrich_geo: bool = False,
                 keep_versions: int | None = None) -> PipelineResult:
    """Bronze -> silver -> gold (-> catalog), published together. The zone reference must exist at
    ``paths.zone_reference`` (see :func:`build_reference`). ``months`` (``yyyy-MM`` source months) loads or
    reloads just these. ``keep_versions`` then removes directories that none of so many last versions uses
    (:func:`tripstar.plans.lake.vacuum`); by default nothing is removed."""
    commit = Commit(spark, paths.root)
    counts = run_bronze_to_silver(spark, paths, bronze, on_null, months, quarantine_mode, run_id, enrich_geo, commit)
    counts.update(run_silver_to_gold(spark, paths, None, counts.pop("days", None), commit))
    version = commit.publish()
    if database:
        publish_catalog(spark, paths, database)
    if keep_versions is not None:
        vacuum(spark, paths.root, keep_versions)
    return PipelineResult(counts, version)
