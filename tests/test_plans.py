"""Plan-shape regression tests for the scale properties the design relies on."""

import re

from conftest import SF_SMALL
from tripstar import schemas
from tripstar.operators import gold as G
from tripstar.operators import metrics as M
from tripstar.plans.silver import bronze_to_silver
from tripstar.registry import Inputs
from tripstar.sources import files, testdata


def _plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan):
    return re.findall(r"Exchange (\w+)", plan)


def test_silver_shuffles_twice_and_pushes_rules(spark, tmp_dir):
    testdata.bronze_rides(spark, SF_SMALL).write.parquet(f"{tmp_dir}/bronze")
    bronze = files.read_bronze(spark, f"{tmp_dir}/bronze", schemas.BRONZE_RIDES)
    res = bronze_to_silver(bronze)
    plan = _plan(res.silver)
    # the dedupe on the natural key, then the numbering on month and cell
    assert _exchanges(plan) == ["hashpartitioning", "hashpartitioning"]
    assert "hashpartitioning(hvfhs_license_num" in plan and "hashpartitioning(__month" in plan
    assert "GreaterThanOrEqual(PULocationID,1)" in plan  # rules reach the scan
    assert "dispatching_base_num" not in plan.split("ReadSchema:", 1)[1].split("\n", 1)[0]  # pruned
    q = _plan(res.quarantine)
    assert _exchanges(q) == []  # quarantine is map-only


def test_join_queries_start_no_job(spark):
    from tripstar.registry import QUERIES

    names = ("dim_zone_with_cell", "zone_geometry_join", "daily_rides_trend", "rides_by_pickup_zone", "rides_by_zone_pair",
             "rides_by_weekday_flag", "fact_orphan_keys", "rides_by_cell")
    QUERIES["fact_rides"](spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    for name in names:
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        QUERIES[name](spark, SF_SMALL)
        # reading the footers of a table for its schema is the only work
        assert len(tracker.getJobIdsForGroup(f"build-{name}")) <= 5, name
    spark.sparkContext.setJobGroup("", "")


def test_fact_build_is_map_only(spark, tmp_dir):
    silver = Inputs(spark, SF_SMALL).silver
    silver.write.parquet(f"{tmp_dir}/silver")
    fact = G.fact_rides(spark.read.parquet(f"{tmp_dir}/silver"))
    assert _exchanges(_plan(fact)) == []


def test_reports_broadcast_dimensions_never_shuffle_fact_for_joins(spark, tmp_dir):
    inp = Inputs(spark, SF_SMALL)
    inp.fact.write.parquet(f"{tmp_dir}/fact")
    G.dim_zone(inp.zone_reference).write.parquet(f"{tmp_dir}/dim_zone")
    inp.dim_date.write.parquet(f"{tmp_dir}/dim_date")
    fact = spark.read.parquet(f"{tmp_dir}/fact")
    dz, dd = spark.read.parquet(f"{tmp_dir}/dim_zone"), spark.read.parquet(f"{tmp_dir}/dim_date")
    for df in (M.rides_by_pickup_zone(fact, dz), M.rides_by_zone_pair(fact, dz),
               M.daily_rides_trend(fact, dd), M.fact_orphan_keys(fact, dd, dz)):
        plan = _plan(df)
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert "BroadcastHashJoin" in plan
        # the only hash exchanges are the aggregates' (partial aggregation before them)
        assert "partial_count" in plan


def test_partitioned_write_rebalances(spark, tmp_dir):
    from tripstar.plans.publish import write_table

    inp = Inputs(spark, SF_SMALL)
    df = inp.fact.hint("rebalance", *schemas.FACT_PARTITION_COLUMNS)
    assert "RebalancePartitions" in df._jdf.queryExecution().optimizedPlan().toString()
    write_table(inp.fact.filter("year = 1995 AND month = 1"), f"{tmp_dir}/f", schemas.FACT_PARTITION_COLUMNS)
    assert spark.read.parquet(f"{tmp_dir}/f").count() > 0


def test_hot_day_is_split_across_writer_tasks(spark, tmp_dir):
    """A day holding a third of all rows is written by several tasks (AQE splits the skewed
    rebalance partition), not by one task that would hold the whole hot day."""
    import os

    from pyspark.sql import functions as F

    from tripstar.plans.publish import write_table

    base = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 28 + 2)).alias("day"),
        F.lit(2024).alias("year"), F.lit(1).alias("month"), F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_table(base, f"{tmp_dir}/w", ("year", "month", "day"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    import pyarrow.parquet as pq

    hot_dir = f"{tmp_dir}/w/year=2024/month=1/day=1"
    rows = [pq.ParquetFile(f"{hot_dir}/{f}").metadata.num_rows for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert sum(rows) == 10000
    assert len(rows) > 1 and max(rows) <= sum(rows) / 2  # no single task wrote the hot day
    assert spark.read.parquet(f"{tmp_dir}/w").count() == 30000


def test_fact_files_sorted_by_zone_within_day(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    from tripstar.plans.publish import write_table

    inp = Inputs(spark, SF_SMALL)
    write_table(inp.fact, f"{tmp_dir}/f", schemas.FACT_PARTITION_COLUMNS, sort_within=("pu_location_id",))
    for path in glob.glob(f"{tmp_dir}/f/year=*/month=*/day=*/*.parquet")[:50]:
        zones = pq.read_table(path, columns=["pu_location_id"]).column(0).to_pylist()
        assert zones == sorted(zones)
