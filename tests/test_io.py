import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import bronze_df, ride
from tripstar import schemas
from tripstar.plans.publish import register_gold_tables, remove_partitions, run_statements, sync_partitions, write_table
from tripstar.sources import files
from tripstar.sources.manifest import TLC_FHVHV_BASE_URL, manifest_for_years


def _month_rows(month, n=3):
    return [ride(pickup_datetime=dt.datetime(2024, month, d, 9), request_datetime=dt.datetime(2024, month, d, 8),
                 dropoff_datetime=dt.datetime(2024, month, d, 10), tips=float(d)) for d in range(1, n + 1)]


def _fact(spark, rows):
    from tripstar.operators.gold import fact_rides
    from tripstar.plans.silver import bronze_to_silver

    return fact_rides(bronze_to_silver(bronze_df(spark, rows)).silver)


def test_partitions_are_replaced_alone(spark, tmp_dir):
    root = f"{tmp_dir}/fact"
    write_table(_fact(spark, _month_rows(1) + _month_rows(2)), root, schemas.FACT_PARTITION_COLUMNS)
    assert sorted(os.listdir(f"{root}/year=2024")) == ["month=1", "month=2"]
    # rewrite the partition of 2024-02-01 only (a new, longer ride): every other day stays untouched
    redo = [dict(r, trip_miles=9.0) for r in _month_rows(2, n=1)]
    remove_partitions(spark, root, ["year=2024/month=2/day=1", "year=2024/month=3/day=1"])
    write_table(_fact(spark, redo), root, schemas.FACT_PARTITION_COLUMNS, mode="append")
    back = spark.read.parquet(root)
    assert back.filter("month = 1").count() == 3 and back.filter("month = 2").count() == 3
    assert [r.distance for r in back.filter("month = 2 AND day = 1").collect()] == [9.0]
    assert {r.distance for r in back.filter("NOT (month = 2 AND day = 1)").collect()} == {2.5}
    # partition pruning: a month predicate lists only that directory
    plan = back.filter("year = 2024 AND month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_register_and_sync_partitions(spark, tmp_dir):
    gold = f"{tmp_dir}/gold"
    write_table(_fact(spark, _month_rows(3)), f"{gold}/fact_rides", schemas.FACT_PARTITION_COLUMNS)
    spark.createDataFrame([], schemas.DIM_DATE).write.parquet(f"{gold}/dim_date")
    spark.createDataFrame([], schemas.DIM_ZONE).write.parquet(f"{gold}/dim_zone")
    register_gold_tables(spark, "lake_test", gold)
    register_gold_tables(spark, "lake_test", gold)  # idempotent
    assert spark.table("lake_test.fact_rides").count() == 0  # partitions unknown to the catalog yet
    sync_partitions(spark, "lake_test.fact_rides")
    assert spark.table("lake_test.fact_rides").count() == 3
    assert run_statements(spark, ["", "  ", "SELECT 1"]) == 1


def test_merge_schema_and_int_long_drift(spark, tmp_dir):
    root = f"{tmp_dir}/bronze"
    old = spark.createDataFrame([(1, 1.0)], "PULocationID INT, trip_miles DOUBLE")
    new = spark.createDataFrame([(2, 2.0, 0.75)], "PULocationID INT, trip_miles DOUBLE, cbd_congestion_fee DOUBLE")
    old.write.parquet(f"{root}/m=1")
    new.write.parquet(f"{root}/m=2")
    merged = files.read_bronze(spark, root)
    assert merged.columns == [f.name for f in schemas.BRONZE_RIDES] + ["cbd_congestion_fee", "m"]
    assert sorted((r.PULocationID, r.cbd_congestion_fee) for r in merged.collect()) == [(1, None), (2, 0.75)]
    # int in one file, long in another: merging fails, the declared wider schema reads both
    drift = f"{tmp_dir}/drift"
    spark.createDataFrame([(1,)], "PULocationID INT").write.parquet(f"{drift}/a")
    spark.createDataFrame([(2**40,)], "PULocationID BIGINT").write.parquet(f"{drift}/b")
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", True).parquet(f"{drift}/a", f"{drift}/b").collect()
    wide = T.StructType([T.StructField("PULocationID", T.LongType())])
    got = sorted(r[0] for r in spark.read.schema(wide).parquet(f"{drift}/a", f"{drift}/b").collect())
    assert got == [1, 2**40]
    # the same between monthly partitions, with a column that came later
    monthly = f"{tmp_dir}/monthly"
    spark.createDataFrame([(1,)], "PULocationID INT").write.parquet(f"{monthly}/source_month=2024-01")
    spark.createDataFrame([(2**40, 0.5)], "PULocationID BIGINT, fee DOUBLE").write.parquet(f"{monthly}/source_month=2024-02")
    got = files.read_bronze(spark, monthly).select("PULocationID", "fee", F.col("source_month").cast("string").alias("m")).collect()
    assert sorted(map(tuple, got)) == [(1, None, "2024-01"), (2**40, 0.5, "2024-02")]


def test_zone_csv_roundtrip_with_geojson(spark, tmp_dir):
    geo = json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]})
    rows = [(1, "EWR", "Newark Airport", "EWR", geo, 0.5, 0.6, "16/1/2", 16),
            (2, "Queens", 'Jamaica "Bay", North', None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, schemas.DIM_ZONE)
    files.write_zone_reference_csv(df, f"{tmp_dir}/z")
    back = sorted(files.read_zone_reference_csv(spark, f"{tmp_dir}/z").collect())
    assert [tuple(r) for r in back] == rows
    # without escape='"' the GeoJSON cell is torn apart
    torn = spark.read.option("header", True).csv(f"{tmp_dir}/z")
    assert [r.polygon_geojson for r in torn.collect() if r.location_id == "1"] != [geo]


def test_zone_lookup_csv_na_is_null(spark, tmp_dir):
    p = f"{tmp_dir}/lookup.csv"
    with open(p, "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n264,Unknown,N/A,N/A\n")
    got = sorted(tuple(r) for r in files.read_zone_lookup_csv(spark, p).collect())
    assert got == [(1, "EWR", "Newark Airport", "EWR"), (264, "Unknown", None, None)]


def test_manifest(spark, tmp_dir):
    urls = [r.url for r in manifest_for_years(spark, 2024, 2025).collect()]
    expected = [f"{TLC_FHVHV_BASE_URL}{y}-{m:02d}.parquet" for y in (2024, 2025) for m in range(1, 13)]
    assert urls == expected
    with pytest.raises(ValueError):
        manifest_for_years(spark, 2025, 2024)
    files.write_text_lines(manifest_for_years(spark, 2024, 2025).coalesce(1), "url", f"{tmp_dir}/m")
    lines = [ln for fn in sorted(os.listdir(f"{tmp_dir}/m")) if fn.startswith("part-")
             for ln in open(f"{tmp_dir}/m/{fn}").read().splitlines()]
    assert lines == expected


def test_manifest_bad_bounds_fail_in_job(spark):
    from tripstar.sources.manifest import monthly_source_manifest

    bounds = spark.createDataFrame([(2025, 2024)], "start_year INT, end_year INT")
    with pytest.raises(Exception):
        monthly_source_manifest(bounds).collect()


def test_source_file_provenance(spark, tmp_dir):
    bronze_df(spark, [ride()]).write.parquet(f"{tmp_dir}/one")
    r = files.read_with_source_file(spark, f"{tmp_dir}/one").select("source_file").first()
    assert r.source_file.endswith(".parquet")


def test_partition_glob_keeps_partition_columns(spark, tmp_dir):
    root = f"{tmp_dir}/fact"
    write_table(_fact(spark, _month_rows(1) + _month_rows(2)), root, schemas.FACT_PARTITION_COLUMNS)
    one_year = files.read_partition_glob(spark, root, "year=2024/*")
    assert {"year", "month", "day"} <= set(one_year.columns) and one_year.count() == 6
    assert files.read_partition_glob(spark, root, "year=2024/month=2/*").select(F.max("month")).first()[0] == 2


def test_text_and_centroid_csv_readers(spark, tmp_dir):
    p = f"{tmp_dir}/centroids.csv"
    with open(p, "w") as f:
        f.write("LocationID,lat,lon\n1,40.69,-74.17\n2,,\n")
    got = sorted(tuple(r) for r in files.read_zone_centroids_csv(spark, p).collect())
    assert got == [(1, 40.69, -74.17), (2, None, None)]
    assert files.read_csv_as_strings(spark, p).schema.simpleString() == "struct<LocationID:string,lat:string,lon:string>"


def test_scratch_goes_with_the_application(tmp_dir):
    import subprocess
    import sys
    import time

    code = f"""
from pyspark.sql import SparkSession
from tripstar.paths import scratch_path
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {tmp_dir!r}).getOrCreate()
path = scratch_path(spark, "x")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3 and path != scratch_path(spark, "x")
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=300)
    for _ in range(120):  # the JVM ends after the interpreter
        left = [f for _, _, files in os.walk(tmp_dir) for f in files]
        if not left:
            break
        time.sleep(0.5)
    assert left == []


def _small_tables(spark, root):
    spark.sql("SELECT id AS r_regionkey, concat('R', id) AS r_name FROM range(5)").write.parquet(f"{root}/region.parquet")
    spark.sql("SELECT id AS p_partkey, CAST(1 + id % 50 AS INT) AS p_size FROM range(1, 40)").write.parquet(f"{root}/part.parquet")
    spark.sql("""SELECT id AS l_orderkey, id % 7 AS l_partkey, id % 11 AS l_suppkey, CAST(1 + id % 7 AS INT) AS l_linenumber,
        CAST(1 + id % 50 AS DOUBLE) AS l_quantity, 10.0D * id AS l_extendedprice, 0.05D AS l_discount, 0.02D AS l_tax, 'N' AS l_returnflag,
        CAST(date_add(DATE'1995-05-20', CAST(id % 60 AS INT)) AS TIMESTAMP_NTZ) AS l_shipdate FROM range(1, 60)""").write.parquet(f"{root}/lineitem.parquet")


@pytest.mark.parametrize("folder_stays", [False, True])
def test_queries_run_again_after_their_scratch_was_cleared(spark, tmp_dir, folder_stays):
    from tripstar import registry

    _small_tables(spark, f"{tmp_dir}/sf")
    for name in ("csv_as_strings", "drop_operational_columns", "bronze_scan_merge_schema"):
        query = registry.QUERIES[name]
        first = query(spark, f"{tmp_dir}/sf")
        want, used = first.count(), set(first.inputFiles())
        assert set(query(spark, f"{tmp_dir}/sf").inputFiles()) == used  # written once
        for i, f in enumerate(sorted(used)):
            f = f.removeprefix("file:").replace("///", "/")
            if folder_stays:
                os.rename(f, f"{tmp_dir}/{name}-{i}")
            elif os.path.exists(f):
                folder = f[:f.index("/", f.index("/tripstar/local-") + len("/tripstar/local-"))]
                top = "/".join([folder, f[len(folder) + 1:].split("/")[0]])
                os.rename(top, f"{tmp_dir}/{name}-{i}")
        assert query(spark, f"{tmp_dir}/sf").count() == want > 0


def test_lake_queries_run_again_after_their_scratch_was_cleared(spark, tmp_dir):
    from tripstar import registry

    names = ("catalog_fact_after_sync", "incremental_months_fact", "incremental_months_quarantine", "incremental_months_silver",
             "cross_file_dedupe", "gold_partitioned_roundtrip")
    sf = f"{tmp_dir}/sf"
    spark.sql("SELECT id AS r_regionkey, concat('R', id) AS r_name FROM range(5)").write.parquet(f"{sf}/region.parquet")
    spark.sql("SELECT id AS p_partkey, CAST(1 + id % 50 AS INT) AS p_size FROM range(1, 40)").write.parquet(f"{sf}/part.parquet")
    spark.sql("""SELECT id AS l_orderkey, id % 7 AS l_partkey, id % 11 AS l_suppkey, CAST(1 + id % 7 AS INT) AS l_linenumber,
        CAST(1 + id % 50 AS DOUBLE) AS l_quantity, 10.0D * id AS l_extendedprice, 0.05D AS l_discount, 0.02D AS l_tax, 'N' AS l_returnflag,
        CAST(date_add(DATE'1995-02-20', CAST(id % 40 AS INT)) AS TIMESTAMP_NTZ) AS l_shipdate FROM range(1, 60)""").write.parquet(f"{sf}/lineitem.parquet")

    def results():
        return {name: sorted(map(str, registry.QUERIES[name](spark, sf).collect())) for name in names}

    def folders():
        return {path for (_, tables, _), (path, _) in registry._written.items() if tables == sf}

    want, own = results(), folders()
    for i, path in enumerate(sorted(own)):
        os.rename(path.removeprefix("file:"), f"{tmp_dir}/gone-{i}")
    assert results() == want and all(want.values())
    assert not own & folders()


WRITING_QUERIES = """agg_trips_by_zone agg_trips_by_hour bronze_scan_merge_schema agg_trips_daily catalog_fact_after_sync cross_file_dedupe
csv_as_strings daily_rides_trend dedupe_rides derive_trip_columns dim_date dim_zone drop_operational_columns duration_mismatch
enrich_pickup_dropoff fact_orphan_keys fact_rides gold_partitioned_roundtrip incremental_months_fact incremental_months_quarantine
incremental_months_silver""".split()


def test_writing_queries_run_on_a_cluster_with_a_file_checkpoint_folder(spark, tmp_dir, monkeypatch):
    """A session of a standalone cluster whose checkpoint folder is a mount that all machines share."""
    from tripstar import registry
    from tripstar.paths import checkpoint_root

    _small_tables(spark, f"{tmp_dir}/sf")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert checkpoint_root(spark).startswith("file:")
    rows = {name: registry.QUERIES[name](spark, f"{tmp_dir}/sf").count() for name in WRITING_QUERIES}
    assert all(rows.values()), rows


def test_a_configured_checkpoint_folder_is_taken_as_it_is():
    from types import SimpleNamespace

    from tripstar.paths import checkpoint_root

    def session(current):
        return SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: current, master="spark://host:7077"),
                               conf=SimpleNamespace(get=lambda key, default: default))
    assert checkpoint_root(session("file:/mnt/shared/ckpt/")) == "file:/mnt/shared/ckpt"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(session(None))
