import datetime as dt

from conftest import SF_SMALL
from helpers import bronze_df, ride
from tripstar import schemas
from tripstar.paths import LakePaths
from tripstar.plans.pipeline import build_reference, run_pipeline
from tripstar.plans.publish import read_table
from tripstar.registry import Inputs
from tripstar.sources import testdata

# Silver rows of the smallest tables; the same number comes from the oracle SQL.
N_SILVER = 5510


def test_run_pipeline_end_to_end(spark, tmp_dir):
    paths = LakePaths(tmp_dir)
    inp = Inputs(spark, SF_SMALL)
    testdata.bronze_rides(spark, SF_SMALL).write.parquet(paths.bronze_rides)
    build_reference(spark, paths, inp.lookup, inp.geometry)
    res = run_pipeline(spark, paths, database="lake_e2e", enrich_geo=True)
    c = res.counts
    assert {"start_lat", "end_geo_hash"} <= set(read_table(spark, paths.silver_rides_geo).columns)
    assert c["silver_rows"] == c["fact_rides"] == c["silver_geo_rows"] == N_SILVER
    assert c["bronze_rows"] == 6309 == c["valid_rows"] + c["quarantine_rows"]
    assert c["quarantine_rows"] == c["failed_rows"] + c["unknown_rows"]
    assert c["dim_zone"] == 200
    assert spark.table("lake_e2e.fact_rides").count() == N_SILVER
    from tripstar.plans.reports import register_report_views

    views = register_report_views(spark, "lake_e2e")
    assert len(views) == 13
    assert spark.sql("SELECT sum(rides) AS n FROM rides_by_hour").first().n == N_SILVER
    assert spark.sql("SELECT total_rides FROM kpi_totals").first().total_rides == N_SILVER
    plan = spark.sql("SELECT * FROM rides_by_pickup_zone")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "ExistingRDD" not in plan  # no snapshot pinned
    register_report_views(spark, "lake_e2e", prefix="q1_", start="1996-01-01", end="1996-03-31")
    q1 = spark.sql("SELECT total_rides FROM q1_kpi_totals").first().total_rides
    want = spark.table("lake_e2e.fact_rides").filter("date_key BETWEEN 19960101 AND 19960331").count()
    assert q1 == want and 0 < q1 < N_SILVER
    silver = read_table(spark, paths.silver_rides)
    assert silver.columns == [f.name for f in schemas.SILVER_RIDES.fields + schemas.SILVER_DERIVED.fields] + ["source_month"]
    assert silver.select("trip_id").distinct().count() == N_SILVER
    # the README's flow: the views stay, a month is loaded again, nothing changes
    before = sorted(map(str, silver.collect()))
    tables = spark.table("lake_e2e.fact_rides").count()
    run_pipeline(spark, paths, database="lake_e2e", months=["1995-03"])
    assert before == sorted(map(str, read_table(spark, paths.silver_rides).collect()))
    assert spark.table("lake_e2e.fact_rides").count() == tables
    assert spark.sql("SELECT sum(rides) AS n FROM rides_by_hour").first().n == N_SILVER


def _rides(month, days, **over):
    return [ride(pickup_datetime=dt.datetime(2024, month, d, 9), request_datetime=dt.datetime(2024, month, d, 8),
                 dropoff_datetime=dt.datetime(2024, month, d, 10), **over) for d in days]


def _monthly(spark, months):
    from pyspark.sql import functions as F

    out = None
    for m, rows in months.items():
        df = bronze_df(spark, rows).withColumn("source_month", F.lit(m))
        out = df if out is None else out.unionByName(df)
    return out


def test_months_replace_themselves_whole(spark, tmp_dir):
    paths = LakePaths(tmp_dir)
    inp = Inputs(spark, SF_SMALL)
    build_reference(spark, paths, inp.lookup, inp.geometry)
    undated = ride(pickup_datetime=None)
    feed = {"2024-01": [*_rides(1, (1, 2, 3)), ride(tips=-1.0)], "2024-02": [*_rides(2, (1, 2)), undated, ride(tips=-1.0)]}
    for m in feed:
        c = run_pipeline(spark, paths, _monthly(spark, feed), months=[m]).counts
        assert c["bronze_rows"] == len(feed[m]) == c["valid_rows"] + c["quarantine_rows"]
    fact = read_table(spark, paths.gold("fact_rides"))
    assert sorted((r.month, r.day) for r in fact.collect()) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]
    ids = fact.select("trip_id").unionByName(read_table(spark, paths.quarantine_rides).select("trip_id"))
    assert ids.distinct().count() == ids.count() == 8
    january = {r.trip_id for r in fact.filter("month = 1").collect()}
    # February again, without its second day and with a ride of a January day
    feed["2024-02"] = [*_rides(2, (1,)), *_rides(1, (3,), PULocationID=7)]
    run_pipeline(spark, paths, _monthly(spark, feed), months=["2024-02"])
    fact = read_table(spark, paths.gold("fact_rides"))
    assert sorted((r.month, r.day) for r in fact.collect()) == [(1, 1), (1, 2), (1, 3), (1, 3), (2, 1)]
    assert january <= {r.trip_id for r in fact.collect()}
    quarantine = read_table(spark, paths.quarantine_rides)
    assert [r.source_month for r in quarantine.select(quarantine.source_month.cast("string")).collect()] == ["2024-01"]
    base = read_table(spark, paths.gold("agg_trips_daily"))
    assert sorted((r.date_key, r.rides) for r in base.collect()) == [(20240101, 1), (20240102, 1), (20240103, 2), (20240201, 1)]


def test_empty_and_all_bad_input(spark, tmp_dir):
    paths = LakePaths(tmp_dir)
    inp = Inputs(spark, SF_SMALL)
    build_reference(spark, paths, inp.lookup, inp.geometry)
    bad = _monthly(spark, {"2024-01": [ride(tips=-1.0), ride(trip_time=None)]})
    c = run_pipeline(spark, paths, bad, database="lake_bad").counts
    assert (c["silver_rows"], c["quarantine_rows"], c["fact_rides"], c["agg_trips_daily"]) == (0, 2, 0, 0)
    assert spark.table("lake_bad.fact_rides").count() == 0
    c = run_pipeline(spark, paths, bad, database="lake_bad", months=["2024-05"]).counts
    assert (c["bronze_rows"], c["silver_rows"]) == (0, 0)
    assert read_table(spark, paths.quarantine_rides).count() == 2


def test_quarantine_history(spark, tmp_dir):
    from tripstar.plans.pipeline import run_bronze_to_silver

    paths = LakePaths(tmp_dir)
    feed = _monthly(spark, {"2024-01": [ride(tips=-1.0)], "2024-02": [ride(tips=-1.0), ride(tolls=-1.0)]})
    for m in ("2024-01", "2024-02"):
        run_bronze_to_silver(spark, paths, feed, months=[m], quarantine_mode="append", run_id=m)
    q = read_table(spark, paths.quarantine_rides)
    assert sorted((str(r.run_id), r["count"]) for r in q.groupBy("run_id").count().collect()) == [("2024-01", 1), ("2024-02", 2)]
