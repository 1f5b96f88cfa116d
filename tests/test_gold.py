import datetime as dt

from helpers import bronze_df, ride
from tripstar import schemas
from tripstar.operators import gold as G
from tripstar.plans.silver import bronze_to_silver


def test_saturday_dimension_row(spark):
    t = dt.datetime(2024, 1, 6, 10, 0)
    silver = bronze_to_silver(bronze_df(spark, [ride(pickup_datetime=t, request_datetime=t)])).silver
    d = G.dim_date(silver).first()
    assert (d.date_key, d.full_date, d.day_of_week, d.is_weekend) == (20240106, dt.date(2024, 1, 6), "Saturday", True)
    f = G.fact_rides(silver)
    assert f.columns == [x.name for x in schemas.FACT_RIDES.fields]
    r = f.first()
    assert (r.date_key, r.pickup_hour, r.year, r.month, r.day) == (20240106, 10, 2024, 1, 6)


def test_weekday_and_spine(spark):
    rows = [ride(pickup_datetime=dt.datetime(2024, 1, d, 9), request_datetime=dt.datetime(2024, 1, d, 8),
                 dropoff_datetime=dt.datetime(2024, 1, d, 10)) for d in (1, 5, 7)]
    silver = bronze_to_silver(bronze_df(spark, rows)).silver
    dims = {r.full_date.day: r for r in G.dim_date(silver).collect()}
    assert sorted(dims) == [1, 5, 7]
    assert dims[1].day_of_week == "Monday" and not dims[1].is_weekend
    assert dims[7].is_weekend
    assert G.dim_date(silver, spine=True).count() == 7


def test_dim_date_pk_unique_and_no_orphans(spark):
    from tripstar.registry import Inputs
    from tripstar.operators.metrics import fact_orphan_keys

    inp = Inputs(spark, "/root/testdata/sf0.001")
    dd = inp.dim_date
    assert dd.count() == dd.select("date_key").distinct().count()
    zones = inp.dim_zone
    assert zones.count() == zones.select("location_id").distinct().count()
    orphans = {r.foreign_key: r.orphan_rows for r in fact_orphan_keys(inp.fact, dd, zones).collect()}
    assert orphans["date_key"] == 0


def test_date_range_and_calendar_days_prune_partitions(spark, tmp_dir):
    from tripstar.operators.metrics import for_calendar_days, for_dates, rides_by_hour
    from tripstar.plans.publish import write_table

    rows = [ride(pickup_datetime=dt.datetime(2024, 1, d, 9), request_datetime=dt.datetime(2024, 1, d, 8),
                 dropoff_datetime=dt.datetime(2024, 1, d, 10)) for d in range(1, 15)]
    silver = bronze_to_silver(bronze_df(spark, rows)).silver
    write_table(G.fact_rides(silver), f"{tmp_dir}/fact", schemas.FACT_PARTITION_COLUMNS)
    write_table(G.dim_date(silver), f"{tmp_dir}/dim_date")
    fact, dd = spark.read.parquet(f"{tmp_dir}/fact"), spark.read.parquet(f"{tmp_dir}/dim_date")

    ranged = for_dates(fact, "2024-01-03", "2024-01-05")
    assert ranged.count() == 3
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]

    # a comparison / IN on the dimension is what Spark treats as selective enough to prune by
    weekend = for_calendar_days(fact, dd.filter("day_of_week IN ('Saturday', 'Sunday')"))
    assert weekend.count() == 4  # 6, 7, 13, 14 January 2024
    assert "dynamicpruning" in weekend._jdf.queryExecution().executedPlan().toString().lower()
    assert sum(r.rides for r in rides_by_hour(weekend).collect()) == 4
