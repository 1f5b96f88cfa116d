import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import bronze_df, ride
from tripstar import schemas
from tripstar.operators.standardise import (
    add_quarantine_id, add_trip_id, conform, derive_trip_columns, fill_on_scene, lenient_cast, rename_columns, standardise_rides,
)
from tripstar.plans.silver import prepare


def test_rename_ignores_absent_and_identity(spark):
    df = spark.createDataFrame([(1, 2)], "PULocationID INT, other INT")
    out = rename_columns(df, {"PULocationID": "pu_location_id", "missing": "x", "other": "other"})
    assert out.columns == ["pu_location_id", "other"]


def test_lenient_cast_malformed_to_null(spark):
    df = spark.createDataFrame([("x", "12"), ("7", "3.5")], "a STRING, b STRING")
    out = lenient_cast(df, {"a": T.IntegerType(), "b": T.DoubleType()}).collect()
    assert [(r.a, r.b) for r in out] == [(None, 12.0), (7, 3.5)]


def test_conform_lists_all_missing(spark):
    df = spark.createDataFrame([(1,)], "trip_id BIGINT")
    with pytest.raises(ValueError) as e:
        conform(df, schemas.SILVER_RIDES)
    assert "hvfhs_license_num" in str(e.value) and "driver_pay" in str(e.value)


def test_standardise_rides_schema(spark):
    out = standardise_rides(prepare(bronze_df(spark, [ride(extra_col=1)])))
    expected = [f for f in schemas.SILVER_RIDES.fields if f.name != "trip_id"]
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in expected]


def test_on_scene_fill(spark):
    out = fill_on_scene(bronze_df(spark, [ride(on_scene_datetime=None)])).first()
    assert out.on_scene_datetime == out.request_datetime


def test_duration_truncates_each_side_and_dates_follow_pickup(spark):
    start = dt.datetime(2024, 1, 6, 23, 59, 59)
    rows = [ride(pickup_datetime=dt.datetime(2024, 1, 6, 10, 0, 0), dropoff_datetime=dt.datetime(2024, 1, 6, 10, 10, 5, 700000)),
            ride(request_datetime=start, pickup_datetime=start, dropoff_datetime=start + dt.timedelta(minutes=3))]
    out = derive_trip_columns(standardise_rides(prepare(bronze_df(spark, rows)))).orderBy("start_time").collect()
    assert out[0].trip_duration_sec == 605
    assert (out[1].year, out[1].month, out[1].day, out[1].trip_duration_sec) == (2024, 1, 6, 180)


def test_trip_ids_are_a_function_of_the_month(spark):
    df = derive_trip_columns(standardise_rides(prepare(bronze_df(spark, [ride(tips=float(i), PULocationID=i + 1) for i in range(50)]))))
    month = F.lit("2024-01")
    key = ["pu_location_id", "trip_id"]
    first = sorted(map(tuple, add_trip_id(df, month=month).select(key).collect()))
    again = sorted(map(tuple, add_trip_id(df.repartition(7, "tips"), month=month).select(key).collect()))
    other = {r.trip_id for r in add_trip_id(df, month=F.lit("2024-02")).collect()}
    unknown = {r.trip_id for r in add_trip_id(df, month=F.lit("unknown")).collect()}
    ids = {i for _, i in first}
    assert first == again and len(ids) == 50 and not ids & other and not (ids | other) & unknown and min(ids) > 0


def test_quarantine_ids_never_meet_silver_ids(spark):
    rows = bronze_df(spark, [ride(tips=-1.0)] * 40).repartition(4)
    ids = [r.trip_id for r in add_quarantine_id(rows, F.lit("2024-01")).collect()]
    assert len(set(ids)) == 40 and min(ids) >= 1 << 62
