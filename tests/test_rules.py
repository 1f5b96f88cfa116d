import datetime as dt

import pytest

from helpers import T0, bronze_df, ride
from tripstar.operators import rules as R
from tripstar.plans.silver import prepare

FAILING = [
    ("license_present", {"hvfhs_license_num": None}),
    ("request_present", {"request_datetime": None, "on_scene_datetime": None}),
    ("pickup_present", {"pickup_datetime": None}),
    ("dropoff_present", {"dropoff_datetime": None}),
    ("request_not_after_pickup", {"request_datetime": T0 + dt.timedelta(seconds=1)}),
    ("pickup_before_dropoff", {"dropoff_datetime": T0}),
    ("pickup_zone_in_range", {"PULocationID": 0}),
    ("dropoff_zone_in_range", {"DOLocationID": 266}),
    ("trip_time_positive", {"trip_time": 0}),
] + [(f"{c}_non_negative", {c: -0.01}) for c in (
    "trip_miles", "base_passenger_fare", "tolls", "bcf", "sales_tax",
    "congestion_surcharge", "airport_fee", "tips", "driver_pay")]

NULLABLE = ["PULocationID", "DOLocationID", "trip_time", "trip_miles", "base_passenger_fare", "tolls", "bcf",
            "sales_tax", "congestion_surcharge", "airport_fee", "tips", "driver_pay"]


def _split(spark, rows, on_null="quarantine"):
    df = prepare(bronze_df(spark, rows))
    valid, quarantine = R.split(df, on_null=on_null)
    return valid.collect(), quarantine.collect()


def test_eighteen_rules_each_alone(spark):
    assert len(FAILING) == 18
    rows = [ride(**{"tips": float(i), **over}) for i, (_, over) in enumerate(FAILING)]
    valid, quarantine = _split(spark, rows)
    assert valid == []
    got = {r["tips"] if r["tips"] >= 0 else -1: r["failed_rules"] for r in quarantine}
    for i, (name, over) in enumerate(FAILING):
        key = -1 if "tips" in over else float(i)
        reasons = got[key].split(",")
        assert reasons[0] == name, (name, reasons)
        assert all(x == name or x.endswith("_null") for x in reasons)
    assert {r["quarantine_reason"] for r in quarantine} == {R.QUARANTINE_REASON}


@pytest.mark.parametrize("col", NULLABLE)
def test_null_operand_modes(spark, col):
    rows = [ride(**{col: None})]
    valid, quarantine = _split(spark, rows, on_null="drop")
    assert valid == [] and quarantine == []  # unknown validity: in neither table
    valid, quarantine = _split(spark, rows, on_null="quarantine")
    assert valid == [] and len(quarantine) == 1
    assert quarantine[0]["failed_rules"].endswith("_null")
    unknown = R.unknown_rows(prepare(bronze_df(spark, rows))).count()
    assert unknown == 1


def test_null_fee_plus_negative_tip_is_quarantined_in_both_modes(spark):
    rows = [ride(airport_fee=None, tips=-1.0)]
    for mode in ("drop", "quarantine"):
        valid, quarantine = _split(spark, rows, on_null=mode)
        assert valid == [] and len(quarantine) == 1


def test_boundaries_and_nan(spark):
    rows = [
        ride(PULocationID=0, tips=1.0), ride(PULocationID=1, tips=2.0), ride(PULocationID=265, tips=3.0),
        ride(PULocationID=266, tips=4.0), ride(request_datetime=T0, tips=5.0), ride(trip_miles=0.0, tips=6.0),
        ride(base_passenger_fare=float("nan"), tips=7.0),
    ]
    valid, quarantine = _split(spark, rows)
    assert sorted(r["tips"] for r in valid) == [2.0, 3.0, 5.0, 6.0, 7.0]
    assert sorted(r["tips"] for r in quarantine) == [1.0, 4.0]


def test_reason_counts(spark):
    rows = [ride(tips=-1.0), ride(tips=-2.0, tolls=-1.0), ride(airport_fee=None)]
    q = R.quarantine_rows(prepare(bronze_df(spark, rows)))
    got = {r["rule"]: (r["reason_class"], r["n_rows"]) for r in R.reason_counts(q).collect()}
    assert got == {"tips_non_negative": ("amounts", 2), "tolls_non_negative": ("amounts", 1),
                   "airport_fee_non_negative_null": ("amounts", 1)}
    assert R.reason_class("pickup_zone_in_range_null") == "zone"
    assert R.reason_class("request_not_after_pickup") == "timestamps"


def test_valid_filter_reaches_parquet_scan(spark, tmp_dir):
    bronze_df(spark, [ride()]).write.parquet(f"{tmp_dir}/b")
    df = R.valid_rows(prepare(spark.read.parquet(f"{tmp_dir}/b")))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    for f in ("IsNotNull(hvfhs_license_num)", "GreaterThanOrEqual(PULocationID,1)",
              "LessThanOrEqual(DOLocationID,265)", "GreaterThan(trip_time,0)", "GreaterThanOrEqual(driver_pay,0.0)"):
        assert f in pushed
