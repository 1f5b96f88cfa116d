import datetime as dt

from tripstar import schemas

T0 = dt.datetime(2024, 1, 6, 10, 0, 0)


def ride(**overrides):
    """A valid bronze ride row as a dict; override any column."""
    base = {
        "hvfhs_license_num": "HV0003", "dispatching_base_num": "B03", "originating_base_num": "B03",
        "request_datetime": T0 - dt.timedelta(minutes=5), "on_scene_datetime": T0 - dt.timedelta(minutes=2),
        "pickup_datetime": T0, "dropoff_datetime": T0 + dt.timedelta(minutes=10),
        "PULocationID": 100, "DOLocationID": 200, "trip_miles": 2.5, "trip_time": 600,
        "base_passenger_fare": 20.0, "tolls": 0.0, "bcf": 0.5, "sales_tax": 1.5, "congestion_surcharge": 2.75,
        "airport_fee": 0.0, "tips": 3.0, "driver_pay": 15.0, "shared_request_flag": "N",
        "shared_match_flag": "N", "access_a_ride_flag": " ", "wav_request_flag": "N", "wav_match_flag": "N",
    }
    base.update(overrides)
    return base


def bronze_df(spark, rows):
    cols = [f.name for f in schemas.BRONZE_RIDES.fields]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schemas.BRONZE_RIDES)
