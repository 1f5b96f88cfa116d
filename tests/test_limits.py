from tripstar.operators.limits import preview


def test_preview_orders_and_stringifies(spark):
    df = spark.sql("SELECT id, TIMESTAMP_NTZ'2024-01-06 10:00:00' + make_interval(0,0,0,0,0,0,id) AS ts FROM range(100)")
    rows = preview(df, ["id"], 5).collect()
    assert [r.id for r in rows] == [0, 1, 2, 3, 4]
    assert rows[1].ts == "2024-01-06 10:00:01"
