import datetime as dt

from helpers import bronze_df, ride
from tripstar import schemas
from tripstar.streaming.landing import land_new_files


def test_each_file_lands_once(spark, tmp_dir):
    landing, bronze, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    bronze_df(spark, [ride(tips=1.0), ride(tips=2.0)]).coalesce(1).write.parquet(f"{landing}/2024-01")
    assert land_new_files(spark, f"{landing}/*", bronze, ckpt, schemas.BRONZE_RIDES) == 2
    assert land_new_files(spark, f"{landing}/*", bronze, ckpt, schemas.BRONZE_RIDES) == 0  # nothing new
    t = dt.datetime(2024, 2, 1, 9)
    bronze_df(spark, [ride(pickup_datetime=t, request_datetime=t, tips=3.0)]).coalesce(1).write.parquet(f"{landing}/2024-02")
    assert land_new_files(spark, f"{landing}/*", bronze, ckpt, schemas.BRONZE_RIDES) == 1
    out = spark.read.parquet(bronze)
    assert sorted(r.tips for r in out.collect()) == [1.0, 2.0, 3.0]
    assert out.select("source_file").distinct().count() == 2


def test_many_small_batches_are_all_counted(spark, tmp_dir):
    landing, bronze, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    for i in range(5):
        bronze_df(spark, [ride(tips=float(i))] * 3).coalesce(1).write.parquet(f"{landing}/f{i}")
    n = land_new_files(spark, f"{landing}/*", bronze, ckpt, schemas.BRONZE_RIDES, max_files_per_trigger=1)
    assert n == 15 and spark.read.parquet(bronze).count() == 15


def test_counts_over_runs_read_only_what_is_new(spark, tmp_dir):
    """Three runs of several batches each, across the sink's rewriting of its log (every tenth batch): a run counts its
    own files, and opens no others."""
    from tripstar.streaming.landing import files_since, sink_batches

    landing, bronze, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    total, n_file = 0, 0
    for rows, files in ((1, 4), (2, 7), (3, 3), (1, 12)):
        before = max(sink_batches(spark, bronze), default=-1)
        for _ in range(files):
            bronze_df(spark, [ride(tips=float(n_file))] * rows).coalesce(1).write.parquet(f"{landing}/f{n_file}")
            n_file += 1
        assert land_new_files(spark, f"{landing}/*", bronze, ckpt, schemas.BRONZE_RIDES, max_files_per_trigger=1) == rows * files
        new = files_since(spark, bronze, before)
        assert len(new) == files and spark.read.parquet(*new).count() == rows * files
        total += rows * files
    assert any(n.endswith(".compact") for n in sink_batches(spark, bronze).values())
    assert spark.read.parquet(bronze).count() == total
