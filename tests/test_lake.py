"""Publishing all or nothing, and silver that does not depend on which files hold a ride or when they are loaded."""

import datetime as dt
import os
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from helpers import bronze_df, ride
from tripstar import registry, schemas
from tripstar.paths import LakePaths
from tripstar.plans import ownership
from tripstar.plans.lake import FREE_SHUFFLES, Commit, ConcurrentCommit, load_manifest, manifest_numbers, vacuum
from tripstar.plans.pipeline import build_reference, run_bronze_to_silver, run_pipeline
from tripstar.plans.publish import read_table, sync_catalog, sync_statements, write_table
from tripstar.registry import Inputs
from tripstar.sources.files import read_bronze


def _ride(day, **over):
    t = dt.datetime(2024, 1, 1, 9) + dt.timedelta(days=day - 1)
    return ride(request_datetime=t - dt.timedelta(hours=1), pickup_datetime=t, dropoff_datetime=t + dt.timedelta(hours=1), **over)


def _feed(spark, months):
    out = None
    for m, rows in months.items():
        df = bronze_df(spark, rows).withColumn("source_month", F.lit(m))
        out = df if out is None else out.unionByName(df)
    return out


def _silver(spark, paths):
    rows = read_table(spark, paths.silver_rides).select("source_month", "day", "month", "pu_location_id", "tips", "trip_id").collect()
    return sorted(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def reference(spark, tmp_path_factory):
    paths = LakePaths(str(tmp_path_factory.mktemp("reference")))
    inp = Inputs(spark, SF_SMALL)
    build_reference(spark, paths, inp.lookup, inp.geometry)
    return paths.zone_reference


class Lake(LakePaths):
    reference = ""

    @property
    def zone_reference(self):
        return self.reference


@pytest.fixture()
def lake(reference, tmp_dir):
    Lake.reference = reference
    return Lake(tmp_dir)


# A ride of 31 January in three files, of 1 February in two, and a second row of one of them in the later file.
CROSS = {
    "2024-01": [_ride(5), _ride(5, tips=9.0), _ride(31, tips=2.0)],
    "2024-02": [_ride(31, tips=1.0), _ride(32, tips=5.0), _ride(40)],
    "2024-03": [_ride(31, tips=0.5), _ride(32, tips=4.0), _ride(32, tips=3.0), _ride(70)],
}
WANT = [("2024-01", 5, 1, 100, 3.0), ("2024-01", 31, 1, 100, 2.0), ("2024-02", 1, 2, 100, 5.0), ("2024-02", 9, 2, 100, 3.0), ("2024-03", 10, 3, 100, 3.0)]


def test_rides_in_several_files_in_any_order_of_loading(spark, tmp_dir):
    feed = _feed(spark, CROSS)
    states = []
    for i, order in enumerate([None, *permutations(CROSS)]):
        paths = LakePaths(f"{tmp_dir}/{i}")
        for months in ([None] if order is None else [[m] for m in order]):
            counts = run_bronze_to_silver(spark, paths, feed, months=months)
        states.append((_silver(spark, paths), sorted(map(str, read_table(spark, f"{paths.root}/{ownership.SHADOWED}").collect()))))
        if order is None:
            assert (counts["bronze_rows"], counts["valid_rows"], counts["silver_rows"]) == (10, 10, 5)
    assert [r[:5] for r in states[0][0]] == WANT
    assert all(s == states[0] for s in states)


def test_a_key_comes_back_when_its_owner_loses_it(spark, lake):
    feed = _feed(spark, CROSS)
    for m in CROSS:
        run_pipeline(spark, lake, feed, months=[m])
    ids = {r[0:3]: r[5] for r in _silver(spark, lake)}
    without = {**CROSS, "2024-01": CROSS["2024-01"][:2]}
    counts = run_pipeline(spark, lake, _feed(spark, without), months=["2024-01"]).counts
    assert counts["silver_rows"] == 1 and counts["fact_rides"] == 5
    got = _silver(spark, lake)
    assert [r[:5] for r in got] == [WANT[0], ("2024-02", 1, 2, 100, 5.0), ("2024-02", 9, 2, 100, 3.0), ("2024-02", 31, 1, 100, 1.0), WANT[4]]
    fact = read_table(spark, lake.gold("fact_rides"))
    assert sorted((r.date_key, r.trip_id) for r in fact.collect()) == sorted((20240000 + r[2] * 100 + r[1], r[5]) for r in got)
    # and goes again, with the ids of before
    run_pipeline(spark, lake, feed, months=["2024-01"])
    assert {r[0:3]: r[5] for r in _silver(spark, lake)} == ids and [r[:5] for r in _silver(spark, lake)] == WANT
    daily = {r.date_key: r.rides for r in read_table(spark, lake.gold("agg_trips_daily")).collect()}
    assert daily == {20240105: 1, 20240131: 1, 20240201: 1, 20240209: 1, 20240310: 1}


def test_a_month_whose_rides_are_all_elsewhere(spark, tmp_dir):
    feed = {"2024-01": [_ride(5), _ride(6)], "2024-02": [_ride(5), _ride(6)]}
    paths = LakePaths(tmp_dir)
    for m in ("2024-02", "2024-01"):
        run_bronze_to_silver(spark, paths, _feed(spark, feed), months=[m])
    assert [r[0] for r in _silver(spark, paths)] == ["2024-01"] * 2
    run_bronze_to_silver(spark, paths, _feed(spark, {"2024-01": [_ride(7)], "2024-02": feed["2024-02"]}), months=["2024-01"])
    assert [r[:2] for r in _silver(spark, paths)] == [("2024-01", 7), ("2024-02", 5), ("2024-02", 6)]
    run_bronze_to_silver(spark, paths, _feed(spark, {"2024-01": []} | {"2024-02": []}), months=["2024-01", "2024-02"])
    assert _silver(spark, paths) == []


def test_no_job_looks_for_shared_keys_without_shared_days(spark, tmp_dir, monkeypatch):
    feed = _feed(spark, {"2024-01": [_ride(5)], "2024-02": [_ride(40)]})
    monkeypatch.setattr(Commit, "scratch", lambda *a: pytest.fail("keys were compared"))
    for m in ("2024-01", "2024-02"):
        run_bronze_to_silver(spark, LakePaths(tmp_dir), feed, months=[m])


# --------------------------------------------------------------------------- all or nothing

def _state(spark, paths):
    tables = load_manifest(spark, paths.root)["tables"]
    return {t: sorted(map(str, read_table(spark, f"{paths.root}/{t}").collect())) for t in tables}


def test_a_broken_run_leaves_every_table_as_it_was(spark, lake, monkeypatch):
    feed = _feed(spark, CROSS)
    run_pipeline(spark, lake, feed, database="lake_broken")
    before, catalog = _state(spark, lake), sorted(map(str, spark.table("lake_broken.fact_rides").collect()))
    # a frame that fails while it is written
    fails = feed.withColumn("tips", F.when(F.col("tips") == 4.0, F.raise_error(F.lit("broken file")).cast("double")).otherwise(F.col("tips")))
    with pytest.raises(Exception, match="broken file"):
        run_pipeline(spark, lake, fails, database="lake_broken", months=["2024-03"])
    assert _state(spark, lake) == before
    # a run that ends between the tables, at each of its writes
    changed = _feed(spark, {**CROSS, "2024-02": [_ride(41)]})
    write, n = Commit.write, 0
    while True:
        left = n

        def stopping(self, *a, **k):
            nonlocal left
            if not left:
                raise KeyboardInterrupt
            left -= 1
            return write(self, *a, **k)

        monkeypatch.setattr(Commit, "write", stopping)
        try:
            run_pipeline(spark, lake, changed, database="lake_broken", months=["2024-02"])
            break
        except KeyboardInterrupt:
            assert _state(spark, lake) == before
            assert sorted(map(str, spark.table("lake_broken.fact_rides").collect())) == catalog
        n += 4
    assert n >= 8 and _state(spark, lake) != before
    assert spark.table("lake_broken.fact_rides").count() == read_table(spark, lake.gold("fact_rides")).count() == 5


def test_of_two_runs_from_one_version_one_fails(spark, tmp_dir):
    one, two = Commit(spark, tmp_dir), Commit(spark, tmp_dir)
    one.write("t", spark.range(3), observe={"n": F.count(F.lit(1))})
    two.write("t", spark.range(4))
    assert one.publish() == 1
    with pytest.raises(ConcurrentCommit):
        two.publish()
    assert read_table(spark, f"{tmp_dir}/t").count() == 3


def test_vacuum_keeps_what_the_last_versions_use(spark, tmp_dir):
    for i in range(4):
        c = Commit(spark, tmp_dir)
        rows = spark.range(i + 1).withColumn("p", F.col("id") % 2)
        c.write("t", rows.filter("p = 0") if i % 2 else rows, ("p",), ["p=0"] if i % 2 else ["p=1", "p=0"])
        if i == 0:
            c.write("only/once", spark.range(1))
        c.publish()
    old = read_table(spark, f"{tmp_dir}/t")
    writing = Commit(spark, tmp_dir)
    writing.write("t", spark.range(9).withColumn("p", F.lit(0).cast("long")), ("p",), ["p=0"])
    assert len(vacuum(spark, tmp_dir, keep=2)) == 2 and manifest_numbers(spark, tmp_dir) == [3, 4]
    assert old.count() == read_table(spark, f"{tmp_dir}/t").count() == 3
    assert read_table(spark, f"{tmp_dir}/only/once").count() == 1
    writing.publish()
    assert read_table(spark, f"{tmp_dir}/t").count() == 9 + 1


def test_tables_of_a_commit(spark, tmp_dir):
    c = Commit(spark, tmp_dir)
    rows = spark.range(10).withColumn("p", F.when(F.col("id") < 8, (F.col("id") % 3).cast("string")))
    assert c.write("t", rows, ("p",), observe={"n": F.count(F.lit(1)), "big": F.count_if(F.col("id") > 6)}, keep=F.col("id") != 9) == {"n": 10, "big": 3}
    assert c.read("t").count() == 9 and c.read("t", ["p=1"]).count() == 3 and c.read("t", ["p=7"]).count() == 0
    assert c.read("t", ["p=__HIVE_DEFAULT_PARTITION__"]).collect() == [(8, None)]
    # a column that comes later; rows for a partition that is not replaced; another layout; another type
    c.write("t", spark.sql("SELECT 20L AS id, 1.5D AS later, '0' AS p"), ("p",), ["p=0", "p=2"])
    assert sorted(c.read("t").collect(), key=str) == sorted([(1, None, "1"), (4, None, "1"), (7, None, "1"), (8, None, None), (20, 1.5, "0")], key=str)
    for frame, by, why in ((spark.sql("SELECT 1L AS id, '1' AS p"), ("p",), "not replaced"), (rows, (), "is partitioned by"),
                           (spark.sql("SELECT 'x' AS id, '0' AS p"), ("p",), "column id was")):
        with pytest.raises(ValueError, match=why):
            c.write("t", frame, by, ["p=0"])
    assert c.write("none", rows.filter("false"), ("p",), observe={"n": F.count(F.lit(1))}) == {"n": 0}
    assert c.read("none").columns == ["id", "p"] and c.read("none").count() == 0
    c.publish()
    assert [f.dataType.simpleString() for f in read_table(spark, f"{tmp_dir}/t").schema] == ["bigint", "double", "string"]


# --------------------------------------------------------------------------- quarantine history, counts, catalog

def test_a_run_id_again_replaces_its_rows(spark, tmp_dir):
    paths = LakePaths(tmp_dir)
    feed = _feed(spark, {"2024-01": [ride(tips=-1.0)], "2024-02": [ride(tips=-1.0), ride(tolls=-1.0)]})
    for m, run in (("2024-01", "a"), ("2024-02", "b"), ("2024-02", "b"), ("2024-02", "c")):
        run_bronze_to_silver(spark, paths, feed, months=[m], quarantine_mode="append", run_id=run)
    rows = read_table(spark, paths.quarantine_rides).groupBy("run_id").count().collect()
    assert sorted(map(tuple, rows)) == [("a", 1), ("b", 2), ("c", 2)]
    assert {k: v["counts"]["quarantine_rows"] for k, v in load_manifest(spark, tmp_dir)["runs"].items()} == {"a": 1, "b": 2, "c": 2}
    # runs without a name have one of their own; a mode for each table
    run_bronze_to_silver(spark, paths, feed, months=["2024-01"], quarantine_mode="append")
    assert read_table(spark, paths.quarantine_rides).select("run_id").distinct().count() == 4
    with pytest.raises(ValueError, match="run_id"):
        run_bronze_to_silver(spark, paths, feed, quarantine_mode="append", run_id="a/b")
    with pytest.raises(ValueError, match="partitioned by"):
        run_bronze_to_silver(spark, paths, feed, months=["2024-01"])


def test_counts_are_those_of_the_writing_tasks(spark, tmp_dir):
    rows = [_ride(3), _ride(3), _ride(4), _ride(5, tips=-1.0), _ride(6, tips=None), _ride(7, tips=None, tolls=-1.0)]
    _feed(spark, {"2024-01": rows}).write.partitionBy("source_month").parquet(f"{tmp_dir}/bronze/rides")
    bronze = spark.read.schema(T.StructType([*schemas.BRONZE_RIDES, T.StructField("source_month", T.StringType())])).parquet(f"{tmp_dir}/bronze/rides")
    want = {"bronze_rows": 6, "valid_rows": 3, "silver_rows": 2, "failed_rows": 2, "unknown_rows": 1}
    tracker = spark.sparkContext.statusTracker()
    for on_null, lost in (("quarantine", 0), ("drop", 1)):
        spark.sparkContext.setJobGroup(f"counts-{on_null}", on_null)
        counts = run_bronze_to_silver(spark, LakePaths(f"{tmp_dir}/{on_null}"), bronze, on_null=on_null)
        jobs = tracker.getJobIdsForGroup(f"counts-{on_null}")
        spark.sparkContext.setJobGroup("", "")
        assert counts == {**want, "quarantine_rows": 3 - lost}
        assert read_table(spark, f"{tmp_dir}/{on_null}/quarantine/rides").count() == 3 - lost
        # silver (its stages, a sample of the ranges), its days, quarantine; no job counts an output or scans bronze again
        assert len(jobs) <= 8, len(jobs)
    empty = run_bronze_to_silver(spark, LakePaths(f"{tmp_dir}/empty"), bronze.filter("false"))
    assert set(empty.values()) == {0}


def test_silver_write_has_two_exchanges(spark, tmp_dir):
    """The dedupe's, and one that the numbering shares with the layout of the files."""
    import re

    from tripstar.operators import rules as R
    from tripstar.plans.silver import month_rides, prepare

    bronze = _feed(spark, CROSS)
    plan = month_rides(R.valid_rows(prepare(bronze)), "n")._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange (\w+)", plan) == ["rangepartitioning", "hashpartitioning"]


def test_catalog_is_told_what_changed_only(spark, lake):
    months = {"2024-01": [_ride(d) for d in range(1, 20)], "2024-02": [_ride(d) for d in range(32, 50)]}
    run_pipeline(spark, lake, _feed(spark, months), database="lake_delta")
    assert sync_catalog(spark, "lake_delta", lake.root)["gold/fact_rides"] == 0
    months["2024-02"] = [_ride(d) for d in range(33, 40)]
    run_pipeline(spark, lake, _feed(spark, months), months=["2024-02"])
    now, before = load_manifest(spark, lake.root)["tables"]["gold/fact_rides"], load_manifest(spark, lake.root, 1)["tables"]["gold/fact_rides"]
    statements = sync_statements(lake.root, "gold/fact_rides", "t", now, before)
    assert not any("'1'" in s.split("LOCATION")[0].split("`day`")[0].split("`month`")[1] for s in statements)  # no word on January
    assert sum(s.count("SET LOCATION") for s in statements) == 7 and statements[0].count("PARTITION (") == 11
    assert sync_catalog(spark, "lake_delta", lake.root)["gold/fact_rides"] == len(statements)
    shown = spark.table("lake_delta.fact_rides")
    assert sorted(map(str, shown.collect())) == sorted(map(str, read_table(spark, lake.gold("fact_rides")).select(*shown.columns).collect()))
    # after the manifest that it was synced with has gone, the catalog's own list is compared
    months["2024-01"] = [_ride(d) for d in range(2, 4)]
    run_pipeline(spark, lake, _feed(spark, months), months=["2024-01"])
    run_pipeline(spark, lake, _feed(spark, months), months=["2024-01"], keep_versions=1)
    sync_catalog(spark, "lake_delta", lake.root)
    assert spark.table("lake_delta.fact_rides").count() == 9 == spark.table("lake_delta.agg_trips_daily").count()
    assert not os.path.exists(f"{lake.root}/_manifest/00000001.json")


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f"{d}/{f}" for top in dirs for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def test_writes_leave_no_shuffle_files(spark, tmp_dir):
    paths, before, set_before = LakePaths(tmp_dir), _shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, None)
    commit = Commit(spark, paths.root)
    rows = spark.range(1000).selectExpr("id % 3 AS part", "id")
    commit.write("t", rows, ("part",))
    commit.scratch("s", rows.repartition(5, "id"))
    write_table(rows, f"{tmp_dir}/plain", ("part",))
    assert not [f for f in _shuffle_files(spark) - before if f.endswith(".data")] and spark.conf.get(FREE_SHUFFLES, None) == set_before
    assert commit.read("t").count() == spark.read.parquet(f"{tmp_dir}/plain").count() == 1000


@pytest.mark.parametrize("at_once", [1, 2])
def test_months_written_a_few_at_a_time_give_the_same_lake(spark, tmp_dir, monkeypatch, at_once):
    feed, states, written = _feed(spark, CROSS), [], []
    write = Commit.write
    monkeypatch.setattr(Commit, "write", lambda self, table, df, *a, **b: (written.append(table), write(self, table, df, *a, **b))[1])
    for n in (8, at_once):
        monkeypatch.setattr(ownership, "MONTHS_AT_ONCE", n)
        paths, n_before = LakePaths(f"{tmp_dir}/{n}"), len(written)
        counts = run_bronze_to_silver(spark, paths, feed, months=list(CROSS))
        states.append((counts, _silver(spark, paths), sorted(map(str, read_table(spark, f"{paths.root}/{ownership.SHADOWED}").collect()))))
    assert states[0] == states[1] and [r[:5] for r in states[0][1]] == WANT
    assert len(written) - n_before > n_before  # silver, silver again and shadowed rows by parts of the months, then quarantine
    monkeypatch.setattr(ownership, "MONTHS_AT_ONCE", 8)
    assert [[len(b) for b in ownership.batches(range(n))] for n in (0, 8, 9, 28)] == [[0], [8], [4, 5], [7, 7, 7, 7]]


def test_files_of_a_lake_are_compressed_and_in_the_order_of_time(spark, tmp_dir):
    import pyarrow.parquet as pq

    paths = LakePaths(tmp_dir)
    run_bronze_to_silver(spark, paths, _feed(spark, {"2024-01": [_ride(d) for d in (9, 3, 20, 1, 14, 7, 28, 2)]}), months=["2024-01"])
    names = [f"{d}/{n}" for d, _, files in os.walk(f"{tmp_dir}/silver") for n in files if n.endswith(".parquet")]
    assert names and all(pq.ParquetFile(n).metadata.row_group(0).column(0).compression == "ZSTD" for n in names)
    for n in names:
        times = pq.ParquetFile(n).read(columns=["start_time"]).column(0).to_pylist()
        assert times == sorted(times)


def test_a_lake_is_loaded_from_tables_without_a_stored_feed(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(registry, "_once", lambda spark, sf_dir, what, write, once=registry._once: (stored.append(what), once(spark, sf_dir, what, write))[1])
    monkeypatch.setattr(registry, "_written", {})
    rides = read_bronze(spark, registry._landed(spark, SF_SMALL))
    assert stored == ["bronze_eras"]
    columns = [f.name for f in registry.FEED]
    want, got = registry.feed(spark, SF_SMALL).select(columns), rides.withColumn("source_month", F.col("source_month").cast("string")).select(columns)
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty() and registry.derived_feed(spark, SF_SMALL).dtypes == want.dtypes


def _stored(spark, root):
    """Partitions on disk and in the manifest, by table and version."""
    tables = load_manifest(spark, root)["tables"]
    live = {f"{t}/version={tag}/{p}" for t, e in tables.items() if t.startswith(("silver", "quarantine")) for p, tag in e["partitions"].items()}
    disk = {os.path.relpath(d, root) for top in ("silver", "quarantine") for d, _, names in os.walk(f"{root}/{top}") if any(n.endswith(".parquet") for n in names)}
    return disk, live


def test_a_run_leaves_no_directories_that_it_replaced_itself(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(ownership, "MONTHS_AT_ONCE", 2)
    paths, feed = LakePaths(tmp_dir), _feed(spark, CROSS)
    run_bronze_to_silver(spark, paths, feed, months=["2024-02", "2024-03"])  # rides change hands: both months are written twice
    disk, live = _stored(spark, tmp_dir)
    assert disk == live
    run_bronze_to_silver(spark, paths, feed, months=["2024-01"])
    before, (disk, now) = live, _stored(spark, tmp_dir)
    assert disk == before | now and before - now  # what was published before stays for its readers
    assert [r[:5] for r in _silver(spark, paths)] == WANT


def test_cross_file_dedupe_stores_no_feed_and_one_version(spark, monkeypatch):
    stored = {}
    monkeypatch.setattr(registry, "_once", lambda spark, sf_dir, what, write, once=registry._once: stored.setdefault(what, once(spark, sf_dir, what, write)))
    monkeypatch.setattr(registry, "_written", {})
    assert registry.q_cross_file_dedupe(spark, SF_SMALL).count() > 0 and list(stored) == ["cross_file"]
    disk, live = _stored(spark, stored["cross_file"].removeprefix("file:"))
    assert disk == live and len(live) > 100


def test_silver_with_coordinates_is_written_without_a_shuffle(spark, lake, monkeypatch):
    sc = spark.sparkContext._jsc.sc()
    days = {"2024-01": [_ride(d, PULocationID=d, DOLocationID=57) for d in range(1, 20)], "2024-02": [_ride(d, PULocationID=266 - d) for d in range(32, 50)]}
    assert run_bronze_to_silver(spark, lake, _feed(spark, days), months=list(days), enrich_geo=True)["silver_geo_rows"] == 37
    monkeypatch.setattr(registry, "_lake", lambda spark, sf_dir: (lake, "none"))
    monkeypatch.setattr(registry, "_written", {})
    before = sc.newShuffleId()
    got = registry.q_silver_geo_rides(spark, lake.root).collect()
    assert sc.newShuffleId() - before == 1
    want = registry.round_geo(read_table(spark, lake.silver_rides_geo)).select(*got[0].__fields__).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 37
    assert any(r.start_geo_hash for r in got) and all(r.end_geo_hash is None for r in got if r.do_location_id == 57)  # which has no geometry
