import datetime as dt
import random

import duckdb

from tripstar.llm import url_lists as U
from tripstar.llm.oracles import ORACLE_SQL
from tripstar.llm.registry import QUERIES

SF = "/root/testdata/sf0.01"


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("pages", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE_SQL["op3_url_lists"]).df()
    got = QUERIES["op3_url_lists"](spark, SF).toPandas()
    key = sorted(want.columns)
    assert sorted(map(tuple, got[key].astype(str).values)) == sorted(map(tuple, want[key].astype(str).values))
    assert got.blocked.any() and not got.blocked.all()
    # the captures lie over the whole log of entries
    first, last = con.execute("SELECT min(ts), max(ts) FROM events").fetchall()[0]
    days = got.fetched_at.dropna().str[:10]
    assert days.min() <= str(first + dt.timedelta(days=1))[:10] and days.max() >= str(last)[:10]


def test_what_is_carried_into_an_hour_decides(spark, monkeypatch):
    """Without the intervals that began in earlier buckets most verdicts of the query would be others."""
    rows = QUERIES["op3_url_lists"](spark, SF).select("page_id", "fetched_at", "lists", "pattern", "blocked")
    right = {tuple(r) for r in rows.collect()}
    plain = U.F.coalesce
    monkeypatch.setattr(U.F, "coalesce", lambda *c: plain(c[0]) if isinstance(c[0], str) and c[0] == "own" else plain(*c))
    without = {tuple(r) for r in QUERIES["op3_url_lists"](spark, SF).select("page_id", "fetched_at", "lists", "pattern", "blocked").collect()}
    assert len(right - without) > len(right) / 20


def test_clashing_names(spark):
    t0 = dt.datetime(2024, 1, 1)
    e = spark.createDataFrame([("block", "x.org", "add", t0)], "list string, pattern string, action string, since timestamp")
    c = spark.createDataFrame([(1, "http://a.x.org/", t0, "p", True, ["q"], "h", 5, 6, 7, 8, 9, "r", "s")],
                              "id long, url string, fetched_at timestamp, pattern string, blocked boolean, lists array<string>, HOST string, "
                              "__at int, __host int, row int, block int, allow int, `a.b` string, list string")
    got = U.filter_urls(c, e)
    assert got.columns == ["id", "url", "fetched_at", "__at", "__host", "row", "block", "allow", "a.b", "list", "host", "lists", "pattern", "blocked"]
    assert tuple(got.first()) == (1, "http://a.x.org/", t0, 5, 6, 7, 8, 9, "r", "s", "a.x.org", ["block"], "x.org", True)
    at = U.filter_urls(c.selectExpr("url AS host", "fetched_at AS lists"), e, "host", "lists")
    assert at.columns == ["host", "lists", "pattern", "blocked"] and at.first().blocked


def test_one_hot_pattern_is_spread_over_buckets(spark):
    t0 = dt.datetime(2024, 1, 1)
    e = spark.createDataFrame([("block", "x.org", ["add", "remove"][i % 2], t0 + dt.timedelta(minutes=17 * i)) for i in range(900)],
                              "list string, pattern string, action string, since timestamp")
    spans = U.validity_intervals(e).collect()
    assert len(spans) == 450 and all(r.valid_to - r.valid_from == dt.timedelta(minutes=17) for r in spans)
    largest = e.groupBy(U._bucket(e.since)).count().agg({"count": "max"}).first()[0]
    assert largest <= 4


def test_as_of_join_against_brute_force(spark):
    rng = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    hosts = ["a.x.org", "x.org", "b.x.org", "y.com"]
    entries = [(rng.choice(["block", "allow"]), rng.choice(hosts), rng.choice(["add", "remove"]), t0 + dt.timedelta(hours=rng.randrange(200))) for _ in range(60)]
    captures = [(i, f"https://user@{rng.choice(hosts)}:80/p?q", t0 + dt.timedelta(hours=rng.randrange(220))) for i in range(80)]
    odd = [(100, None, t0), (101, "not a url", t0), (102, "http://x.org/", None), (102, "http://x.org/", None)]
    void = [(None, "x.org", "add", t0), ("block", None, "add", t0), ("block", "x.org", None, t0), ("block", "x.org", "add", None), ("block", "x.org", "mend", t0)]
    e = spark.createDataFrame(entries + void, "list string, pattern string, action string, since timestamp")
    c = spark.createDataFrame(captures + odd, "id long, url string, fetched_at timestamp").selectExpr("*", "'k' AS list", "1 AS kind")
    got = U.filter_urls(c, e).collect()
    assert len(got) == len(captures) + len(odd)
    for r in got:
        if r.id >= 100:
            assert (r.lists, r.pattern, r.blocked) == ([], None, False)
            continue
        labels = r.host.split(".")
        active = []
        for k in range(len(labels)):
            p = ".".join(labels[k:])
            for name in ("block", "allow"):
                past = [(s, a == "add") for x, q, a, s in entries if (x, q) == (name, p) and s <= r.fetched_at]
                if past and min(a for s, a in past if s == max(past)[0]):
                    active.append((name, p))
        block = [p for n, p in active if n == "block"]
        allow = [p for n, p in active if n == "allow"]
        rank = lambda p: (p.count("."), p)
        assert r.lists == sorted({n for n, _ in active}) and r.pattern == max(block, key=rank, default=None)
        assert r.blocked == (bool(block) and max((p.count(".") for p in allow), default=-1) < max(p.count(".") for p in block))
    assert U.filter_urls(c, e.limit(0)).filter("blocked").count() == 0 and U.filter_urls(c.limit(0), e).count() == 0
