"""URL filters: a temporal join of captures with dated list entries.

An entry (list, pattern, action, since) puts a host or a parent domain on a list, or takes it off, from
a moment on. Entries become validity intervals: an ``add`` holds from its moment until the next entry
of the same list and pattern, an interval without a later entry stays open, and of entries at the same
moment the removal counts. A capture is evaluated against the intervals that hold at its fetch time:
for its host and every parent domain, an as-of join finds the last interval that began at or before the
fetch time, and its end decides.

A popular pattern may hold a large share of all entries and captures, so nothing is ordered by pattern
alone: time is cut into buckets of ``BUCKET_SECONDS``. The next (or last) entry inside a bucket comes
from a window over (list, pattern, bucket); across buckets it comes from one row per non-empty bucket,
whose number is bounded by the calendar. The as-of join merges entries and captures in the same way, so
its work is linear in both. Captures are first reduced to distinct (host, fetch time).

Defined cases: a null or unparsable URL has no host and is never listed; a null fetch time matches no
interval; entries with a null list, pattern, action or moment are void, as are unknown actions; hosts
and patterns are compared in lower case without a final dot, user, port and leading ``www.``; repeated
rows get the same verdict each; empty tables give no rows or no listing; other columns pass through
unread, whatever their names, but for those named ``host``, ``lists``, ``pattern`` or ``blocked``, whose place the
verdict takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.llm.common import materialise

# An hour: a pattern with a third of all rows is spread over the hours of its log.
BUCKET_SECONDS = 3600
VERDICT_COLUMNS = ("host", "lists", "pattern", "blocked")


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user, port, final dot and leading ``www.``; null if none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(F.regexp_replace(host, r"\.+$", ""), r"^www\.", "")
    return F.when(host != "", host)


def parents_of(host: Column) -> Column:
    """The host and all its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))


def _bucket(moment: Column) -> Column:
    return F.floor(F.unix_micros(moment) / (BUCKET_SECONDS * 1_000_000))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) of each added entry, ``valid_to`` null while it is open.
    ``entries`` has list, pattern, action ('add' or 'remove') and since (timestamp)."""
    clean = (entries.select("list", F.regexp_replace(F.regexp_replace(F.lower("pattern"), r"\.+$", ""), r"^www\.", "").alias("pattern"), "since",
                            F.when(F.col("action") == "add", 1).when(F.col("action") == "remove", 0).alias("on"))
             .filter("list IS NOT NULL AND pattern <> '' AND since IS NOT NULL AND on IS NOT NULL")
             .groupBy("list", "pattern", "since").agg(F.min("on").alias("on")).withColumn("bucket", _bucket(F.col("since"))))
    inside = Window.partitionBy("list", "pattern", "bucket").orderBy("since")
    across = Window.partitionBy("list", "pattern").orderBy("bucket")
    later = (clean.groupBy("list", "pattern", "bucket").agg(F.min("since").alias("begin"))
             .withColumn("next_begin", F.lead("begin").over(across)).drop("begin"))
    return (clean.withColumn("next", F.lead("since").over(inside)).join(later, ["list", "pattern", "bucket"])
            .filter("on = 1").select("list", "pattern", F.col("since").alias("valid_from"), F.coalesce("next", "next_begin").alias("valid_to")))


def active_entries(moments: DataFrame, intervals: DataFrame) -> DataFrame:
    """As-of join: (host, fetched_at, list, pattern) for every interval of the host or a parent domain
    that holds at ``fetched_at``. ``moments`` has distinct (host, fetched_at)."""
    named = intervals.select("list", "pattern").distinct()
    asked = (moments.filter("host IS NOT NULL AND fetched_at IS NOT NULL")
             .withColumn("pattern", F.explode(parents_of(F.col("host")))).join(named, "pattern"))
    nothing = F.lit(None).cast("timestamp")
    merged = intervals.select("list", "pattern", F.col("valid_from").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"),
                              F.struct("valid_from", "valid_to").alias("span")).unionByName(
        asked.select("list", "pattern", F.col("fetched_at").alias("at"), F.lit(1).alias("kind"), "host",
                     F.when(F.lit(False), F.struct(nothing.alias("valid_from"), nothing.alias("valid_to"))).alias("span")))
    # read twice below
    merged = materialise(merged.withColumn("bucket", _bucket(F.col("at"))), "moments")
    before = Window.partitionBy("list", "pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (merged.groupBy("list", "pattern", "bucket").agg(F.max("span").alias("last"))
               .withColumn("carried", F.max("last").over(before)).drop("last"))
    inside = Window.partitionBy("list", "pattern", "bucket").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # spans are ordered by their beginning, so the greatest so far is the last that began
    found = merged.withColumn("own", F.max("span").over(inside)).filter("kind = 1").join(carried, ["list", "pattern", "bucket"])
    span = F.coalesce("own", "carried")
    return found.filter(span["valid_from"].isNotNull() & (span["valid_to"].isNull() | (F.col("at") < span["valid_to"]))).select(
        "host", F.col("at").alias("fetched_at"), "list", "pattern")


def filter_urls(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at",
                allow_lists: tuple[str, ...] = ("allow",)) -> DataFrame:
    """``captures`` with ``host``, ``lists`` (sorted names of the lists that hold an active entry),
    ``pattern`` (the most specific active pattern of a list that is no allow list) and ``blocked``:
    some such entry is active, and no allow-list entry is at least as specific. Columns of these four names in
    ``captures`` give way to them. Starts three jobs while it is called."""
    rows = captures.select(F.struct(*[F.col(f"`{c}`") for c in captures.columns]).alias("row"), host_of(F.col(f"`{url_col}`")).alias("host"),
                           F.col(f"`{time_col}`").alias("fetched_at"))
    # each step is written once, so its shuffle files go before the next one begins
    intervals = materialise(validity_intervals(entries), "intervals")
    active = materialise(active_entries(rows.select("host", "fetched_at").distinct(), intervals), "active")
    allowed = F.col("list").isin(*allow_lists)
    rank = F.struct(F.size(F.split("pattern", r"\.")).alias("labels"), "pattern")
    verdicts = active.groupBy("host", "fetched_at").agg(
        F.array_sort(F.collect_set("list")).alias("lists"), F.max(F.when(~allowed, rank)).alias("block"), F.max(F.when(allowed, rank)).alias("allow"))
    blocked = F.col("block").isNotNull() & (F.col("allow").isNull() | (F.col("allow.labels") < F.col("block.labels")))
    joined = rows.join(verdicts, ["host", "fetched_at"], "left")
    # the input's columns are unpacked only now, so none of their names can meet another
    own = [F.col(f"row.`{c}`").alias(c) for c in captures.columns if c.lower() not in VERDICT_COLUMNS]
    return joined.select(*own, "host", F.coalesce("lists", F.array().cast("array<string>")).alias("lists"), F.col("block.pattern").alias("pattern"),
                         F.coalesce(blocked, F.lit(False)).alias("blocked"))
