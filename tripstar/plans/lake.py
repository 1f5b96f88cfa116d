"""Tables of a lake that are published together, all or nothing.

Every table of a lake is a set of partitions, and every partition one directory below a *version* of the
table (``<table>/version=<tag>/<partition>``). A commit writes new directories only. What the tables hold is
said by one small file, the manifest ``_manifest/<number>.json``: the live directory of every partition, the
schemas and some notes. A commit is published by renaming its manifest into place, so readers
see all of its tables or none, a run that breaks off changes nothing, and of two runs that started from the same
version one fails instead of mixing with the other. Superseded directories are removed by :func:`vacuum`, which
leaves the last versions to readers that have already planned.

The manifest grows with the number of partitions (months, days), never with rows.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from copy import deepcopy

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

MANIFEST = "_manifest"
VERSION = "version"
# Fixed value: the compression of written tables, a fifth smaller than Spark's default.
CODEC = "zstd"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class ConcurrentCommit(RuntimeError):
    """Another run has published since this one started; run again."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go as each execution ends. Else they stay until the driver happens to
    collect its garbage, and a chain of writes holds the shuffles of all of them on disk."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if not n.startswith("."))


def _partitions_below(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition directories that a write has made, relative to ``path``."""
    found = [""]
    for _ in range(depth):
        found = [f"{d}/{n}" if d else n for d in found for n in _names(spark, f"{path}/{d}") if "=" in n]
    return found


def manifest_numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _names(spark, f"{root}/{MANIFEST}") if re.fullmatch(r"\d+\.json", n))


def load_manifest(spark: SparkSession, root: str, number: int | None = None, missing_ok: bool = False) -> dict | None:
    """The published manifest of this number, by default the last one; an empty one if there is none.
    With ``missing_ok`` None for a number whose manifest is gone."""
    if number is None:
        numbers = manifest_numbers(spark, root)
        if not numbers:
            return {"number": 0, "tables": {}, "notes": {}, "runs": {}}
        number = numbers[-1]
    fs, p = _fs(spark, f"{root}/{MANIFEST}/{number:08d}.json")
    if missing_ok and not fs.exists(p):
        return None
    return json.loads(read_text(spark, f"{root}/{MANIFEST}/{number:08d}.json"))


def _folder(tag: str, partitioned: bool) -> str:
    """The directory of a version: of a partitioned table itself like a partition, so that Spark reads several versions
    below one base path."""
    return f"{VERSION}={tag}" if partitioned else f"{VERSION}-{tag}"


def location(root: str, table: str, entry: dict, partition: str = "") -> str:
    folder = _folder(entry["partitions"][partition], bool(entry["partitioned_by"]))
    return "/".join(x for x in (root, table, folder, partition) if x)


def read_entry(spark: SparkSession, root: str, table: str, entry: dict, under: Iterable[str] | None = None) -> DataFrame:
    """The rows of a table; with ``under`` of the partitions at or below these directories alone."""
    schema = T.StructType.fromJson(entry["schema"])
    live = entry["partitions"]
    if under is not None:
        live = {p: tag for p, tag in live.items() if _is_under(p, set(under))}
    if not live:
        return spark.createDataFrame([], schema)
    if not entry["partitioned_by"]:
        return spark.read.schema(schema).parquet(location(root, table, entry))
    # a version that is live as a whole is read by its one directory
    by_tag: dict[str, list[str]] = {}
    for p, tag in sorted(live.items()):
        by_tag.setdefault(tag, []).append(p)
    places = [place for tag, parts in by_tag.items() for place in (
        [f"{root}/{table}/{VERSION}={tag}"] if entry["written"].get(tag) == len(parts)
        else [f"{root}/{table}/{VERSION}={tag}/{p}" for p in parts])]
    rows = spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*places)
    return rows.select(*[f"`{f.name}`" for f in schema])


def _is_under(partition: str, prefixes: set[str]) -> bool:
    steps = partition.split("/")
    return any("/".join(steps[:i]) in prefixes for i in range(1, len(steps) + 1))


class Commit:
    """Writes of one run. Nothing is visible to readers before :meth:`publish`; :meth:`read` sees the writes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.before = load_manifest(spark, self.root)
        self.now = deepcopy(self.before)
        self.now["number"] = self.before["number"] + 1
        self.name = f"{self.now['number']:08d}-{uuid.uuid4().hex[:8]}"
        self._writes = 0
        self._own: dict[str, tuple[str, str, list[str]]] = {}  # table, tag and partitions of the directories of this run

    def entry(self, table: str) -> dict | None:
        return self.now["tables"].get(table)

    def read(self, table: str, under: Iterable[str] | None = None) -> DataFrame | None:
        """The table as this run has it, None if there is none."""
        entry = self.entry(table)
        return None if entry is None else read_entry(self.spark, self.root, table, entry, under)

    def write(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), replace: Iterable[str] | None = None,
              observe: dict | None = None, keep: Column | None = None, drop: Sequence[str] = (), rebalance: bool = True, sort_within: Sequence[str] = ()) -> dict:
        """Write ``df`` as a new version. ``replace`` names the partition directories (or directories above
        partitions) that it takes the place of, whether rows come for them or not; by default all. ``observe``
        names aggregates over the rows, counted by the tasks that write them and returned; ``keep`` and ``drop`` then leave
        out rows and columns that are only there to be counted. Partitioned frames are rebalanced first, so that AQE sizes the
        writing tasks and splits a hot partition; not so where ``rebalance`` is off because the frame has an exchange
        of its own that does."""
        old = self.entry(table)
        if old is not None and replace is not None and old["partitioned_by"] != list(partition_by):
            raise ValueError(f"{table} is partitioned by {old['partitioned_by']}, not by {list(partition_by)}")
        tag, self._writes = f"{self.name}-{self._writes}", self._writes + 1
        path = f"{self.root}/{table}/{_folder(tag, bool(partition_by))}"
        if partition_by and rebalance:
            df = df.hint("rebalance", *partition_by)
        metrics = None
        if observe:
            # above the last exchange: counted in the job's result tasks, whose numbers Spark adds once each
            metrics = Observation()
            df = df.observe(metrics, *[c.alias(n) for n, c in observe.items()])
        if keep is not None:
            df = df.filter(keep)
        df = df.drop(*drop)
        if sort_within:
            df = df.sortWithinPartitions(*partition_by, *sort_within)
        schema = T.StructType([*[f for f in df.schema if f.name not in partition_by], *[df.schema[c] for c in partition_by]])
        if old is not None and replace is not None:
            schema = _widened(T.StructType.fromJson(old["schema"]), schema, len(partition_by))
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        with freed_shuffles(self.spark):
            writer.option("compression", CODEC).parquet(path)
        found = _partitions_below(self.spark, path, len(partition_by))
        self._own[path] = table, tag, found
        kept, written = {}, {}
        if old is not None and replace is not None:
            gone = set(replace)
            kept = {p: t for p, t in old["partitions"].items() if not _is_under(p, gone)}
            written = {t: n for t, n in old["written"].items() if t in kept.values()}
            if clash := set(kept).intersection(found):
                raise ValueError(f"{table}: rows for partitions that are not replaced: {sorted(clash)[:3]}")
        self.now["tables"][table] = {
            "partitioned_by": list(partition_by), "schema": schema.jsonValue(), "partitions": {**kept, **dict.fromkeys(found, tag)},
            "written": {**written, tag: len(found)}}
        counts = {} if metrics is None else {n: v or 0 for n, v in metrics.get.items()}
        return {n: counts.get(n, 0) for n in observe or {}}

    def remove(self, table: str, partitions: Iterable[str]) -> None:
        """Drop partitions (or all below these directories)."""
        entry = self.entry(table)
        if entry is not None:
            gone = set(partitions)
            entry["partitions"] = {p: t for p, t in entry["partitions"].items() if not _is_under(p, gone)}

    def forget(self, table: str) -> None:
        """Drop a table."""
        self.now["tables"].pop(table, None)

    @property
    def notes(self) -> dict:
        """Small facts that are published with the tables."""
        return self.now["notes"]

    def scratch(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written for this run alone; :meth:`discard_scratch` removes it."""
        path = f"{self.root}/_work/{self.name}/{name}-{self._writes}"
        self._writes += 1
        with freed_shuffles(self.spark):
            df.write.option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def discard_scratch(self) -> None:
        fs, p = _fs(self.spark, f"{self.root}/_work/{self.name}")
        fs.delete(p, True)

    def clear_superseded(self) -> None:
        """Remove directories that this run wrote and has replaced since: no manifest will name them. Frames read from them
        before must not be used any more."""
        for path, (table, tag, parts) in list(self._own.items()):
            now = (self.entry(table) or {"partitions": {}})["partitions"]
            live = [p for p in parts if now.get(p) == tag]
            for place in [f"{path}/{p}" for p in parts if p not in live] if live else [path]:
                fs, p = _fs(self.spark, place)
                fs.delete(p, True)
            self._own[path] = table, tag, live
            if not live:
                del self._own[path]

    def publish(self) -> int:
        """Put the manifest into place by one rename; the number of the new version."""
        spark, jvm = self.spark, self.spark.sparkContext._jvm
        folder = f"{self.root}/{MANIFEST}"
        fs, draft = _fs(spark, f"{folder}/.{self.name}")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(self.now, sort_keys=True).encode()))
        finally:
            stream.close()
        _, final = _fs(spark, f"{folder}/{self.now['number']:08d}.json")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
            if draft.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(files.makeQualified(draft), files.makeQualified(final), options)
        except Exception as failed:
            if fs.exists(final):
                fs.delete(draft, False)
                raise ConcurrentCommit(f"version {self.now['number']} of {self.root} was published by another run") from failed
            raise
        self.discard_scratch()
        return self.now["number"]


def _widened(old: T.StructType, new: T.StructType, n_partition: int) -> T.StructType:
    """The columns of both schemas, the old ones first, partition columns last."""
    known = {f.name: f for f in old}
    for f in new:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} was {known[f.name].dataType.simpleString()} and is {f.dataType.simpleString()} now")
    parts = new.fields[len(new) - n_partition:] if n_partition else []
    names = {f.name for f in parts}
    data = [f for f in old if f.name not in names]
    return T.StructType([*data, *[f for f in new if f.name not in known and f.name not in names], *parts])


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the version directories that none of the last ``keep`` manifests names, and partitions of the others that
    none names, with the manifests before them. Directories of a run that is still writing stay: their tag is larger than the last number."""
    root = root.rstrip("/")
    numbers = manifest_numbers(spark, root)
    if not numbers:
        return []
    kept = [load_manifest(spark, root, n) for n in numbers[-keep:]]
    live: dict[tuple[str, str], set[str]] = {}
    depth = {t: len(e["partitioned_by"]) for m in kept for t, e in m["tables"].items()}
    for m in kept:
        for t, e in m["tables"].items():
            for partition, tag in e["partitions"].items():
                live.setdefault((t, tag), set()).add(partition)
    removed = []
    # tables that the oldest manifest left knew and later ones do not are of no use to anybody
    tables = {t for n in numbers for t in load_manifest(spark, root, n)["tables"]}
    for table in sorted(tables):
        for name in _names(spark, f"{root}/{table}"):
            tag = name[len(VERSION) + 1:]
            if not name.startswith((f"{VERSION}=", f"{VERSION}-")) or int(tag.split("-")[0]) > numbers[-1]:
                continue
            used = live.get((table, tag))
            below = [name] if used is None else [f"{name}/{p}" for p in _partitions_below(spark, f"{root}/{table}/{name}", depth[table]) if p not in used]
            for place in below:
                fs, p = _fs(spark, f"{root}/{table}/{place}")
                fs.delete(p, True)
                removed.append(f"{table}/{place}")
    for n in numbers[:-keep]:
        fs, p = _fs(spark, f"{root}/{MANIFEST}/{n:08d}.json")
        fs.delete(p, False)
    return removed


def find_lake(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """(lake root, table) of a table's path, None for a path outside a lake."""
    steps = path.rstrip("/").split("/")
    for up in range(1, 4):
        root, table = "/".join(steps[:-up]), "/".join(steps[-up:])
        if root and _names(spark, f"{root}/{MANIFEST}"):
            return root, table
    return None


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """The published rows of a lake table by its path; None if the path is not one of a lake."""
    found = find_lake(spark, path)
    if found is None:
        return None
    root, table = found
    entry = load_manifest(spark, root)["tables"].get(table)
    return None if entry is None else read_entry(spark, root, table, entry)
