"""Writers and catalog registration for the gold layer."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tripstar import schemas
from tripstar.operators.metrics import PREAGGREGATES
from tripstar.plans.lake import CODEC, _fs, freed_shuffles, load_manifest, location, read_published


def write_table(df: DataFrame, path: str, partition_cols: Sequence[str] = (), mode: str = "overwrite",
                sort_within: Sequence[str] = (), rebalance: bool = True) -> None:
    """Write Parquet, optionally hive-partitioned.

    With partition columns the frame is ``REBALANCE``d on them first: AQE then sizes the write
    tasks (a day holding a third of all rows is split into several files instead of one huge
    task) and each task writes few partition directories; not so where ``rebalance`` is off because the rows come
    in the layout of files that were written like that. ``sort_within`` orders rows inside
    each file (after the partition columns, which the writer sorts by anyway), so Parquet
    min/max statistics let filtered reads skip row groups. A partitioned frame without rows leaves one
    empty file, so that the table can be read."""
    if partition_cols and rebalance:
        df = df.hint("rebalance", *partition_cols)
    if sort_within:
        df = df.sortWithinPartitions(*partition_cols, *sort_within)
    writer = df.write.mode(mode).option("compression", CODEC)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    spark = df.sparkSession
    with freed_shuffles(spark):
        writer.parquet(path)
    spark.catalog.refreshByPath(path)
    if partition_cols and not _has_data(spark, path):
        # partitioned writers leave nothing for an empty frame: declare the schema by an empty partition
        none = df.sparkSession.createDataFrame([], df.schema).drop(*partition_cols)
        none.write.mode("append").parquet("/".join([path, *(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in partition_cols)]))
        spark.catalog.refreshByPath(path)


def _has_data(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def remove_partitions(spark: SparkSession, path: str, partitions: Iterable[str]) -> None:
    """Remove partition directories (relative to the table), if they are there."""
    for part in partitions:
        fs, p = _fs(spark, f"{path.rstrip('/')}/{part}")
        fs.delete(p, True)
    spark.catalog.refreshByPath(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its path: what the lake's manifest says of it, or else the Parquet files there."""
    published = read_published(spark, path)
    return spark.read.parquet(path) if published is None else published


def run_statements(spark: SparkSession, statements: Iterable[str]) -> int:
    """Execute SQL statements in order, skipping blank ones; returns how many ran."""
    n = 0
    for stmt in statements:
        if stmt and stmt.strip():
            spark.sql(stmt)
            n += 1
    return n


def gold_table_ddl(database: str, gold_root: str) -> list[str]:
    """``CREATE DATABASE`` + idempotent external Parquet tables over the gold directories:
    dimensions, fact and the four pre-aggregates."""
    root = gold_root.rstrip("/")
    dd = schemas.ddl
    fact_cols = [f for f in schemas.FACT_RIDES.fields]
    types = {f.name: f.dataType.simpleString().upper() for f in fact_cols}
    return [
        f"CREATE DATABASE IF NOT EXISTS {database}",
        f"CREATE TABLE IF NOT EXISTS {database}.dim_date ({dd(schemas.DIM_DATE)}) "
        f"USING PARQUET LOCATION '{root}/dim_date'",
        f"CREATE TABLE IF NOT EXISTS {database}.dim_zone ({dd(schemas.DIM_ZONE)}) "
        f"USING PARQUET LOCATION '{root}/dim_zone'",
        f"CREATE TABLE IF NOT EXISTS {database}.fact_rides ("
        + ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in fact_cols)
        + f") USING PARQUET PARTITIONED BY ({', '.join(schemas.FACT_PARTITION_COLUMNS)}) "
        f"LOCATION '{root}/fact_rides'",
        *(f"CREATE TABLE IF NOT EXISTS {database}.{name} (`{key}` {types[key]}, `rides` BIGINT, `total_distance` DOUBLE, "
          f"`avg_distance` DOUBLE, `avg_duration_sec` DOUBLE) USING PARQUET LOCATION '{root}/{name}'"
          for name, key in PREAGGREGATES.items()),
    ]


def register_gold_tables(spark: SparkSession, database: str, gold_root: str) -> None:
    run_statements(spark, gold_table_ddl(database, gold_root))


def sync_partitions(spark: SparkSession, table: str) -> None:
    """Reconcile the catalog's partition list with the directories of a plain table (adds new, drops vanished)."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


# The manifest that a catalog table was last synced with, and partitions of one ALTER TABLE statement.
SYNCED, BATCH = "tripstar.manifest", 400


def _spec(partition: str) -> str:
    pairs = (step.split("=", 1) for step in partition.split("/"))
    return "PARTITION (" + ", ".join(f"`{k}` = " + ("NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'") for k, v in pairs) + ")"


def sync_statements(root: str, name: str, table: str, now: dict, before: dict | None, known: Iterable[str] | None = None) -> list[str]:
    """``ALTER TABLE`` statements that take the catalog's table from the manifest entry ``before`` to ``now``:
    only the partitions between them that differ. Without ``before``, ``known`` are the catalog's partitions."""
    if not now["partitioned_by"]:
        moved = before is None or before["partitions"] != now["partitions"]
        return [f"ALTER TABLE {table} SET LOCATION '{location(root, name, now)}'"] if moved else []
    old = dict.fromkeys(known or ()) if before is None else before["partitions"]
    new = now["partitions"]
    gone = sorted(p for p in old if p not in new)
    moved = sorted(p for p, tag in new.items() if p in old and old[p] != tag)
    added = sorted(p for p in new if p not in old)
    out = [f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(map(_spec, gone[i:i + BATCH])) for i in range(0, len(gone), BATCH)]
    out += [f"ALTER TABLE {table} {_spec(p)} SET LOCATION '{location(root, name, now, p)}'" for p in moved]
    out += [f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"{_spec(p)} LOCATION '{location(root, name, now, p)}'" for p in added[i:i + BATCH])
            for i in range(0, len(added), BATCH)]
    return out


def sync_catalog(spark: SparkSession, database: str, root: str) -> dict[str, int]:
    """Point the gold tables of the catalog at the last published version. The tables keep the number of the manifest
    that they were synced with, so only what changed since then is told to the catalog: a rerun of a month its days.
    Returns the statements run for each table."""
    root = root.rstrip("/")
    manifest, ran, seen = load_manifest(spark, root), {}, {}
    for name in sorted(n for n in manifest["tables"] if n.startswith("gold/")):
        table = f"{database}.{name.removeprefix('gold/')}"
        if not spark.catalog.tableExists(table):
            continue
        synced = spark.sql(f"SHOW TBLPROPERTIES {table} ('{SYNCED}')").first()["value"]
        before = None
        if synced.isdigit():
            if synced not in seen:
                seen[synced] = load_manifest(spark, root, int(synced), missing_ok=True)
            before = (seen[synced] or {"tables": {}})["tables"].get(name)
        known = None
        if before is None and manifest["tables"][name]["partitioned_by"]:
            known = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        statements = sync_statements(root, name, table, manifest["tables"][name], before, known)
        ran[name] = run_statements(spark, statements)
        run_statements(spark, [f"ALTER TABLE {table} SET TBLPROPERTIES ('{SYNCED}' = '{manifest['number']}')", f"REFRESH TABLE {table}"])
    return ran
