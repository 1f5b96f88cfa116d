"""Projection operators of the silver layer: rename, lenient cast, conform, drop, fill, ids,
derived columns. Each is a single ``select``/``withColumns`` node, so Catalyst collapses the
chain into one projection and keeps column pruning and filter pushdown intact."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar import schemas
from tripstar.functions.columns import whole_seconds_between


def _q(name: str) -> str:
    return f"`{name}`"


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map in one node; absent source names and identity entries are ignored."""
    present = {src: dst for src, dst in mapping.items() if src in df.columns and src != dst}
    return df.withColumnsRenamed(present) if present else df


def lenient_cast(df: DataFrame, target: T.StructType | Mapping[str, T.DataType]) -> DataFrame:
    """Cast each present target column to its type; malformed values become NULL (``try_cast``)
    instead of failing the job under ANSI mode. Columns not in ``target`` pass through."""
    types = {f.name: f.dataType for f in target.fields} if isinstance(target, T.StructType) else dict(target)
    return df.select([
        F.col(_q(c)).try_cast(types[c]).alias(c) if c in types and df.schema[c].dataType != types[c] else F.col(_q(c))
        for c in df.columns
    ])


def conform(df: DataFrame, schema: T.StructType, optional: Iterable[str] = ()) -> DataFrame:
    """Select exactly the schema's columns in schema order. Extra columns are dropped; missing
    columns raise one error naming all of them (``optional`` ones are skipped instead)."""
    optional = set(optional)
    missing = [f.name for f in schema.fields if f.name not in df.columns and f.name not in optional]
    if missing:
        raise ValueError(f"input lacks required column(s): {', '.join(missing)}")
    return df.select([_q(f.name) for f in schema.fields if f.name in df.columns])


def standardise(df: DataFrame, schema: T.StructType, renames: Mapping[str, str],
                optional: Iterable[str] = ()) -> DataFrame:
    """rename -> lenient cast -> conform."""
    return conform(lenient_cast(rename_columns(df, renames), schema), schema, optional)


def standardise_rides(df: DataFrame) -> DataFrame:
    """Raw ride columns -> declared silver columns (``trip_id`` kept if already present)."""
    return standardise(df, schemas.SILVER_RIDES, schemas.RIDE_RENAMES, optional=("trip_id",))


def drop_operational_columns(df: DataFrame, columns: Iterable[str] = schemas.OPERATIONAL_COLUMNS) -> DataFrame:
    """Remove dispatch/flag columns; absent ones are ignored."""
    return df.drop(*columns)


def fill_on_scene(df: DataFrame) -> DataFrame:
    """``on_scene_datetime := coalesce(on_scene_datetime, request_datetime)``."""
    return df.withColumn("on_scene_datetime", F.coalesce("on_scene_datetime", "request_datetime"))


# Layout of a ride id, from the top: sign 0, quarantine flag, 15 bits of month (12 * year + month of the
# source month; 0 if unknown), then 13 bits of cell and 34 of rank (silver) or 19 bits of scan partition
# and 28 of position (quarantine).
ID_FLAG_BIT, ID_MONTH_BIT, ID_CELL_BITS, ID_RANK_BITS, ID_POSITION_BITS = 62, 47, 13, 34, 28


def month_number(source_month: Column) -> Column:
    """12 * year + month of ``yyyy-MM``; 0 for anything else."""
    known = source_month.rlike("^[0-9]{4}-(0[1-9]|1[0-2])$")
    return F.when(known, F.substring(source_month, 1, 4).try_cast("long") * 12 + F.substring(source_month, 6, 2).try_cast("long")).otherwise(F.lit(0).cast("long"))


def add_trip_id(df: DataFrame, key: Iterable[str] = schemas.NATURAL_KEY, month: Column | None = None,
                by_range: Sequence[str] = ()) -> DataFrame:
    """Surrogate ``trip_id`` (BIGINT) of rows that are distinct on (month, key): the month number, a
    hash cell of the key and the rank of the key inside (month, cell). Unique by construction, also over
    months that are loaded one after another, and a function of the month's rows alone: partitioning,
    retries and other months do not change it. Costs one shuffle on (month, cell); the cells keep a
    month with a third of all rows from meeting in one task.

    ``by_range`` names columns that tell the month (the partition columns of a write): the rows are then
    ranged over them and the cell, so each task has few of their values, in their order, and the write
    needs no exchange of its own."""
    key = [_q(c) for c in key]
    m = month_number(F.date_format("start_time", "yyyy-MM") if month is None else month)
    cell = F.pmod(F.xxhash64(*key), F.lit(1 << ID_CELL_BITS))
    if by_range:  # the number of the month is told after the exchange: nothing of it is shuffled
        group = [*by_range, "__cell"]
        placed = df.withColumn("__cell", cell).repartitionByRange(*group).withColumn("__month", m)
    else:
        group = ["__month", "__cell"]
        placed = df.withColumns({"__month": m, "__cell": cell})
    inside = Window.partitionBy(*group).orderBy(*key)
    ranked = placed.withColumn("__rank", F.row_number().over(inside).cast("long"))
    packed = F.shiftleft("__month", ID_MONTH_BIT).bitwiseOR(F.shiftleft("__cell", ID_RANK_BITS)).bitwiseOR(F.col("__rank"))
    return ranked.withColumn("trip_id", packed).drop("__month", "__cell", "__rank")


def add_quarantine_id(df: DataFrame, month: Column) -> DataFrame:
    """``trip_id`` of quarantined rows, which may repeat: flag, month number, scan partition and
    position there. Map-only; unique over silver and over the other months of quarantine."""
    scan = F.monotonically_increasing_id()
    place = F.shiftleft(F.shiftright(scan, 33), ID_POSITION_BITS).bitwiseOR(scan.bitwiseAND(F.lit((1 << ID_POSITION_BITS) - 1)))
    return df.withColumn("trip_id", F.lit(1 << ID_FLAG_BIT).bitwiseOR(F.shiftleft(month_number(month), ID_MONTH_BIT)).bitwiseOR(place))


def derive_trip_columns(df: DataFrame) -> DataFrame:
    """``trip_duration_sec`` (whole seconds, end - start) and the partition columns
    ``year``/``month``/``day`` of ``start_time``."""
    st = F.col("start_time")
    return df.withColumns({
        "trip_duration_sec": whole_seconds_between("start_time", "end_time"),
        "year": F.year(st),
        "month": F.month(st),
        "day": F.dayofmonth(st),
    })
