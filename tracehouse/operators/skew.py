"""Hot-key handling for work that Spark cannot split by itself.

Aggregates combine before the shuffle and AQE splits skewed joins, but a window sends a whole key to
one task. ``positions`` numbers the rows of every key without doing so: the rows of hot keys are range
partitioned by key and order, so a key is a stretch of tasks, each numbers its own part, and the parts
are stitched together with the row counts of those before them.

Computed values come back in one struct column whose name no column of the input has.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracehouse.functions.columns import free_name, named, quoted
from tracehouse.sources.staging import staged

# A key below this many rows is sorted by one task.
ROWS_PER_TASK = 4_000_000
# A key is hot only above 1/MAX_HOT of all rows, so there are never more hot keys than this.
MAX_HOT = 32_768

_ORDERED = (T.NumericType, T.StringType, T.BinaryType, T.TimestampNTZType, T.TimestampType, T.DateType, T.BooleanType)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition in which null keys equal each other, as they do in grouping."""
    return reduce(lambda a, b: a & b, (left[quoted(k)].eqNullSafe(right[quoted(k)]) for k in keys))


def _require_ordered(df: DataFrame, order: Iterable[str]) -> None:
    """Fail on every path alike, rather than only once a key is large."""
    for name in order:
        kind = df.schema[name].dataType
        if not isinstance(kind, _ORDERED):
            raise TypeError(f"cannot order by {name} of type {kind.simpleString()}")


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, int, int] | None:
    """Keys with more rows than a task should sort, their rows in all and the limit they exceed; None without any.

    One scan of the key columns. Hot keys hold over 1/MAX_HOT of all rows each, which bounds what is collected.
    """
    n = free_name(keys, "n")
    counts = df.groupBy(*map(named, keys)).agg(F.count("*").alias(n))
    total, largest = counts.agg(F.sum(n), F.max(n)).first()
    if largest is None or largest <= rows_per_task:
        return None
    limit = max(rows_per_task, total // MAX_HOT)
    rows = counts.where(F.col(n) > limit).collect()
    if not rows:
        return None
    found = df.sparkSession.createDataFrame([tuple(r)[:-1] for r in rows], T.StructType(counts.schema.fields[:-1]))
    return found, sum(r[n] for r in rows), limit


def _sorted(df: DataFrame, order: Sequence[str], parts: int) -> tuple[DataFrame, str]:
    """``df`` sorted along ``order`` over ``parts`` tasks, with each row's place.

    The place is a struct of ``part`` (ascending along the order) and ``row`` (ascending in the part; the upper bits hold
    the part). Rows with equal order values are dealt by a hash of all their columns, so a rerun places them alike, and
    rows that are equal in everything at random.
    """
    place = free_name(df.columns, "place")
    hashed = [named(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()]
    ties = F.struct(F.xxhash64(*hashed).alias("hash"), F.rand(1).alias("rand"))
    by = [*map(named, order), F.col(place)["hash"], F.col(place)["rand"]]
    tied = df.withColumn(place, ties)
    ranged = (tied.repartitionByRange(parts, *by) if parts > 1 else tied.repartition(1)).sortWithinPartitions(*by)
    at = F.struct(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    return ranged.withColumn(place, at), place


def range_placed(df: DataFrame, order: Sequence[str], rows: int, limit: int) -> tuple[DataFrame, str]:
    """``_sorted`` over tasks of about half of ``limit`` rows, written.

    Spark samples the ranges anew in each job; the table is written, so every later use sees the same ones.
    """
    placed, place = _sorted(df, order, max(1, ceil(2 * rows / limit)))
    return staged(placed, "placed"), place


def _numbered(df: DataFrame, cell: list[Column], order: list[Column], by: Column, dense: bool, name: str) -> DataFrame:
    """Numbers within every cell, from one window specification: one shuffle and one sort of the rows."""
    along = Window.partitionBy(*cell).orderBy(*order)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    computed = {
        "idx": (F.row_number().over(along) - 1).cast("long"),
        "prev": F.lag(by).over(along),
        "n": F.count(F.lit(1)).over(whole),
        "first": F.first(by).over(whole),
        "last": F.last(by).over(whole),
    }
    if dense:
        computed["rank"] = F.dense_rank().over(Window.partitionBy(*cell).orderBy(by)).cast("long")
    return df.withColumn(name, F.struct(*[c.alias(field) for field, c in computed.items()]))


def _by_range(
    df: DataFrame, keys: list[str], order: list[str], rows: int, limit: int, dense: bool, name: str
) -> DataFrame:
    """Numbers of the rows of hot keys: part by part, then stitched together."""
    by = order[0]
    placed, place = range_placed(df, [*keys, *order], rows, limit)
    part = F.col(place)["part"]
    numbered = _numbered(placed, [part, *map(named, keys)], [F.col(place)["row"]], named(by), dense, name)

    # one row per part of a hot key: at most the parts and the hot keys. Null is a value like others, and the first.
    ranked = F.struct(named(by).isNotNull().alias("known"), named(by).alias("value"))
    at = free_name([*placed.columns, name], "part")
    of = free_name([*placed.columns, name, at], "own")
    own = {
        "n": F.count("*"),
        "first": F.min(ranked)["value"],
        "last": F.max(ranked)["value"],
        **({"values": F.count_distinct(ranked)} if dense else {}),
    }
    parts = (
        placed.groupBy(*map(named, keys), part.alias(at))
        .agg(*[c.alias(f"{of}{field}") for field, c in own.items()])
        .select(*map(named, keys), at, F.struct(*[F.col(f"{of}{field}").alias(field) for field in own]).alias(of))
    )
    before = Window.partitionBy(*map(named, keys)).orderBy(at)
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    every = before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    here = F.col(of)
    stitched = {
        "offset": F.coalesce(F.sum(here["n"]).over(earlier), F.lit(0)),
        "prev": F.lag(here["last"]).over(before),
        "n": F.sum(here["n"]).over(every),
        "first": F.first(here["first"]).over(every),
        "last": F.last(here["last"]).over(every),
    }
    if dense:
        # parts that hold equal values at their border share that value's rank
        follows = (F.row_number().over(before) > 1) & here["first"].eqNullSafe(F.lag(here["last"]).over(before))
        shared = free_name([*keys, at, of], "shared")
        parts = parts.withColumn(shared, follows.cast("long"))
        new = here["values"] - F.col(shared)
        stitched["ranks"] = F.coalesce(F.sum(new).over(earlier), F.lit(0)) - F.col(shared)
    offsets = parts.select(*map(named, keys), at, F.struct(*[c.alias(f) for f, c in stitched.items()]).alias(of))
    condition = same_keys(numbered, offsets, keys) & (numbered[place]["part"] == offsets[at])
    joined = numbered.join(F.broadcast(offsets), condition)
    mine, whole = F.col(name), F.col(of)
    fields = {
        "idx": mine["idx"] + whole["offset"],
        "prev": F.when(mine["idx"] == 0, whole["prev"]).otherwise(mine["prev"]),
        "n": whole["n"],
        "first": whole["first"],
        "last": whole["last"],
    }
    if dense:
        fields["rank"] = mine["rank"] + whole["ranks"]
    values = F.struct(*[c.alias(field) for field, c in fields.items()])
    return joined.select(*[numbered[quoted(c)] for c in df.columns], values.alias(name))


def positions(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    *,
    dense: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    most_rows: int | None = None,
) -> tuple[DataFrame, Column]:
    """The rows of ``df`` and, for each, its place among the rows of its key along ``order``.

    The place is a struct column of the returned frame: ``idx`` (from 0), ``prev`` (previous order value), ``n`` (rows of
    the key), ``first`` and ``last`` (bounds of the order column) and, if ``dense``, ``rank`` (dense, from 1). Later
    order columns only break ties. Nulls come first. No column of ``df`` is touched, whatever its name.

    Rows per key are counted first, which reads the key columns once more. A caller that knows the largest count gives
    it as ``most_rows``; below ``rows_per_task`` no job runs while the query is built.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    _require_ordered(df, order)
    name = free_name(df.columns, "position")
    small = most_rows is not None and most_rows <= rows_per_task
    hot = None if small else hot_keys(df, keys, rows_per_task)

    def plain(rows: DataFrame) -> DataFrame:
        return _numbered(rows, [named(k) for k in keys], [named(c) for c in order], named(order[0]), dense, name)

    if hot is None:
        return plain(df), F.col(name)
    few, rows, limit = hot
    of_hot = same_keys(df, few, keys)
    large = _by_range(df.join(F.broadcast(few), of_hot, "left_semi"), keys, order, rows, limit, dense, name)
    return plain(df.join(F.broadcast(few), of_hot, "left_anti")).unionByName(large), F.col(name)


def global_positions(
    df: DataFrame, order: str | Sequence[str], *, rows_per_task: int = ROWS_PER_TASK, rows: int | None = None
) -> tuple[DataFrame, Column]:
    """The rows of ``df`` and each one's number, from 0, along ``order`` over the whole table.

    Rows are range partitioned along the order and counted per partition; a row's number is the sum of the counts before
    its partition and its own place there. ``rows``: their number, if known; they are counted otherwise.
    """
    order = [order] if isinstance(order, str) else list(order)
    _require_ordered(df, order)
    rows = df.count() if rows is None else rows
    number = free_name(df.columns, "number")
    if rows <= rows_per_task:
        placed, place = _sorted(df, order, 1)
        return placed.select(*map(named, df.columns), F.col(place)["row"].alias(number)), F.col(number)
    placed, place = range_placed(df, order, rows, rows_per_task)
    within = F.col(place)["row"] - F.shiftleft(F.col(place)["part"].cast("long"), 33)
    part, before = free_name(placed.columns, "part"), free_name(placed.columns, "before")
    counts = placed.groupBy(F.col(place)["part"].alias(part)).agg(F.count("*").alias(before))
    # one row per partition
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    joined = placed.join(F.broadcast(offsets), placed[place]["part"] == offsets[part])
    return joined.select(*[placed[quoted(c)] for c in df.columns], (within + F.col(before)).alias(number)), F.col(number)
