"""Reshaping of small-width tables: unpivot, pivot, union, stacked distinct values."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracehouse.functions.columns import named

TASK_VALUES = 500_000  # distinct values that a task holds at a time
SKETCH_BITS = 14  # 2**14 buckets: a standard error below 1%


def unpivot_values(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """Columns to (name, value) rows; null values are dropped."""
    return df.unpivot(list(ids), list(columns), name, value).where(F.col(value).isNotNull())


def pivot_values(
    df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str], how: str = "first"
) -> DataFrame:
    """(name, value) rows to columns. The names are given, so no extra job looks them up."""
    pick = {"first": F.first, "max": F.max, "min": F.min, "sum": F.sum}[how]
    return df.groupBy(*ids).pivot(name, list(names)).agg(pick(value))


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def labelled_values(df: DataFrame, values: Mapping[str, object], label: str = "metric") -> DataFrame:
    """Aggregates of one table as (label, value) rows, computed in one pass."""
    one = df.agg(*[v.cast("double").alias(k) for k, v in values.items()])
    return one.unpivot([], list(values), label, "value")


def stacked_distinct(
    df: DataFrame, columns: Sequence[str], name: str = "col", value: str = "unique_vals"
) -> DataFrame:
    """Distinct values of several columns, stacked; one scan."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], list(columns), name, value).distinct()


def _as_text(df: DataFrame, column: str) -> Column:
    """A column's values as text that is equal where they are."""
    value = named(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0).cast(df.schema[column].dataType)  # both zeros are one value
    return value.cast("string")


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(place, value) of the distinct non-null values of each column, by its place in ``columns``; one scan.

    Each task keeps the values that it has met and hands them on once, so rows are neither copied for each column nor
    shuffled: what is shuffled are the distinct values of the tasks.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[set[str]] = [set() for _ in columns]

        def out() -> pa.RecordBatch:
            places = np.repeat(np.arange(len(seen), dtype=np.int32), [len(s) for s in seen])
            values = [v for s in seen for v in s]
            return pa.RecordBatch.from_arrays([pa.array(places), pa.array(values, pa.string())], names=["place", "value"])

        for batch in batches:
            for place, column in enumerate(batch.columns):
                seen[place].update(column.drop_null().unique().to_pylist())
            if sum(map(len, seen)) > TASK_VALUES:
                yield out()
                seen = [set() for _ in columns]
        yield out()

    texts = df.select(*[_as_text(df, c).alias(f"c{k}") for k, c in enumerate(columns)])
    return texts.mapInArrow(of_task, "place int, value string").distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Number of distinct values of each column (null is none), in one row and one scan.

    ``approximate`` sketches them instead: nothing but the sketches leaves a task.
    """
    columns = list(columns or df.columns)
    if approximate:
        return df.agg(*[F.approx_count_distinct(named(c)).alias(c) for c in columns])
    values = distinct_values(df, columns)
    return values.agg(*[F.count_if(F.col("place") == k).alias(c) for k, c in enumerate(columns)])


def column_sketches(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, sketch): a mergeable sketch of each column's distinct values, a few kilobytes each; one scan."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.hll_sketch_agg(_as_text(df, c), F.lit(SKETCH_BITS)).alias(f"c{k}") for k, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{k}").alias("sketch")) for k, c in enumerate(columns)])
    return one.select(F.inline(pairs))


def estimated_counts(sketches: DataFrame) -> DataFrame:
    """(column, distinct) from the sketches of one table, or of several parts stacked: parts are merged, not scanned."""
    merged = sketches.groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("column", F.hll_sketch_estimate("sketch").alias("distinct"))
