"""Pump programs: normal forms of the landed tables, and gradients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracehouse.operators.quality import require_rows
from tracehouse.operators.reshape import pivot_values, union_distinct, unpivot_values
from tracehouse.operators.skew import positions

CHANNELS = ("a", "b")
TARGET_GRADIENT = 2.5
MOST_STEPS = 100_000  # of a pump program


def mechanical_params(timetables: DataFrame) -> DataFrame:
    """Distinct flow and pressure of each run. A program that varies them breaks the primary key."""
    return timetables.select("runid", "flow", "pressure").distinct()


def channels(timetables: DataFrame) -> DataFrame:
    wide = timetables.select(
        "runid", F.col("mins").cast("double"), *[F.col(c).cast("double") for c in CHANNELS]
    )
    return unpivot_values(wide, ["runid", "mins"], CHANNELS, "channel", "percent")


def solvents(solvcomps: DataFrame) -> DataFrame:
    lowered = solvcomps.select("runid", F.lower("channel").alias("channel"), "ch1_solv")
    return pivot_values(lowered, ["runid"], "channel", "ch1_solv", CHANNELS)


def zero_point(composition: DataFrame, ids: Sequence[str] = ("runid",), time: str = "mins") -> DataFrame:
    """The composition each run starts with, as a program step at time zero."""
    return composition.select(
        *ids,
        F.lit(0.0).alias(time),
        F.lower("channel").alias("channel"),
        F.col("percent").cast("double").alias("percent"),
    )


def solvent_program(timetables: DataFrame, solvcomps: DataFrame) -> DataFrame:
    """Percent of each channel over time, the starting composition included."""
    return union_distinct(channels(timetables), zero_point(solvcomps))


def first_two_points(points: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Per key with two or more times: t1, v1, t2, v2 of the earliest two.

    The rank limit is applied in the map stage as well (group-limited window), so a key with very
    many points sends only its first two from each task.
    """
    by_time = Window.partitionBy(key).orderBy(time)
    early = (
        points.select(key, time, value)
        .withColumn("__rank", F.dense_rank().over(by_time))
        .where(F.col("__rank") <= 2)
    )
    return (
        early.groupBy(key)
        .agg(
            F.min(time).alias("t1"),
            F.min_by(value, time).alias("v1"),
            F.max(time).alias("t2"),
            F.max_by(value, time).alias("v2"),
        )
        .where(F.col("t2") > F.col("t1"))
    )


def gradients(
    points: DataFrame, key: str = "runid", time: str = "mins", value: str = "percent",
    where: Column | None = None, method: str = "per_time", name: str = "gradient",
) -> DataFrame:
    """Rise between each run's first two points.

    ``per_time`` divides by the second time itself, which equals the slope when the first is at
    zero; ``slope`` divides by the time between the two. Division by zero gives null.
    """
    if method not in ("per_time", "slope"):
        raise ValueError(f"method must be 'per_time' or 'slope', got {method!r}")
    rows = points if where is None else points.where(where)
    two = first_two_points(rows, key, time, value)
    span = F.col("t2") if method == "per_time" else F.col("t2") - F.col("t1")
    return two.select(key, F.try_divide(F.col("v2") - F.col("v1"), span).alias(name))


def run_gradients(program: DataFrame, check: bool = True) -> DataFrame:
    """Gradient of channel b of every run."""
    if check:
        require_rows(program, "solvprop_over_mins")
    return gradients(program, where=F.col("channel") == "b")


def counts_per_gradient(gradient_table: DataFrame) -> DataFrame:
    return gradient_table.groupBy("gradient").agg(F.count("*").alias("count"))


def _elution_steps(timetables: DataFrame, solvcomps: DataFrame, id_col: str, time: str) -> DataFrame:
    """(id, time, channel, percent) of the starting compositions and all steps."""
    steps = unpivot_values(
        timetables.select(id_col, F.col(time).cast("double"), *[F.col(c).cast("double") for c in CHANNELS]),
        [id_col, time],
        CHANNELS,
        "channel",
        "percent",
    )
    return zero_point(solvcomps, [id_col], time).unionByName(steps)


def elution_table(
    timetables: DataFrame, solvcomps: DataFrame, id_col: str = "num", time: str = "time"
) -> DataFrame:
    """Wide program of the older layout: one row per (id, time) and a column per channel."""
    # the pivot keeps one value a cell, so equal rows need no distinct of their own
    stacked = _elution_steps(timetables, solvcomps, id_col, time)
    return pivot_values(stacked, [id_col, time], "channel", "percent", CHANNELS)


def numbered_elution_table(
    timetables: DataFrame, solvcomps: DataFrame, id_col: str = "num", time: str = "time", *,
    most_steps: int | None = MOST_STEPS,
) -> DataFrame:
    """``elution_table`` with the steps of each program numbered from 1.

    Steps are ranked before the pivot, in the partitioning that it uses too: one shuffle in all. No program of a pump
    has more than ``most_steps`` steps; a longer one fails in the task that meets it. With None, rows are counted first
    and programs of any size are numbered.
    """
    stacked = _elution_steps(timetables, solvcomps, id_col, time)
    ranked, at = positions(stacked, id_col, time, dense=True, most_rows=most_steps)
    entry = at["rank"]
    if most_steps is not None:
        message = F.concat(F.lit(f"more than {most_steps} steps in program "), F.col(id_col).cast("string"))
        entry = F.when(entry > most_steps, F.raise_error(message).cast("long")).otherwise(entry)
    numbered = ranked.select(*stacked.columns, entry.alias("entry"))
    wide = pivot_values(numbered, [id_col, time, "entry"], "channel", "percent", CHANNELS)
    return wide.select(id_col, time, *CHANNELS, "entry")
