"""Signal traces: statistics, even re-gridding, trimming, reshaping and the cube.

A trace is the rows of one run ordered by time. Files keep no row order in Spark, so every
position comes from ``skew.positions``, which also survives a run that holds most of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracehouse.functions.columns import free_name, named
from tracehouse.operators.skew import ROWS_PER_TASK, positions

STEP_DIGITS = 9
CUBE_ROWS = 7800  # rows kept per run in the cube
STATS_WAVELENGTH = "256"


def image_columns(df: DataFrame, keys: Sequence[str] = ("runid", "id", "path", "idx", "mins")) -> list[str]:
    """Wavelength columns of a wide image, in wavelength order."""
    return sorted((c for c in df.columns if c not in keys), key=float)


def rezero_time(df: DataFrame, key: str, time: str = "mins") -> DataFrame:
    """Shift each run's times to start at zero."""
    # only the smallest time of each run is needed, so no window: an aggregate combines early
    start = free_name(df.columns, "start")
    starts = df.groupBy(key).agg(F.min(time).alias(start))
    shifted = df.join(starts, key, "left")
    return shifted.select(*[(F.col(time) - F.col(start)).alias(c) if c == time else named(c) for c in df.columns])


def signal_stats(
    df: DataFrame, key: str | Sequence[str], time: str, value: str, *, digits: int = 2,
    rows_per_task: int = ROWS_PER_TASK, most_rows: int | None = None,
) -> DataFrame:
    """Per run: bounds and count of time, bounds of the value and the first index of each, rate in Hz.

    The rate is the mean of 1/(60 * step) over steps in minutes; zero steps are left out of it.
    The statistics follow the numbering without another shuffle of the rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    trace, at = positions(
        df.select(*keys, time, value), keys, time, rows_per_task=rows_per_task, most_rows=most_rows
    )
    rate = F.try_divide(F.lit(1.0), 60 * (F.col(time) - at["prev"]))
    valued = F.when(F.col(value).isNotNull(), at["idx"])
    return trace.groupBy(*keys).agg(
        F.min(time).alias("mins_min"),
        F.max(time).alias("mins_max"),
        F.count(time).alias("mins_count"),
        F.min(value).alias("abs_min"),
        F.max(value).alias("abs_max"),
        F.min_by(valued, F.when(valued.isNotNull(), F.struct(F.col(value), at["idx"]))).alias("abs_argmin"),
        F.max_by(valued, F.when(valued.isNotNull(), F.struct(F.col(value), -at["idx"]))).alias("abs_argmax"),
        F.round(F.avg(rate), digits).alias("hertz"),
    )


def column_extrema(wavelengths: Sequence[str], leading: int = 2) -> dict[str, Column]:
    """First, last and number of columns; the number counts the ``leading`` key columns as well."""
    return {
        "nm_min": F.lit(int(float(wavelengths[0]))),
        "nm_max": F.lit(int(float(wavelengths[-1]))),
        "nm_count": F.lit(len(wavelengths) + leading),
        "n_wavelengths": F.lit(len(wavelengths)),
    }


def image_stats(
    images: DataFrame, key: str | Sequence[str] = "id", wavelength: str = STATS_WAVELENGTH,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Statistics of one wavelength per image. Only that column and the times are read."""
    wavelengths = image_columns(images)
    keys = [key] if isinstance(key, str) else list(key)
    trace = images.select(*keys, "mins", named(wavelength).alias("absorbance"))
    stats = signal_stats(trace, keys, "mins", "absorbance", rows_per_task=rows_per_task)
    return stats.withColumns(column_extrema(wavelengths))


def even_step(n: Column, first: Column, last: Column) -> Column:
    """Mean step to nine digits, halves to even. The differences add up to last minus first."""
    scale = F.lit(10.0**STEP_DIGITS)
    return F.rint(F.try_divide(last - first, n - 1) * scale) / scale


def _trace_keys(df: DataFrame, key: str) -> list[str]:
    """Run key, and the run's file where known: rows joined by file then need no second shuffle."""
    return [key, "path"] if "path" in df.columns else [key]


def _even_time(at: Column, key: str, time: str) -> Column:
    """Even time of a row by its place; fails where the grid would end before the rows do."""
    step = even_step(at["n"], at["first"], at["last"])
    room = F.ceil((at["last"] + step) / step)
    message = F.concat(F.lit(f"{time} grid too short for {key} "), F.col(key).cast("string"))
    too_short = (step > 0) & (at["n"] > room)
    return F.when(too_short, F.raise_error(message).cast("double")).otherwise(at["idx"] * step)


def _leading_rows(at: Column, key: str, rows: int, short: str) -> Column:
    """True for the first ``rows`` rows of a trace."""
    if short not in ("error", "keep"):
        raise ValueError(f"short must be 'error' or 'keep', got {short!r}")
    inside = at["idx"] < rows
    if short == "keep":
        return inside
    name = F.col(key).cast("string")
    message = F.format_string(f"{key} %s has %d rows, expected {rows}", name, at["n"])
    return F.when(at["n"] < rows, F.raise_error(message).cast("boolean")).otherwise(inside)


def _index(df: DataFrame, at: Column) -> Column:
    """The rows' numbers as the column ``idx``, which the rows must not have yet."""
    if free_name(df.columns, "idx") != "idx":
        raise ValueError("there is a column idx already")
    return at["idx"].alias("idx")


def regrid_time(
    df: DataFrame, key: str, time: str = "mins", *, order: Sequence[str] = (),
    keep_idx: bool = False, rows_per_task: int = ROWS_PER_TASK, most_rows: int | None = None,
) -> DataFrame:
    """Replace each run's times by 0, step, 2*step, ... at its mean step.

    A trace whose grid would end before its rows do (times far below zero) is an error, raised
    by the task that meets it. ``most_rows``: the largest run's rows, if known.
    """
    trace, at = positions(
        df, _trace_keys(df, key), [time, *order], rows_per_task=rows_per_task, most_rows=most_rows
    )
    even = _even_time(at, key, time)
    columns = [even.alias(c) if c == time else named(c) for c in df.columns]
    return trace.select(*columns, *([_index(df, at)] if keep_idx else []))


def trim_rows(
    df: DataFrame, key: str, rows: int = CUBE_ROWS, order: str | Sequence[str] = "mins", *,
    short: str = "error", keep_idx: bool = False, rows_per_task: int = ROWS_PER_TASK, most_rows: int | None = None,
) -> DataFrame:
    """First ``rows`` rows of each run. A shorter run is an error, or kept as is (``short='keep'``)."""
    trace, at = positions(df, _trace_keys(df, key), order, rows_per_task=rows_per_task, most_rows=most_rows)
    kept = trace.where(_leading_rows(at, key, rows, short))
    return kept.select(*map(named, df.columns), *([_index(df, at)] if keep_idx else []))


def prepare_cube(
    images: DataFrame, key: str = "runid", time: str = "mins", rows: int = CUBE_ROWS, *,
    short: str = "error", rows_per_task: int = ROWS_PER_TASK, most_rows: int | None = None,
) -> DataFrame:
    """Re-grid and trim from one numbering of the rows, keeping ``idx``."""
    trace, at = positions(
        images, _trace_keys(images, key), time, rows_per_task=rows_per_task, most_rows=most_rows
    )
    kept = trace.where(_leading_rows(at, key, rows, short))
    even = _even_time(at, key, time)
    return kept.select(*[even.alias(c) if c == time else named(c) for c in images.columns], _index(images, at))


def wide_to_long(
    df: DataFrame, ids: Sequence[str], wavelengths: Sequence[str] | None = None,
    name: str = "wavelength", value: str = "absorbance",
) -> DataFrame:
    """One row per time and wavelength. Pick wavelengths first: each multiplies the rows.

    Wavelengths are whole numbers if all columns' names are, and fractions otherwise.
    """
    columns = list(wavelengths or image_columns(df, ids))
    long = df.unpivot(list(ids), [named(c) for c in columns], name, value)
    whole = all(float(c).is_integer() for c in columns)
    number = F.col(name).cast("double")
    return long.withColumn(name, number.cast("int") if whole else number)


def wide_to_array(df: DataFrame, ids: Sequence[str], value: str = "absorbance") -> DataFrame:
    """One row per time with the values as an array in wavelength order: the dense cube's rows."""
    columns = image_columns(df, ids)
    return df.select(*ids, F.array(*[named(c).cast("double") for c in columns]).alias(value))


def column_sums(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Sum of every wavelength column per run, in one pass over the wide image."""
    columns = list(columns or image_columns(df, [key, "id", "runid", "path", "mins"]))
    return df.groupBy(key).agg(*[F.expr(f"sum(`{c}`) AS `{c}`") for c in columns])


def element_stats(df: DataFrame, array: str, position: str = "dim") -> DataFrame:
    """Smallest, largest, sum and count of every array position, over all rows.

    The array is exploded inside the map stage and combined there: one row per position and task
    reaches the shuffle.
    """
    elements = df.select(F.posexplode(array).alias(position, "value"))
    value = F.col("value").cast("double")
    return elements.groupBy(position).agg(
        F.min(value).alias("value_min"),
        F.max(value).alias("value_max"),
        F.sum(value).alias("value_sum"),
        F.count(value).alias("value_count"),
    )


def cube(
    images: DataFrame, metadata: DataFrame, *, key: str = "runid", time: str = "mins",
    rows: int = CUBE_ROWS, form: str = "long", short: str = "error",
    rows_per_task: int = ROWS_PER_TASK, most_rows: int | None = None,
) -> DataFrame:
    """Run x time x wavelength cube with every metadata field of the run beside its values.

    ``form='long'`` has a row per cell, ``'array'`` a row per time with an array over wavelengths.
    If both inputs name the run's file in ``path``, they are joined by it: the numbered rows are
    partitioned by file already, so the images are shuffled once in all. ``most_rows``: the largest
    run's rows, if known; they are counted otherwise.
    """
    if form not in ("long", "array"):
        raise ValueError(f"form must be 'long' or 'array', got {form!r}")
    by_path = "path" in images.columns and "path" in metadata.columns
    trimmed = prepare_cube(images, key, time, rows, short=short, rows_per_task=rows_per_task, most_rows=most_rows)
    unused = ["id"] if by_path else ["id", "path"]
    numeric = trimmed.drop(*[c for c in unused if c in trimmed.columns])
    ids = [key, "idx", time, *(["path"] if by_path else [])]
    values = wide_to_long(numeric, ids) if form == "long" else wide_to_array(numeric, ids)
    if by_path:
        return values.join(metadata.drop(key), "path").drop("path")
    return values.join(metadata.drop("path"), key)
