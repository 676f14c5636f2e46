"""Run keys: uniquifying, remapping, timestamps and sequence names."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracehouse.functions.columns import free_name, named
from tracehouse.functions.text import char_at, slice_text
from tracehouse.operators.skew import ROWS_PER_TASK, global_positions, positions

# Run keys whose register code differs, and a misnamed sequence.
RUN_KEY_CODES = {
    "mt-diff-bannock-pn": "mt-diff-bannockburn-pn",
    "2021-debortoli-cabernet-merlot_avantor": "72",
    "stoney-rise-pn_02-21": "73",
    "crawford-cab_02-21": "74",
    "hey-malbec_02-21": "75",
    "koerner-nellucio-02-21": "76",
    "z3": "00",
    "116": "sigurdcb",
}
SEQUENCE_REPAIRS = {"wines_2023-03-15_11-33-51": "2023-03-15_11:33:51"}
NO_SEQUENCE = "singlesample"
ACQUISITION_FORMAT = "d-MMM-yy, HH:mm:ss"


def uniquify_keys(
    df: DataFrame,
    key: str,
    date: str,
    *,
    order: str = "time",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Append ``_<rank>`` to the second and later dates of a repeated key.

    ``order='time'`` ranks text dates as times, ``'text'`` ranks them as written. Rows tied on key
    and date share a rank and so stay duplicated; the primary-key check reports them.
    """
    if order not in ("time", "text"):
        raise ValueError(f"order must be 'time' or 'text', got {order!r}")
    by, columns = date, df.columns
    if order == "time" and dict(df.dtypes)[date] == "string":
        by = free_name(columns, "when")
        df = df.withColumn(by, acquisition_time(named(date)))
    ranked, at = positions(df, key, by, dense=True, rows_per_task=rows_per_task)
    unique = F.when(at["rank"] > 1, F.concat_ws("_", named(key), at["rank"].cast("string"))).otherwise(named(key))
    return ranked.select(*[unique.alias(c) if c == key else named(c) for c in columns])


def remap_key(col: Column, codes: Mapping[str, str] = RUN_KEY_CODES) -> Column:
    """Register code of a run key: the middle of ``0..1``/``0..2``, else a listed code, else itself."""
    padded = (F.length(col) == 4) & (char_at(col, 1) == "0") & char_at(col, -1).isin("1", "2")
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(codes.items())])
    return F.when(padded, F.substring(col, 2, 2)).otherwise(F.coalesce(table[col], col))


def acquisition_time(col: Column, fmt: str = ACQUISITION_FORMAT) -> Column:
    return F.to_timestamp_ntz(col, F.lit(fmt))


def repair_sequence_name(col: Column, repairs: Mapping[str, str] = SEQUENCE_REPAIRS) -> Column:
    for wrong, right in repairs.items():
        col = F.replace(col, F.lit(wrong), F.lit(right))
    return col


def sequence_time(name: Column, marker: str = NO_SEQUENCE) -> Column:
    """Start time held in the last 19 characters of a sequence name; null for the marker."""
    date = slice_text(name, -19, -10)
    clock = F.replace(slice_text(name, -8, -1), F.lit("-"), F.lit(":"))
    return F.when(name == marker, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.to_timestamp_ntz(F.concat_ws(" ", date, clock), F.lit("yyyy-MM-dd HH:mm:ss"))
    )


def sequences(runs: DataFrame) -> DataFrame:
    """Distinct sequences of the runs, with their start times."""
    distinct = runs.select("seq_name", "seq_desc").distinct()
    return distinct.select("seq_name", sequence_time(F.col("seq_name")).alias("dt_run"), "seq_desc")


def surrogate_key(
    df: DataFrame,
    order: str | list[str],
    name: str = "pk",
    *,
    rows_per_task: int = ROWS_PER_TASK,
    rows: int | None = None,
) -> DataFrame:
    """Number the rows from 1 along a natural key, so that a rerun gives the same numbers.

    The table is range partitioned along the key, counted per partition and written once; rows with equal keys are
    numbered by their contents. ``rows``: their number, if known.
    """
    if free_name(df.columns, name) != name:
        raise ValueError(f"there is a column {name} already")
    numbered, number = global_positions(df, order, rows_per_task=rows_per_task, rows=rows)
    return numbered.select((number + 1).alias(name), *map(named, df.columns))
