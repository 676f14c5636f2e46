"""Typed dictionary filters over metadata joined to the long-form signal."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_FIELDS = ("mins", "wavelength")
SIGNAL_FIELDS = (*RANGE_FIELDS, "absorbance")
OPERATORS = ("=", "IN", "BETWEEN")

# One wavelength of the red samples.
DEFAULT_FILTER = {
    "wavelength": {"value": (256, 256), "operator": "BETWEEN"},
    "color": {"value": "red", "operator": "="},
}

Filter = Mapping[str, Mapping[str, Any]]


def validate_filter(filters: Filter, with_signal: bool = True) -> None:
    """Raise TypeError or ValueError unless every entry is ``{column: {value, operator}}``."""
    if not isinstance(filters, Mapping):
        raise TypeError("the filter must be a dict")
    for column, entry in filters.items():
        if not isinstance(column, str):
            raise TypeError(f"column names must be text, got {column!r}")
        if not isinstance(entry, Mapping):
            raise TypeError(f"{column}: expected a dict of value and operator")
        if list(entry) != ["value", "operator"]:
            raise ValueError(f"{column}: expected the keys ['value', 'operator'], got {list(entry)}")
        value, operator = entry["value"], entry["operator"]
        if not isinstance(value, (str, int, float, list, tuple)):
            raise TypeError(f"{column}: value must be text, a number, a list or a tuple")
        if not isinstance(operator, str):
            raise TypeError(f"{column}: operator must be text")
        if isinstance(value, (str, list, tuple)) and not value:
            raise ValueError(f"{column}: value is empty")
        if operator not in OPERATORS:
            raise ValueError(f"{column}: operator must be one of {OPERATORS}, got {operator!r}")
        many = isinstance(value, (list, tuple))
        if operator == "BETWEEN" and not (many and len(value) == 2):
            raise ValueError(f"{column}: BETWEEN needs two bounds")
        if operator == "IN" and not many:
            raise ValueError(f"{column}: IN needs a list or tuple")
        if operator == "=" and many:
            raise ValueError(f"{column}: = needs one value")
        if not with_signal and column in SIGNAL_FIELDS:
            raise ValueError(f"{column} belongs to the signal, which was not asked for")


def infer_operators(values: Mapping[str, Any]) -> dict[str, dict[str, Any]]:
    """Full filter from bare values: ranges for range fields, IN for lists, = for scalars."""
    filters = {}
    for column, value in values.items():
        many = isinstance(value, (list, tuple))
        if hasattr(value, "__iter__") and not many and not isinstance(value, str):
            raise TypeError(f"{column}: only lists and tuples are accepted, got {type(value)}")
        operator = "=" if not many else "BETWEEN" if column in RANGE_FIELDS else "IN"
        filters[column] = {"value": value, "operator": operator}
    return filters


def build_predicate(filters: Filter) -> Column:
    """All conditions of a valid filter, joined by AND; typed literals, never SQL text."""
    conditions = []
    for name, entry in filters.items():
        column, value = F.col(name), entry["value"]
        if entry["operator"] == "BETWEEN":
            conditions.append(column.between(*value))
        elif entry["operator"] == "IN":
            conditions.append(column.isin(list(value)))
        else:
            conditions.append(column == value)
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def query(
    metadata: DataFrame, signal: DataFrame | None = None, filters: Filter = DEFAULT_FILTER,
    key: str = "id",
) -> DataFrame:
    """Metadata, left-joined to the signal if given, that satisfies the filter."""
    validate_filter(filters, with_signal=signal is not None)
    joined = metadata if signal is None else metadata.join(signal, key, "left")
    return joined.where(build_predicate(filters))


def query_tables(
    spark: SparkSession, filters: Filter = DEFAULT_FILTER, *, with_signal: bool = True,
    metadata_table: str = "sample_metadata", signal_table: str = "chromatogram_spectra_long",
    key: str = "id", view: str | None = None,
) -> DataFrame:
    """``query`` over tables of the catalog; ``view`` also registers the result under that name."""
    for name in (metadata_table, signal_table):
        if not spark.catalog.tableExists(name):
            raise ValueError(f"table {name} not found")
    signal = spark.table(signal_table) if with_signal else None
    found = query(spark.table(metadata_table), signal, filters, key)
    if view:
        found.createOrReplaceTempView(view)
    return found
