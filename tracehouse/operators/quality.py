"""Constraint checks as distributed queries: keys, nulls, references, coverage, counts, schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracehouse.schemas import ForeignKey, Table


class QualityError(ValueError):
    """A table breaks one of its constraints."""


def duplicate_keys(df: DataFrame, key: Sequence[str], nulls_are_equal: bool = False) -> DataFrame:
    """Keys held by more than one row, with their row ``count``. UNIQUE ignores null keys."""
    rows = df if nulls_are_equal else df.dropna(subset=list(key))
    return rows.groupBy(*key).agg(F.count("*").alias("count")).where("count > 1")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of nulls of each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def orphan_keys(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Distinct non-null child keys without a parent row."""
    keys = child.select(*fk.columns).dropna().distinct()
    targets = parent.select(*[F.col(p).alias(c) for c, p in zip(fk.columns, fk.parent_columns)])
    return keys.join(targets, list(fk.columns), "left_anti")


def violations(
    df: DataFrame,
    *,
    primary_key: Sequence[str] = (),
    unique: Iterable[Sequence[str]] = (),
    not_null: Sequence[str] = (),
    foreign_keys: Iterable[ForeignKey] = (),
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame | None:
    """Every broken rule as (check, columns, key, n), in one lazy frame; None without rules."""
    found: list[DataFrame] = []

    def report(check: str, columns: Sequence[str], rows: DataFrame, n) -> None:
        key = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]))
        found.append(
            rows.select(
                F.lit(check).alias("check"),
                F.lit(",".join(columns)).alias("columns"),
                key.alias("key"),
                n.cast("long").alias("n"),
            )
        )

    if primary_key:
        report("primary key", primary_key, duplicate_keys(df, primary_key, True), F.col("count"))
    for columns in unique:
        report("unique", columns, duplicate_keys(df, columns), F.col("count"))
    required = list(dict.fromkeys([*not_null, *primary_key]))
    if required:
        counts = null_counts(df, required).unpivot([], required, "column", "n").where("n > 0")
        found.append(
            counts.select(
                F.lit("not null").alias("check"),
                F.col("column").alias("columns"),
                F.lit(None).cast("string").alias("key"),
                F.col("n").cast("long").alias("n"),
            )
        )
    for fk in foreign_keys:
        if parents and fk.parent in parents:
            check = f"foreign key to {fk.parent}"
            report(check, fk.columns, orphan_keys(df, parents[fk.parent], fk), F.lit(1))
    return reduce(DataFrame.unionByName, found) if found else None


def validate(df: DataFrame, table: Table, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Return ``df`` if it keeps all of ``table``'s constraints, else raise with sample keys."""
    broken = violations(
        df,
        primary_key=table.primary_key,
        unique=table.unique,
        not_null=table.not_null,
        foreign_keys=table.foreign_keys,
        parents=parents,
    )
    sample = broken.limit(5).collect() if broken is not None else []  # for the message only
    if sample:
        lines = [f"{r['check']} ({r['columns']}): key {r['key']}, n={r['n']}" for r in sample]
        raise QualityError(f"table {table.name}: " + "; ".join(lines))
    return df


def coverage(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts of both sides without a partner: (side, rows)."""
    sides = []
    for name, one, other in (("left", left, right), ("right", right, left)):
        alone = one.select(*keys).join(other.select(*keys), list(keys), "left_anti")
        sides.append(alone.agg(F.count("*").alias("rows")).select(F.lit(name).alias("side"), "rows"))
    return sides[0].unionByName(sides[1])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise QualityError(f"{what} is empty")
    return df


def require_count(df: DataFrame, expected: int, what: str) -> DataFrame:
    found = df.count()
    if found != expected:
        raise QualityError(f"{what}: expected {expected} rows, found {found}")
    return df


def row_count_range(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest number of rows per key: (n_min, n_max). Equal means one length."""
    lengths = df.groupBy(key).agg(F.count("*").alias("n"))
    return lengths.agg(F.min("n").alias("n_min"), F.max("n").alias("n_max"))


def require_equal_lengths(df: DataFrame, key: str) -> DataFrame:
    low, high = row_count_range(df, key).first()
    if low != high:
        raise QualityError(f"{key}: between {low} and {high} rows each, expected one length")
    return df


def require_single_value(df: DataFrame, column: str) -> DataFrame:
    """``df`` if all its rows have one value of ``column``, null being a value; an empty table passes."""
    low, high, known, rows = df.agg(F.min(column), F.max(column), F.count(column), F.count("*")).first()
    if low != high:
        raise QualityError(f"expected one value of {column}, found {low!r} and {high!r}")
    if 0 < known < rows:
        raise QualityError(f"expected one value of {column}, found {low!r} and nulls")
    return df


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"{what}: missing columns {missing}; found {df.columns}")
    return df


def all_true(df: DataFrame, predicate, name: str = "all_true") -> DataFrame:
    """One row saying whether ``predicate`` holds on every row."""
    return df.agg(F.bool_and(predicate).alias(name))


def new_rows(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the target lacks, once each: insert-or-ignore."""
    return incoming.dropDuplicates(list(key)).join(target.select(*key), list(key), "left_anti")
