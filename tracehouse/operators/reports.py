"""Summary reports over one column or table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    """Row counts per bin of ``width``; (bin, count), a bin named by its lower edge."""
    edge = F.floor(F.col(column) / width) * width
    return df.groupBy(edge.cast("double").alias("bin")).agg(F.count("*").alias("count"))


def percent_of_total(
    df: DataFrame, column: str, where: Column | None = None, name: str = "count_perc"
) -> DataFrame:
    """Share of all rows held by each value, in percent; ``where`` limits the values shown."""
    total = df.agg(F.count("*")).scalar()
    shown = df if where is None else df.where(where)
    counts = shown.groupBy(column).agg(F.count(column).alias("__n"))
    return counts.select(column, (F.col("__n") * 100 / total).alias(name))


def top_rows(df: DataFrame, rows: int, columns: list[str] | None = None) -> DataFrame:
    """Largest rows by the given columns, by default all from the left. Each task keeps that many."""
    return df.orderBy(*[F.desc(c) for c in (columns or df.columns)]).limit(rows)


def describe_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns of several tables, stacked: (table, place, column, type, nullable, comment)."""
    rows = [
        (name, place, f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("comment"))
        for name, df in tables.items()
        for place, f in enumerate(df.schema.fields)
    ]
    spark = next(iter(tables.values())).sparkSession
    kinds = "table string, place int, column string, type string, nullable boolean, comment string"
    return spark.createDataFrame(rows, kinds)
