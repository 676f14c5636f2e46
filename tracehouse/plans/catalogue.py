"""Catalogue: from the landed export to the ``ct`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracehouse.functions.text import html_unescape, normalise_name, trim_lower
from tracehouse.operators.quality import validate
from tracehouse.schemas import CATALOGUE_SOURCE, TABLES
from tracehouse.sources.sinks import write_parquet, write_table

OUTPUTS = ("df", "parquet", "table")


def clean_catalogue(raw: DataFrame, name_order: str = "quotes_first") -> DataFrame:
    """Lower-case, trimmed columns; the name freed of entities, quotes and accents; a text key."""
    columns = {c.lower(): trim_lower(F.col(c)) for c in CATALOGUE_SOURCE}
    columns["vintage"] = F.col("Vintage").cast("int")
    columns["wine"] = normalise_name(html_unescape(F.col("Wine")), name_order)
    cleaned = raw.select(*[c.alias(n) for n, c in columns.items()])
    keyed = cleaned.withColumn("wine_key", F.concat_ws(" ", F.col("vintage").cast("string"), "wine"))
    return keyed.select(*TABLES["ct"].column_names)


def load_catalogue(
    raw: DataFrame, output: str = "df", path: str | None = None, overwrite: bool = False,
    name_order: str = "quotes_first", check: bool = True,
) -> DataFrame | None:
    """Clean catalogue as a frame, a parquet export, or the warehouse table under ``path``."""
    if output not in OUTPUTS:
        raise ValueError(f"output must be one of {OUTPUTS}, got {output!r}")
    clean = clean_catalogue(raw, name_order)
    if output == "df":
        return validate(clean, TABLES["ct"]) if check else clean
    if path is None:
        raise ValueError(f"output {output!r} needs a path")
    if output == "parquet":
        write_parquet(clean, path, overwrite=overwrite)
        return None
    table = write_table(clean, TABLES["ct"], path, overwrite)
    return validate(table, TABLES["ct"]) if check else table
