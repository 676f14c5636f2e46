"""Sample register: cleaning, rows without a catalogue entry, and the ``st`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracehouse.functions.text import flag_from_text, normalise_name, trim_lower
from tracehouse.schemas import TABLES


def clean_register(raw: DataFrame, name_order: str = "quotes_first") -> DataFrame:
    return raw.select(
        F.col("detection").cast("string").alias("detection"),
        trim_lower(F.col("sampler")).alias("sampler"),
        trim_lower(F.col("samplecode")).alias("samplecode"),
        F.col("vintage").cast("int").alias("vintage"),
        normalise_name(F.col("wine"), name_order).alias("wine"),
        F.col("open_date").cast("string").alias("open_date"),
        F.col("sampled_date").cast("string").alias("sampled_date"),
        flag_from_text(F.col("added_to_cellartracker")).alias("added_to_cellartracker"),
        normalise_name(F.col("notes"), name_order).alias("notes"),
        F.col("size").cast("string").alias("size"),
    )


def not_in_catalogue(register: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Register rows without a catalogue row of that name and vintage; null names count as such."""
    return register.join(catalogue.select("wine", "vintage"), ["wine", "vintage"], "left_anti")


def flagged_but_missing(register: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Rows marked as entered in the catalogue that are not there."""
    return not_in_catalogue(register.where("added_to_cellartracker"), catalogue)


def load_register(
    raw: DataFrame, catalogue: DataFrame, detection: str = "raw", name_order: str = "quotes_first"
) -> tuple[DataFrame, DataFrame]:
    """(register rows with a catalogue row and the wanted detection, rows without a catalogue row)."""
    cleaned = clean_register(raw, name_order)
    unmatched = not_in_catalogue(cleaned, catalogue)
    matched = cleaned.where(F.col("detection") == detection).join(
        unmatched.select("samplecode"), "samplecode", "left_anti"
    )
    return TABLES["st"].conform(matched), unmatched
