"""Run metadata: from landed files to ``chm`` and ``sequences``, and the joined metadata view."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracehouse.functions.columns import named
from tracehouse.functions.text import trim_lower
from tracehouse.operators.exclusion import without
from tracehouse.operators.keys import acquisition_time, remap_key, repair_sequence_name, sequences, uniquify_keys
from tracehouse.operators.quality import coverage
from tracehouse.schemas import TABLES

RUN_COLUMNS = ("id", "runid", "acq_date", "acq_method", "seq_name", "description")
CATALOGUE_COLUMNS = (
    "vintage", "wine", "locale", "country", "region", "subregion", "appellation", "producer",
    "type", "color", "category", "varietal",
)


class Runs(NamedTuple):
    loading: DataFrame
    sequences: DataFrame
    runs: DataFrame


def stage_runs(metadata: DataFrame, order: str = "time") -> DataFrame:
    """Landed metadata with unique run keys, register codes and typed columns (``chm_loading``)."""
    unique = uniquify_keys(metadata, "notebook", "date", order=order)
    staged = unique.select(
        F.col("notebook").alias("ch_runid"),
        remap_key(F.col("notebook")).alias("samplecode"),
        acquisition_time(F.col("date")).alias("acq_date"),
        trim_lower(F.col("method")).alias("acq_method"),
        F.col("injection_volume").cast("float").alias("inj_vol"),
        repair_sequence_name(trim_lower(F.col("seq_name"))).alias("seq_name"),
        trim_lower(F.col("seq_desc")).alias("seq_desc"),
        "vialnum",
        trim_lower(F.col("originalfilepath")).alias("originalfilepath"),
        F.col("id").cast("string").alias("id"),
        trim_lower(F.col("desc")).alias("description"),
        F.col("path").cast("string").alias("path"),
    )
    return TABLES["chm_loading"].conform(staged)


def registered_runs(loading: DataFrame, register: DataFrame) -> DataFrame:
    """Staged runs that have a register row (``chm``)."""
    joined = loading.join(register.select("samplecode"), "samplecode")
    return TABLES["chm"].conform(joined.withColumnRenamed("ch_runid", "runid"))


def load_runs(metadata: DataFrame, register: DataFrame, order: str = "time") -> Runs:
    loading = stage_runs(metadata, order)
    return Runs(loading, sequences(loading), registered_runs(loading, register))


def run_coverage(loading: DataFrame, register: DataFrame) -> DataFrame:
    """Runs without a register row (left) and register rows without a run (right)."""
    return coverage(loading, register, ["samplecode"])


def run_metadata(runs: DataFrame, register: DataFrame, catalogue: DataFrame, excluded: DataFrame) -> DataFrame:
    """Included runs with their register and catalogue fields.

    The exclusion goes first, so dropped runs take no part in the joins.
    """
    included = without(runs, excluded).select(*RUN_COLUMNS, "samplecode")
    samples = register.select("samplecode", "detection", "wine", "vintage")
    products = catalogue.select(*CATALOGUE_COLUMNS)
    registered = included.join(samples, "samplecode", "left")
    joined = registered.join(
        products,
        (registered["wine"] == products["wine"]) & (registered["vintage"] == products["vintage"]),
        "left",
    )
    return joined.select(*RUN_COLUMNS, "detection", *[products[c] for c in CATALOGUE_COLUMNS])


def attach_runid(images: DataFrame, runs: DataFrame) -> DataFrame:
    """Images with the run key of their instrument id in front; null for unknown ids."""
    return images.join(runs.select("runid", "id"), "id", "left").select("runid", *map(named, images.columns))
