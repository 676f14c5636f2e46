"""Exclusion rules and the tables without the excluded runs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracehouse.functions.text import child_path
from tracehouse.operators.program import TARGET_GRADIENT

# Fixed value: the reason as the warehouse states it.
GRADIENT_REASON = f"gradient not equal to {TARGET_GRADIENT}"


def manual_rule(runs: DataFrame, listed: Iterable[Mapping[str, str]] | DataFrame, key: str = "runid") -> DataFrame:
    """Listed exclusions (runid, reason) of runs that exist. Empty entries are ignored."""
    if not isinstance(listed, DataFrame):
        rows = [(item["runid"], item["reason"]) for item in listed if item]
        listed = runs.sparkSession.createDataFrame(rows, f"{key} string, reason string")
    return listed.select(key, "reason").join(runs.select(key), key, "left_semi")


def gradient_rule(gradients: DataFrame, target: float = TARGET_GRADIENT) -> DataFrame:
    """Runs with another gradient; runs without one stay included."""
    return gradients.where(F.col("gradient") != target).select("runid", F.lit(GRADIENT_REASON).alias("reason"))


def combine_rules(rules: Sequence[DataFrame], key: str = "runid") -> DataFrame:
    """One row per excluded run; the reason of the earliest rule in the list wins."""
    ranked = [
        rule.select(key, "reason").withColumn("__order", F.lit(i)) for i, rule in enumerate(rules)
    ]
    stacked = reduce(DataFrame.unionByName, ranked)
    return stacked.groupBy(key).agg(F.min_by("reason", F.struct("__order", "reason")).alias("reason"))


def without(df: DataFrame, excluded: DataFrame, key: str = "runid") -> DataFrame:
    """Rows of runs that are not excluded."""
    return df.join(excluded.select(key), key, "left_anti")


def time_outliers(stats: DataFrame, runs: DataFrame, cutoff: float, key: str = "runid") -> DataFrame:
    """Statistics and metadata of runs that end before ``cutoff``."""
    shared = [c for c in runs.columns if c in stats.columns and c != key]
    return stats.where(F.col("mins_max") < cutoff).join(runs.drop(*shared), key)


def run_data_paths(included: DataFrame) -> DataFrame:
    path = F.col("path")
    return included.select(
        "runid",
        "path",
        child_path(path, "data.parquet").alias("data_path"),
        child_path(path, "metadata.parquet").alias("meta_path"),
    )
