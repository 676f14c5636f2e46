"""Name reconciliation: match register keys to the catalogue and correct the register."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracehouse.functions.columns import free_name, named
from tracehouse.functions.text import flag_from_text, normalise_name, slice_text, trim_lower, vintage_or_default
from tracehouse.operators.keys import surrogate_key
from tracehouse.operators.matching import best_match
from tracehouse.operators.quality import all_true
from tracehouse.operators.reshape import labelled_values
from tracehouse.sources.sinks import write_parquet
from tracehouse.sources.staging import staged

VERIFIED_ABOVE = 75
UNMATCHED_REASON = "missing catalogue entry"
EXPORT_COLUMNS = [
    "detection", "sampler", "samplecode", "vintage", "wine", "open_date", "sampled_date",
    "added_to_cellartracker", "notes", "size",
]


def stage_register(raw: DataFrame) -> DataFrame:
    """Original register (CSV) with a surrogate key, default vintages and a text key."""
    cleaned = raw.select(
        "detection",
        vintage_or_default(F.col("vintage")).alias("vintage"),
        trim_lower(F.col("sampler")).alias("sampler"),
        trim_lower(F.col("samplecode")).alias("samplecode"),
        normalise_name(F.col("name")).alias("wine"),
        "open_date",
        "sampled_date",
        flag_from_text(F.col("added_to_cellartracker")).alias("added_to_cellartracker"),
        normalise_name(F.col("notes")).alias("notes"),
        F.col("size").cast("float").alias("size"),
    )
    key = F.concat_ws(" ", F.col("vintage").cast("string"), trim_lower(F.col("wine")))
    return surrogate_key(cleaned.withColumn("wine_key", key), "samplecode")


def match_names(
    register: DataFrame, catalogue: DataFrame, min_score: int = VERIFIED_ABOVE + 1, fallback: bool = False
) -> DataFrame:
    """(pk, left_string, match, score, verified) of every register row.

    Only matches that can be verified are searched. ``min_score=1, fallback=True`` gives every row its
    best match for inspection.
    """
    left = register.select("pk", F.lower("wine_key").alias("left_string"))
    right = catalogue.select(F.lower("wine_key").alias("match_key"))
    matched = best_match(left, right, "left_string", "match_key", "match_key", min_score=min_score, fallback=fallback)
    return matched.select(
        "pk", "left_string", "match", "score",
        F.coalesce(F.col("score") > VERIFIED_ABOVE, F.lit(False)).alias("verified"),
    )


def unmatched_names(matches: DataFrame) -> DataFrame:
    return matches.where(~F.col("verified")).select(
        "pk", "left_string", "match", "score", F.lit(UNMATCHED_REASON).alias("reason")
    )


def update_from(df: DataFrame, source: DataFrame, key: str, values: dict[str, str]) -> DataFrame:
    """Replace columns by those of a one-row-per-key source, where it has a value."""
    new = free_name(df.columns, "new")
    fresh = source.select(key, F.struct(*[F.col(s).alias(c) for c, s in values.items()]).alias(new))
    joined = df.join(fresh, key, "left")
    return joined.select(
        *[F.coalesce(F.col(new)[c], named(c)).alias(c) if c in values else named(c) for c in df.columns]
    )


def apply_matches(register: DataFrame, matches: DataFrame) -> DataFrame:
    """Register with verified keys replaced, and the name taken from its key."""
    verified = matches.where("verified")
    updated = update_from(register, verified, "pk", {"wine_key": "match"})
    return updated.withColumn("wine", slice_text(F.col("wine_key"), 6))


def vintages_agree(register: DataFrame) -> DataFrame:
    """One row: whether every key begins with the row's vintage."""
    written = slice_text(F.col("wine_key"), 1, 4).cast("int")
    return all_true(register, written == F.col("vintage"), "all_vintages_equal")


def correct(df: DataFrame, where: Column, column: str, value) -> DataFrame:
    """Set a column on the rows that satisfy a condition; adds the column if it is missing."""
    value = value if isinstance(value, Column) else F.lit(value)
    current = F.col(column) if column in df.columns else F.lit(None)
    return df.withColumn(column, F.when(where, value).otherwise(current))


def correct_from(df: DataFrame, corrections: DataFrame, key: str, column: str) -> DataFrame:
    """``correct`` for many rows: a table of keys and values."""
    return update_from(df, corrections, key, {column: column})


def match_report(register: DataFrame, matches: DataFrame) -> DataFrame:
    """Row counts before and after: total, verified, not verified."""
    total = labelled_values(register, {"register": F.count("*")})
    kinds = {"verified": F.count_if("verified"), "not verified": F.count_if(~F.col("verified"))}
    return total.unionByName(labelled_values(matches, kinds))


def reconcile(raw: DataFrame, catalogue: DataFrame, min_score: int = VERIFIED_ABOVE + 1) -> tuple[DataFrame, DataFrame]:
    """(corrected register, matches).

    The numbered register and the matches, by their key, are written once to shared storage: names are scored once,
    whatever is read from the two results, and a lost executor repeats neither numbering nor scoring.
    """
    register = staged(stage_register(raw), "register")
    matches = staged(match_names(register, catalogue, min_score), "matches")
    return apply_matches(register, matches), matches


def export_register(register: DataFrame, path: str, overwrite: bool = False) -> None:
    write_parquet(register, path, EXPORT_COLUMNS, overwrite)
