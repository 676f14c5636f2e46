"""A corpus pipeline of five stages; each reads what the one before has written.

Quality classifier, near duplicates, secrets, mixing, token ids. Every stage takes (spark, docs, sf_dir), works on all
rows of ``docs`` and returns a DataFrame with the columns of ``documents``; the last one returns the corpus as ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracehouse.functions.columns import free_name
from tracehouse.llm import line_crf
from tracehouse.llm.bpe import encode_decode
from tracehouse.llm.common import Stage, crc_of_id, read_table
from tracehouse.llm.mixing import mix_sources
from tracehouse.llm.near_duplicates import group_near_duplicates
from tracehouse.llm.secret_scan import redacted

KEEP_FROM = 0.3  # quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose quality the classifier, learned from the labels of all but a held-out fifth, puts at 0.3 or more.

    Null and empty texts have a score like others; repeated rows and null ids are scored alike, by text alone. Texts are
    read whole. An empty table gives no rows. Columns of any names are kept.
    """
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    field = line_crf.learn_quality(docs, labels.where(~line_crf.held_out(crc_of_id(F.col("doc_id")))))
    score = free_name(docs.columns, "score")
    scored = line_crf.score_quality(docs, field, into=score)
    return scored.where(F.col(score) >= KEEP_FROM).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group of near duplicates: that with the smallest id, then hash.

    A text is told by its id and contents, so different texts under one id are kept or dropped each for itself. Rows that
    repeat both are kept once, the smallest by all columns. Rows without an id stay, and so do texts without words; an
    empty table gives no rows.
    """
    row, known = free_name(docs.columns, "row"), F.col("doc_id").isNotNull()
    own = docs.withColumn(row, F.when(known, F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.col("text").isNull())))
    grouped = group_near_duplicates(own.where(known).select(F.col(row).alias("doc_id"), "text"))
    texts = grouped.select(F.col("doc_id").alias("row"), "component_id").distinct()
    ids = own.where(known).select(F.col(row).alias("row"), "doc_id").distinct()
    first = texts.join(ids, "row").groupBy("component_id").agg(F.min(F.struct("doc_id", "row"))["row"].alias("kept"))
    dropped = texts.join(first, "component_id").where("row != kept").select("row", F.lit(True).alias("dropped"))
    # one small table tells the rows that go and those that repeat an id and its text, so texts meet it once
    counts = own.where(known).groupBy(F.col(row).alias("row")).count().where("count > 1")
    again = counts.select("row", F.lit(None).cast("boolean").alias("dropped"))
    told = dropped.unionByName(again).groupBy(F.col("row").alias(row)).agg(F.bool_or("dropped").alias("dropped"))
    fate = free_name([*docs.columns, row], "fate")
    left = own.join(told.select(row, F.struct("dropped").alias(fate)), row, "left").where(F.col(fate)["dropped"].isNull())
    once = left.where(F.col(fate).isNull()).select(*docs.columns)
    repeated = left.where(F.col(fate).isNotNull())
    smallest = repeated.groupBy(row).agg(F.min(F.struct(*docs.columns)).alias("d"))
    return once.unionByName(smallest.select("d.*"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All texts, with their secrets replaced by a mark and their lengths counted anew.

    Null texts stay null, with a null length; rows are independent of each other, so repeated ones come out alike.
    """
    clean = redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as often as the mix takes them: a text taken twice is two equal rows, one not taken none.

    Null and empty texts have no words and are taken as the mix takes other texts of no size; a null source is a source.
    """
    body, copy = free_name(docs.columns, "body"), free_name(docs.columns, "copy")
    mixed = mix_sources(docs.withColumn(body, F.col("text")), text=body)
    return mixed.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, their number, and a digest of what they decode to; a null text is encoded as the empty one."""
    coded = encode_decode(docs.select("doc_id", "source", "lang", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        "source",
        "lang",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

# The stages learn, hash and sample: no SQL gives their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
