"""The numbered queries over the driver's tables, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracehouse.llm import language, line_crf, merge_replay
from tracehouse.llm.bpe import encode_decode
from tracehouse.llm.common import crc_of_id, read_table
from tracehouse.llm.embedding_groups import group_embeddings
from tracehouse.llm.hard_negatives import mine_negatives
from tracehouse.llm.line_quality import line_quality
from tracehouse.llm.mixing import mix_sources
from tracehouse.llm.near_duplicates import group_near_duplicates
from tracehouse.llm.periodic_runs import periodic_runs, planted, run_lines
from tracehouse.llm.secret_scan import base_spans, count_kind, scan, written
from tracehouse.llm.substrings import remove_repeats
from tracehouse.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MAX_TOKENS = 1024
PREDICT_FROM = 0.3


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@_query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"),
    )


@_query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return group_near_duplicates(docs, shingle=2)


@_query
def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


@_query
def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@_query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.held_out(crc_of_id(F.col("doc_id")))
    profiles = language.learn_profiles(docs.where(~out))
    predicted = language.predict_language(docs.select("doc_id", "text"), profiles)
    return predicted.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@_query
def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@_query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs).select(
        "doc_id",
        *[count_kind("spans", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(written(base_spans("spans")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


@_query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mix_sources(docs)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


@_query
def op9_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return group_embeddings(vectors)[0]


@_query
def op10_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_crf.held_out(crc_of_id(F.col("doc_id")))
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = line_crf.score_quality(docs, line_crf.learn_quality(docs, labels.where(~out)))
    return scored.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted")
    )


@_query
def op11_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = merge_replay.encode_decode(docs, ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic_runs(planted(docs, number))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(run_lines(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)
