"""Small tables with the cases every operator has to define: nulls, empty and long texts, ties, repeats."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, note string"


def sentence(rng: random.Random, n: int, words: list[str]) -> str:
    return " ".join(rng.choice(words) for _ in range(n))


def texts(seed: int = 3) -> list[str | None]:
    """Distinct texts, exact and near copies, shared passages, and odd ones."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ba", "to", "ri", "nu", "qé", "ß") for b in ("x", "lo", "Mi", "s,", "t.", "ng", "ü")]
    passage = sentence(rng, 60, words)
    base = sentence(rng, 150, words)
    near = [base.split() for _ in range(4)]
    for k, copy in enumerate(near):
        copy[5 + 11 * k] = f"changed{k}"
    out: list[str | None] = [sentence(rng, rng.randint(1, 120), words) for _ in range(12)]
    out += [base, base, base.replace(" ", "\n", 3), *(" ".join(c) for c in near)]
    out += [f"{sentence(rng, 20, words)} {passage} {sentence(rng, 15, words)}" for _ in range(4)]
    out += [None, None, "", " \n\t ", "one", "ONE", "one two", "\x1cone\x1d two", "a b c", "  leading  and\t\tmixed \n \n blanks "]
    out += ["x" * 5000, sentence(rng, 20_000, words), "same line\nsame line\nother\nsame line"]
    out += ["<|endoftext|> special <|startoftext|>", "ΟΔΟΣ Σ é İ ǅ Ɤ ՘", "日本語 テキスト 12３ ½ 🙂👍🏽"]
    return out


def documents(spark: SparkSession, bodies: list[str | None] | None = None) -> DataFrame:
    """Rows with ascending ids, a repeated row, a repeated id with another text, and a null id."""
    bodies = texts() if bodies is None else bodies
    sources = ["s1", "s2", "s3", None]
    rows = [(i, t, "xy"[i % 2], sources[i % 4], len(t or ""), "n") for i, t in enumerate(bodies)]
    rows += [rows[12], (3, "another text of a repeated id", "x", "s1", 3, "n"), (None, bodies[12], None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
