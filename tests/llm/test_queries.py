"""Every numbered query with SQL against it, and the pipeline's stages, on small given tables."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.fixtures import documents, none
from tracehouse.llm.oracle import ORACLE
from tracehouse.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LABELLED = "/root/testdata/sf0.01"  # enough labels to learn from


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    expected = con.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    rows = QUERIES[name](spark, SMALL).select(*columns).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, expected.fetchall()))


def test_numbers():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs = documents(spark)
    columns = docs.columns
    kept = docs
    for name, step in corpus_pipeline.STAGES[1:4]:
        kept = step(spark, kept, SMALL)
        assert kept.columns == columns
        path = str(tmp_path / name)
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
        if name == "near_duplicates":
            ids = [r["doc_id"] for r in kept.collect()]
            assert not {13, 14, 15, 16} & set(ids) and 12 in ids and None in ids
            # the repeated id with another text keeps both, the repeated row one
            assert ids.count(3) == 2 and ids.count(12) == 1
    coded = corpus_pipeline.token_ids(spark, kept, SMALL)
    assert coded.count() == kept.count()
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, none(spark), SMALL).count() == 0


def test_quality_stage_keeps_good_texts(spark):
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet")
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    kept = corpus_pipeline.quality(spark, docs, LABELLED).select("doc_id").withColumn("kept", F.lit(1))
    shares = labels.join(kept, "doc_id", "left").groupBy("quality").agg(F.count("kept") / F.count("*")).collect()
    share = {r[0]: r[1] for r in shares}
    assert share[1] >= 0.97 and share[0] <= 0.1


def test_near_duplicates_of_repeated_ids_lose_no_text(spark):
    words = [f"w{i}" for i in range(400)]
    one, two, three = (" ".join(words[a : a + 60]) for a in (0, 100, 200))
    near = one + " more"
    rows = [(1, one, "b"), (2, two, "x"), (2, near, "x"), (3, three, "x"), (3, three, "a"), (3, near, "x"), (4, None, "n"),
            (5, "", "n"), (None, one, "n"), (4, "another text of four words and many more of them", "n")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs.withColumn("row", F.lit(0)), SMALL)
    assert kept.columns == [*docs.columns, "row"]
    found = sorted(((r["doc_id"], r["text"], r["source"]) for r in kept.collect()), key=str)
    expected = [rows[0], rows[1], rows[4], *rows[6:]]
    assert found == sorted(expected, key=str)
