import datetime as dt

import pytest
from pyspark.sql import functions as F

from tracehouse.functions import text
from tracehouse.operators import keys
from tracehouse.operators.quality import QualityError, validate
from tracehouse.plans.runs import stage_runs
from tracehouse.schemas import TABLES


def _apply(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r["out"] for r in df.withColumn("out", function(F.col("v"))).orderBy("i").collect()]


def test_quote_order_decides_an_edge_blank(spark):
    values = ["' Foo\"", "  Château d'Or ", None]
    assert _apply(spark, text.normalise_name, values) == ["foo", "chateau dor", None]
    assert _apply(spark, lambda c: text.normalise_name(c, "trim_first"), values) == [" foo", "chateau dor", None]
    with pytest.raises(ValueError):
        text.normalise_name(F.col("v"), "other")


def test_accents(spark):
    values = ["éèŰẹ́", "é", "øßłæ", "plain"]
    assert _apply(spark, text.strip_accents, values) == ["eeUe", "e", "øßłæ", "plain"]


def test_html_entities_resolve_once(spark):
    values = ["a &amp; b", "&amp;copy;", "&eacute;&#39;&#x41;", "&am", "&copy2", None]
    assert _apply(spark, text.html_unescape, values) == ["a & b", "&copy;", "é'A", "&am", "©2", None]


@pytest.mark.parametrize(
    "bounds,want",
    [((1, 1), "a"), ((-1, -1), "f"), ((2, 3), "bc"), ((11, 11), ""), ((-8, -1), "abcdef"), ((-19, -10), ""),
     ((3, None), "cdef"), ((0, 4), "abcd"), ((5, 2), "")],
)
def test_slices(spark, bounds, want):
    assert _apply(spark, lambda c: text.slice_text(c, *bounds), ["abcdef"]) == [want]


def test_concat_skips_nulls_and_flags(spark):
    df = spark.createDataFrame([("y", None), ("n", "x"), (None, "z"), ("true", "q")], "a string, b string")
    rows = df.select(text.concat_skip_null(["a", "b"]).alias("c"), text.flag_from_text(F.col("a")).alias("f")).collect()
    assert [(r["c"], r["f"]) for r in rows] == [("y", True), ("nx", False), ("z", False), ("trueq", True)]
    assert _apply(spark, text.vintage_or_default, ["2018", "null", None]) == [2018, 9999, 9999]


def test_paths(spark):
    values = ["/lib/1.D/extract_x/data.parquet"]
    assert _apply(spark, text.parent_dir, values) == ["/lib/1.D/extract_x"]
    assert _apply(spark, text.file_stem, values) == ["data"]


def test_key_remap_rules(spark):
    # the padded rule comes before the listed codes, and also takes '02_2' to '2_'
    values = ["0171", "0172", "0173", "02_2", "116", "z3", "mt-diff-bannock-pn", "hey-malbec_02-21", "99", None]
    want = ["17", "17", "0173", "2_", "sigurdcb", "00", "mt-diff-bannockburn-pn", "75", "99", None]
    assert _apply(spark, keys.remap_key, values) == want


def _dated(spark, rows):
    return spark.createDataFrame(rows, "notebook string, date string")


def test_uniquify_by_time_and_by_text(spark):
    rows = [("02", "04-Apr-23, 10:00:00"), ("02", "15-Feb-23, 10:00:00"), ("3", "1-Mar-23, 09:00:00")]
    by_time = {(r["date"][:6], r["notebook"]) for r in keys.uniquify_keys(_dated(spark, rows), "notebook", "date").collect()}
    assert by_time == {("15-Feb", "02"), ("04-Apr", "02_2"), ("1-Mar-", "3")}
    as_text = keys.uniquify_keys(_dated(spark, rows), "notebook", "date", order="text").collect()
    assert {(r["date"][:6], r["notebook"]) for r in as_text} == {("15-Feb", "02_2"), ("04-Apr", "02"), ("1-Mar-", "3")}


def test_hot_key_is_uniquified_alike(spark):
    rows = [("k", f"{1 + i % 28}-Mar-23, {i // 28:02d}:00:00") for i in range(300)] + [("j", "1-Mar-23, 09:00:00")] * 2
    df = _dated(spark, rows)
    for order in ("time", "text"):
        plain = keys.uniquify_keys(df, "notebook", "date", order=order)
        sliced = keys.uniquify_keys(df, "notebook", "date", order=order, rows_per_task=20)
        assert sorted(map(str, plain.collect())) == sorted(map(str, sliced.collect()))


def test_sequence_names(spark):
    names = ["wines_2023-04-04_12-01-53", "2023-03-15_11:33:51", "singlesample"]
    times = [dt.datetime(2023, 4, 4, 12, 1, 53), dt.datetime(2023, 3, 15, 11, 33, 51), None]
    assert _apply(spark, keys.sequence_time, names) == times
    assert _apply(spark, keys.repair_sequence_name, ["wines_2023-03-15_11-33-51"]) == ["2023-03-15_11:33:51"]
    assert _apply(spark, keys.acquisition_time, ["4-Apr-23, 01:02:03"]) == [dt.datetime(2023, 4, 4, 1, 2, 3)]


def test_tied_dates_fail_the_primary_key(spark):
    row = ("02", "04-Apr-23, 10:00:00", "m", "1", "singlesample", "d", "v", "f", "id1", "x", "/p")
    columns = ["notebook", "date", "method", "injection_volume", "seq_name", "seq_desc", "vialnum",
               "originalfilepath", "id", "desc", "path"]
    staged = stage_runs(spark.createDataFrame([row, row[:8] + ("id2", "x", "/q")], columns))
    with pytest.raises(QualityError, match='primary key.*"ch_runid":"02"'):
        validate(staged, TABLES["chm_loading"])


def test_surrogate_key_is_dense_and_repeatable(spark):
    df = spark.range(500).select(((F.col("id") * 7919) % 500).alias("k"))
    for limit in (10_000, 20):
        rows = keys.surrogate_key(df, "k", rows_per_task=limit).collect()
        assert {(r["pk"], r["k"]) for r in rows} == {(i + 1, i) for i in range(500)}


def test_local_time_ignores_the_session_zone(spark):
    from tracehouse.functions.times import local_micros

    # 2023-03-12 02:30 does not exist in New York, yet lies between its neighbours
    times = ["2023-03-12 01:59:59.5", "2023-03-12 02:30:00", "2023-03-12 03:00:00.000001"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = _apply(spark, lambda c: local_micros(c.cast("timestamp_ntz")), times)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    start = int(dt.datetime(2023, 3, 12, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert [g - start for g in got] == [7_199_500_000, 9_000_000_000, 10_800_000_001]
