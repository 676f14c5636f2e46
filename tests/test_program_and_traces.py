import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracehouse.operators import exclusion, program, reports, reshape, traces
from tracehouse.operators.quality import QualityError, require_rows, validate
from tracehouse.schemas import TABLES
from tracehouse.sources.tables import landed_image, merge_metadata


def _set(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture(scope="module")
def steps(spark):
    rows = [("1", i, t, a, b, 1.0, 700.0) for i, (t, a, b) in enumerate([(38.0, 0.0, 100.0), (40.0, None, 100.0)])]
    return spark.createDataFrame(rows, "runid string, idx int, mins float, a float, b float, flow float, pressure float")


def test_program_normal_forms(spark, steps):
    composition = spark.createDataFrame(
        [("1", "A", "water", 95.0), ("1", "B", "methanol", 5.0)], "runid string, channel string, ch1_solv string, percent float"
    )
    assert _set(program.channels(steps)) == {("1", 38.0, "a", 0.0), ("1", 38.0, "b", 100.0), ("1", 40.0, "b", 100.0)}
    assert _set(program.solvents(composition)) == {("1", "water", "methanol")}
    whole = program.solvent_program(steps, composition)
    assert whole.count() == 5 and ("1", 0.0, "b", 5.0) in _set(whole)
    assert _set(program.run_gradients(whole)) == {("1", 2.5)}
    wide = program.numbered_elution_table(steps, composition, "runid", "mins")
    assert _set(wide) == {("1", 0.0, 95.0, 5.0, 1), ("1", 38.0, 0.0, 100.0, 2), ("1", 40.0, None, 100.0, 3)}
    with pytest.raises(QualityError, match="empty"):
        program.run_gradients(whole.where("false"))


def test_equal_zero_rows_merge_and_others_fail(spark):
    steps = spark.createDataFrame([("1", 0.0, 95.0, 5.0)], "runid string, mins double, a double, b double")
    start = spark.createDataFrame([("1", "A", 95.0), ("1", "B", 6.0)], "runid string, channel string, percent double")
    whole = program.solvent_program(steps, start)
    assert whole.where("channel = 'a'").count() == 1
    with pytest.raises(QualityError, match="primary key"):
        validate(whole, TABLES["solvprop_over_mins"])


def test_varying_flow_is_reported(spark, steps):
    varied = steps.withColumn("flow", F.col("mins"))
    with pytest.raises(QualityError, match='bin_pump_mech_params.*"runid":"1"'):
        validate(program.mechanical_params(varied), TABLES["bin_pump_mech_params"])


def test_gradient_divides_by_the_second_time(spark):
    points = spark.createDataFrame(
        [("a", 10.0, 0.0), ("a", 20.0, 40.0), ("a", 30.0, 0.0), ("b", 1.0, 1.0), ("c", -5.0, 1.0), ("c", 0.0, 2.0)],
        "runid string, mins double, percent double",
    )
    assert _set(program.gradients(points)) == {("a", 2.0), ("c", None)}  # one point: none; at zero: null
    assert _set(program.gradients(points, method="slope")) == {("a", 4.0), ("c", 0.2)}
    with pytest.raises(ValueError):
        program.gradients(points, method="other")
    plan = program.gradients(points)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_excluded_runs(spark):
    gradients = spark.createDataFrame([("1", 2.5), ("2", 3.0), ("3", None), ("4", 3.1)], "runid string, gradient double")
    runs = gradients.select("runid")
    listed = exclusion.manual_rule(runs, [{}, {"runid": "4", "reason": "by hand"}, {"runid": "9", "reason": "unknown"}])
    excluded = exclusion.combine_rules([listed, exclusion.gradient_rule(gradients)])
    assert _set(excluded) == {("2", exclusion.GRADIENT_REASON), ("4", "by hand")}
    assert _set(exclusion.without(runs, excluded)) == {("1",), ("3",)}  # no gradient: stays
    assert exclusion.manual_rule(runs, []).count() == 0


def _trace(spark, seed=1):
    rng = random.Random(seed)
    rows = [(k, t, float(rng.randrange(-5, 5))) for k, n in (("a", 200), ("b", 50)) for t in np.cumsum([rng.uniform(0.1, 2) for _ in range(n)])]
    rows += [("one", 3.0, 7.0)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame([(k, float(t), v) for k, t, v in rows], "runid string, mins double, value double")


@pytest.mark.parametrize("limit", [10_000, 15])
def test_signal_statistics_and_grid_equal_numpy(spark, limit):
    rows, df = _trace(spark)
    stats = {r["runid"]: r for r in traces.signal_stats(df, "runid", "mins", "value", rows_per_task=limit).collect()}
    even = {}
    for r in traces.regrid_time(df, "runid", keep_idx=True, rows_per_task=limit).collect():
        even.setdefault(r["runid"], {})[r["idx"]] = r["mins"]
    for key in ("a", "b"):
        own = sorted((t, v) for k, t, v in rows if k == key)
        times, values = np.array([t for t, _ in own]), np.array([v for _, v in own])
        got = stats[key]
        assert (got["abs_argmin"], got["abs_argmax"]) == (values.argmin(), values.argmax())  # first on ties
        assert (got["mins_count"], got["mins_min"], got["mins_max"]) == (len(own), times.min(), times.max())
        assert got["hertz"] == pytest.approx(round(float(np.mean(1 / (60 * np.diff(times)))), 2), abs=0.0051)
        step = np.round(np.mean(np.diff(times)), 9)
        want = np.arange(0, times.max() + step, step)[: len(own)]
        assert np.abs(np.array([even[key][i] for i in range(len(own))]) - want).max() < 1e-9
    assert stats["one"]["hertz"] is None and even["one"][0] is None


def test_null_values_keep_their_place(spark):
    df = spark.createDataFrame([("a", 0.0, None), ("a", 1.0, 5.0), ("a", 2.0, 1.0), ("a", 2.0, 1.0)], "k string, t double, v double")
    row = traces.signal_stats(df, "k", "t", "v").first()
    assert (row["abs_argmin"], row["abs_argmax"], row["mins_count"]) == (2, 1, 4)


def test_grid_that_is_too_short_fails(spark):
    df = spark.createDataFrame([("a", float(t)) for t in range(-10, 0)], "runid string, mins double")
    with pytest.raises(Exception, match="grid too short for runid a"):
        traces.regrid_time(df, "runid").collect()


def test_trimming(spark):
    _, df = _trace(spark)
    assert traces.trim_rows(df, "runid", 30, short="keep").groupBy("runid").count().where("runid != 'one'").agg(F.max("count")).first()[0] == 30
    with pytest.raises(Exception, match="runid one has 1 rows, expected 30"):
        traces.trim_rows(df, "runid", 30).collect()
    with pytest.raises(ValueError):
        traces.trim_rows(df, "runid", 30, short="pad")


def test_images(spark, tmp_path):
    wide = spark.createDataFrame([("r", 0.5, 1.0, 2.0, 3.0), ("r", 1.5, 4.0, 5.0, 6.0)], ["id", "mins", "1000", "256", "99.5"])
    assert traces.image_columns(wide) == ["99.5", "256", "1000"]
    long = traces.wide_to_long(wide, ["id", "mins"])
    assert ("r", 0.5, 256, 2.0) in _set(long) and long.count() == 6
    assert [list(r["absorbance"]) for r in traces.wide_to_array(wide, ["id", "mins"]).orderBy("mins").collect()] == [[3.0, 2.0, 1.0], [6.0, 5.0, 4.0]]
    assert _set(traces.column_sums(wide, "id")) == {("r", 9.0, 7.0, 5.0)}
    landed = landed_image(wide.withColumn("mins", F.col("mins") + 3), "id")
    assert landed.columns == ["id", "mins", "99.5", "256", "1000"]
    assert sorted(r["mins"] for r in landed.collect()) == [0.0, 1.0]
    stats = traces.image_stats(wide).first()
    assert (stats["nm_min"], stats["nm_max"], stats["nm_count"], stats["n_wavelengths"]) == (99, 1000, 5, 3)
    wide.write.parquet(str(tmp_path / "image"))
    stats = traces.image_stats(spark.read.parquet(str(tmp_path / "image")))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,mins:double,256:double>" in plan


def test_metadata_merge(spark):
    detector = spark.createDataFrame([("g", "DAD", "mAU", "old")], ["id", "Detector Name", "unit", "Notebook"])
    run = spark.createDataFrame([("g", "13", "Agilent")], ["id", "Notebook", "vendor"])
    merged = merge_metadata(detector, run, "id")
    assert merged.columns == ["id", "detector_name", "notebook"] and merged.first()["notebook"] == "13"


def test_reports(spark):
    df = spark.createDataFrame([(90,), (95,), (95,), (40,)], "score int")
    assert _set(reports.percent_of_total(df, "score", F.col("score") > 50)) == {(90, 25.0), (95, 50.0)}
    assert _set(reports.histogram(df, "score", 50)) == {(0.0, 1), (50.0, 3)}
    assert _set(reshape.labelled_values(df, {"n": F.count("*"), "high": F.count_if(F.col("score") > 90)})) == {("n", 4.0), ("high", 2.0)}
    assert _set(reshape.distinct_counts(df)) == {(3,)} == _set(reshape.distinct_counts(df, approximate=True))
    assert require_rows(df, "scores") is df


def test_distinct_counts_read_rows_once(spark, monkeypatch):
    """Nulls, both zeros, nan, dates and clashing names; no row is copied for a column."""
    import datetime as dt

    day = dt.date(2024, 1, 1)
    rows = [(i % 7 or None, [0.0, -0.0, 1.5, float("nan")][i % 4], day + dt.timedelta(days=i % 3), "x") for i in range(500)]
    df = spark.createDataFrame(rows, "place long, value double, `c0` date, `a.b` string").repartition(5)
    found = reshape.distinct_counts(df)
    assert tuple(found.first()) == (6, 3, 3, 1) and found.columns == df.columns
    plan = found._jdf.queryExecution().toString()
    assert "Expand" not in plan and plan.count("Generate") == 0
    assert tuple(reshape.distinct_counts(df.limit(0)).first()) == (0, 0, 0, 0)


def test_sketches_of_parts_merge(spark, tmp_path):
    from tracehouse.schemas import Table
    from tracehouse.sources import sinks

    table = lambda n: Table(n, "k bigint,v double,t string")
    df = spark.range(60_000).selectExpr("id % 20011 AS k", "(id % 1000) / 8 AS v", "CAST(id % 3 AS string) AS t")
    for name, part in (("one", df.where("k % 3 > 0")), ("two", df.where("k % 3 < 2")), ("none", df.limit(0))):
        sinks.write_table(part, table(name), str(tmp_path), sketched=["k", "v", "t"])
    found = reshape.estimated_counts(sinks.read_sketches(spark, ["one", "two", "none"], str(tmp_path)))
    counts = {r["column"]: r["distinct"] for r in found.collect()}
    for column, exact in (("k", 20011), ("v", 1000), ("t", 3)):
        assert abs(counts[column] - exact) <= 0.03 * exact
    again = sinks.write_table(df, table("one"), str(tmp_path), overwrite=True, sketched=["t"])
    assert again.count() == 60_000


def test_saved_cube_opens_the_buckets_of_its_runs(spark, tmp_path):
    from uuid import uuid4

    from tracehouse.sources import sinks

    cells = spark.range(4_000).selectExpr("id % 40 AS runid", "id AS idx", "256 AS wavelength", "rand(1) AS absorbance")
    name = f"cube_{uuid4().hex}"
    saved = sinks.save_cube(cells, name, str(tmp_path / "cube"), buckets=8)
    runs = spark.range(40).selectExpr("id AS runid", "id * 2 AS other")
    slice_ = saved.where(F.col("runid").isin(3, 11)).join(runs.hint("shuffle_hash"), "runid")
    plan = slice_._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount" in plan and "SelectedBucketsCount: 8 out of 8" not in plan
    per_run = saved.groupBy("runid").agg(F.count("*").alias("n"))
    assert "Exchange" not in per_run._jdf.queryExecution().executedPlan().toString()
    assert slice_.count() == 200 and {r["n"] for r in per_run.collect()} == {100}
    with pytest.raises(Exception, match="exists"):
        sinks.save_cube(cells, name, str(tmp_path / "cube"), buckets=8)
    spark.sql(f"DROP TABLE {name}")


def test_wavelengths_with_fractions_stay_apart(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0, 2.0)], "runid string, mins double, `256.2` double, `256.4` double")
    rows = traces.wide_to_long(df, ["runid", "mins"]).collect()
    assert {(r["wavelength"], r["absorbance"]) for r in rows} == {(256.2, 1.0), (256.4, 2.0)}
