import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from tracehouse.functions.columns import named
from tracehouse.operators import keys, program, traces
from tracehouse.operators.skew import global_positions, hot_keys, positions, range_placed

FIELDS = ["idx", "prev", "n", "first", "last", "rank"]


def flat(df, *args, **kwargs):
    """Rows with the fields of their place as columns."""
    numbered, at = positions(df, *args, **kwargs)
    return numbered.select(*map(named, df.columns), *[at[f].alias(f"at_{f}") for f in FIELDS])


def most_together(df, order, limit):
    """Rows of the hot keys, and of the largest task that they are dealt to."""
    few, rows, bound = hot_keys(df, ["k"], limit)
    hot = df.join(few, df["k"].eqNullSafe(few["k"]), "left_semi")
    assert hot.count() == rows and bound == limit
    placed, place = range_placed(hot, ["k", *order], rows, bound)
    return placed.groupBy(F.col(place)["part"]).count().agg(F.max("count")).first()[0]


def _rows(kind):
    rng = random.Random(3)
    rows = []
    for key, n in (("hot", 900), ("warm", 120), ("cold", 30), (None, 10)):
        for i in range(n):
            t = i * 0.5 if i % 3 else 1000 + i * 1e-6  # a third of the key sits in one burst
            if kind == "text":
                t = f"same-long-prefix-{rng.randrange(10**6):07d}"
            elif kind == "ts":
                t = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t)
            rows.append((key, t, i))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("kind,type_", [("num", "double"), ("text", "string"), ("ts", "timestamp_ntz")])
def test_sliced_numbering_equals_the_plain_window(spark, kind, type_):
    df = spark.createDataFrame(_rows(kind), f"k string, t {type_}, i int")
    plain = flat(df, "k", ["t", "i"], dense=True)
    sliced = flat(df, "k", ["t", "i"], dense=True, rows_per_task=40)
    left = sorted(map(str, plain.collect()))
    assert left == sorted(map(str, sliced.collect()))


def test_slices_stay_bounded_under_a_burst(spark):
    df = spark.createDataFrame(_rows("num"), "k string, t double, i int")
    assert most_together(df, ["t"], 40) <= 40


def test_one_shuffle_of_the_rows_when_nothing_is_hot(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    plan = positions(df, "k", "t")[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Window") == 1


def _cases(kind):
    rng = random.Random(len(kind))
    day = dt.date(2024, 1, 1)
    make = {
        "date": lambda i: day + dt.timedelta(days=i % 90),
        "decimal(12,3)": lambda i: decimal.Decimal(i % 400) / 8,
        "double": lambda i: float("nan") if i % 7 == 0 else (i % 300) * 0.25 - 9,
        "boolean": lambda i: i % 3 == 0,
        "binary": lambda i: bytes([7, 7, 7, i % 5, i % 256]),
        "string": lambda i: f"prefix-{i % 37:04d}é",
        "timestamp": lambda i: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=i % 50),
        "int": lambda i: 5,
    }[kind]
    rows = [("hot", None if i % 4 == 1 else make(i), rng.randrange(3), i) for i in range(700)]
    rows += [("null", None, i % 3, i) for i in range(200)] + [("cold", make(i), 0, i) for i in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("kind", ["date", "decimal(12,3)", "double", "boolean", "binary", "string", "timestamp", "int"])
def test_nulls_ties_and_types_give_one_answer_at_every_size(spark, kind):
    df = spark.createDataFrame(_cases(kind), f"k string, t {kind}, u int, i int")
    plain = flat(df, "k", ["t", "u", "i"], dense=True)
    sliced = flat(df, "k", ["t", "u", "i"], dense=True, rows_per_task=40)
    assert sorted(map(str, plain.collect())) == sorted(map(str, sliced.collect()))
    assert most_together(df, ["t", "u", "i"], 40) <= 40


def test_unordered_types_fail_at_every_size(spark):
    df = spark.createDataFrame([("a", [1])], "k string, t array<int>")
    with pytest.raises(TypeError):
        positions(df, "k", "t")


def test_a_known_count_starts_no_job(spark):
    df = spark.range(100).select(F.raise_error(F.lit("was read")).cast("int").alias("k"), F.col("id").alias("t"))
    positions(df, "k", "t", most_rows=1000)


OWN = ["n", "first", "last", "prev", "idx", "rank", "position", "place", "part", "own", "number"]


def _clashing(spark):
    """A key called n, and columns called like everything that is computed."""
    rng = random.Random(11)
    rows = [("hot", i, *(f"{c}{i}" for c in OWN[1:])) for i in range(300)]
    rows += [("cold", i, *(f"{c}-{i}" for c in OWN[1:])) for i in range(9)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "n string, t long, " + ", ".join(f"`{c}` string" for c in OWN[1:])), rows


@pytest.mark.parametrize("limit", [10_000, 40])
def test_columns_keep_their_data_whatever_their_names(spark, limit):
    df, rows = _clashing(spark)
    numbered, at = positions(df, "n", "t", dense=True, rows_per_task=limit)
    got = numbered.select(*df.columns, at["idx"].alias("i"), at["n"].alias("size")).collect()
    assert sorted(tuple(r)[:-2] for r in got) == sorted(rows)
    assert all(r["i"] == r["t"] and r["size"] == (300 if r["n"] == "hot" else 9) for r in got)
    whole, number = global_positions(df, ["n", "t"], rows_per_task=limit)
    got = whole.select(*df.columns, number.alias("i")).orderBy("i").collect()
    assert [tuple(r)[:-1] for r in got] == sorted(rows) and [r["i"] for r in got] == list(range(len(rows)))


@pytest.mark.parametrize("limit", [10_000, 40])
def test_callers_keep_columns_whatever_their_names(spark, limit):
    df, rows = _clashing(spark)
    by_key = {(r[0], r[1]): r for r in rows}

    trimmed = traces.trim_rows(df, "n", 5, "t", rows_per_task=limit)
    assert trimmed.columns == df.columns
    assert sorted(map(tuple, trimmed.collect())) == sorted(r for r in rows if r[1] < 5)

    regridded = traces.regrid_time(df.withColumn("t", F.col("t") * 2), "n", "t", rows_per_task=limit)
    assert {tuple(r) for r in regridded.collect()} == {(k, 2.0 * t, *r[2:]) for (k, t), r in by_key.items()}
    with pytest.raises(ValueError, match="idx"):
        traces.regrid_time(df, "n", "t", keep_idx=True, rows_per_task=limit)

    stats = traces.signal_stats(df.withColumn("value", F.col("t") * 1.0), "n", "t", "value", rows_per_task=limit)
    assert {(r["n"], r["mins_count"], r["abs_argmax"]) for r in stats.collect()} == {("hot", 300, 299), ("cold", 9, 8)}

    dated = df.withColumn("when", F.col("first"))
    unique = keys.uniquify_keys(dated, "n", "t", rows_per_task=limit).collect()
    assert {(r["n"], *r[1:]) for r in unique} == {
        (f"{k}_{t + 1}" if t else k, t, *r[2:], r[2]) for (k, t), r in by_key.items()
    }

    numbered = keys.surrogate_key(df, ["n", "t"], rows_per_task=limit).orderBy("pk").collect()
    assert [tuple(r) for r in numbered] == [(i + 1, *r) for i, r in enumerate(sorted(rows))]
    with pytest.raises(ValueError, match="first"):
        keys.surrogate_key(df, ["n", "t"], "first")

    wide = df.select("n", F.col("t").cast("double").alias("mins"), (F.col("t") * 2.0).alias("256"))
    meta = df.groupBy("n").agg(F.min("first").alias("first"), F.min("idx").alias("prev"))
    cells = traces.cube(wide, meta, key="n", rows=4, rows_per_task=limit).collect()
    assert sorted((r["n"], r["idx"], r["absorbance"], r["first"]) for r in cells) == sorted(
        (k, i, 2.0 * i, min(r[2] for (q, _), r in by_key.items() if q == k)) for k in ("hot", "cold") for i in range(4)
    )


def test_equal_rows_and_keys_are_numbered_alike_by_every_run(spark):
    rows = [(i % 3, i % 5) for i in range(300)] + [(1, 1)] * 200
    df = spark.createDataFrame(rows, "k int, v int")
    runs = [
        keys.surrogate_key(df.repartition(parts), "k", rows_per_task=limit).orderBy("pk").collect()
        for parts, limit in ((3, 10_000), (7, 10_000), (5, 50), (2, 20))
    ]
    assert runs[0] == runs[1] == runs[2] == runs[3]
    assert [r["pk"] for r in runs[0]] == list(range(1, 501))


def test_empty_tables_are_numbered(spark):
    df = spark.createDataFrame([], "k string, t int")
    assert flat(df, "k", "t", dense=True).count() == 0
    assert keys.surrogate_key(df, "k").count() == 0


def test_numbered_program_starts_no_job_and_counts_when_asked(spark):
    failing = spark.range(3).select(
        F.raise_error(F.lit("was read")).cast("int").alias("num"), F.col("id").alias("time"), F.lit(1).alias("a"), F.lit(2).alias("b")
    )
    start = spark.createDataFrame([(1, "A", 5.0)], "num int, channel string, percent double")
    program.numbered_elution_table(failing, start)
    steps = spark.createDataFrame([(1, t, t, None) for t in range(1, 9)], "num int, time int, a int, b int")
    rows = [(1, 0.0, 5.0, None, 1)] + [(1, float(t), float(t), None, t + 1) for t in range(1, 9)]
    for most in (100, None):
        found = program.numbered_elution_table(steps.union(steps), start, most_steps=most)
        assert sorted(map(tuple, found.collect())) == rows
    with pytest.raises(Exception, match="more than 4 steps in program 1"):
        program.numbered_elution_table(steps, start, most_steps=4).collect()


def test_a_cluster_has_to_name_its_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from tracehouse.session import shared_folder

    unset = SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))
    context = SimpleNamespace(master="spark://host", _jsc=SimpleNamespace(sc=lambda: unset))
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(session)
