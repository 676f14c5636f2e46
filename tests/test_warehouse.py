"""The whole build and serving, on a generated library."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.library import WAVELENGTHS, build_library
from tracehouse import build_warehouse, get_data
from tracehouse.operators.quality import QualityError
from tracehouse.plans.serve import fetch_images
from tracehouse.schemas import TABLES
from tracehouse.sources import sinks
from tracehouse.sources.tables import read_images, read_landed_images, require_same_schema, schema_kinds

EXCLUDED = [{}, {"runid": "54", "reason": "test"}, {"runid": "no such run", "reason": "ignored"},
            {"runid": "96", "reason": "listed too"}]


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    return build_library(tmp_path_factory.mktemp("lib"))


@pytest.fixture(scope="module")
def out(tmp_path_factory):
    return str(tmp_path_factory.mktemp("out") / "warehouse")


@pytest.fixture(scope="module")
def warehouse(spark, inputs, out):
    built = build_warehouse(spark, **inputs, out=out, excluded=EXCLUDED)
    built.register_views()
    return built


def _values(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def test_every_table_and_view_exists(spark, warehouse):
    names = {t.name for t in spark.catalog.listTables()}
    assert set(TABLES) - {"channels"} <= names
    assert {"st_not_in_ct", "gradients", "counts_per_gradient", "inc_chm", "inc_img_stats", "run_data_paths"} <= names


def test_tables_describe_themselves(warehouse):
    kinds = {(r["table"], r["column"]): r["type"] for r in warehouse.describe().collect()}
    assert kinds["st", "size"] == "float" and kinds["chm", "acq_date"] == "timestamp_ntz"


def test_catalogue_names_are_cleaned(warehouse):
    wines = _values(warehouse.table("ct"), "wine_key", "varietal")
    assert wines == [
        ("1001 four", "blend"), ("2018 chateau one", "shiraz"), ("2019 two & sons", "merlot"), ("2020 three", "malbec"),
    ]


def test_register_keeps_matched_raw_samples(warehouse):
    st = warehouse.table("st")
    assert _values(st, "samplecode", "added_to_cellartracker") == [
        ("13", True), ("54", False), ("61", False), ("89", True), ("96", True),
    ]
    assert {r["notes"] for r in st.collect()} == {"its"}
    assert _values(warehouse.table("st_not_in_ct"), "samplecode") == [("none",), ("null",)]


def test_runs_without_a_register_row_drop_out(warehouse):
    assert _values(warehouse.table("chm"), "runid") == [("13",), ("54",), ("61",), ("89",), ("96",)]
    assert [r["dt_run"].isoformat() for r in warehouse.table("sequences").collect()] == ["2023-04-04T12:01:53"]


def test_pump_tables_and_gradients(warehouse):
    gradients = {r["runid"]: r["gradient"] for r in warehouse.view("gradients").collect()}
    assert gradients["13"] == 2.5 and gradients["96"] == pytest.approx(95 / 30)
    counts = {round(r["gradient"], 3): r["count"] for r in warehouse.view("counts_per_gradient").collect()}
    assert counts == {2.5: 4, 3.167: 1}
    assert _values(warehouse.table("solvents").where("runid = '13'"), "a", "b") == [("solvent A", "solvent B")]
    assert warehouse.table("solvprop_over_mins").where("runid = '13'").count() == 10
    assert warehouse.table("bin_pump_mech_params").count() == 5


def test_image_statistics(warehouse):
    row = warehouse.table("image_stats").where("runid = '13'").first()
    assert (row["nm_min"], row["nm_max"], row["nm_count"], row["mins_count"]) == (254, 300, 5, 60)
    assert (row["abs_argmin"], row["abs_argmax"], row["abs_max"], row["abs_min"]) == (59, 20, 0, -78)
    assert row["hertz"] == 2.5


def test_exclusions_win_in_listed_order(warehouse):
    assert _values(warehouse.table("excluded"), "runid", "reason") == [("54", "test"), ("96", "listed too")]
    assert _values(warehouse.view("inc_chm"), "runid") == [("13",), ("61",), ("89",)]
    assert _values(warehouse.view("inc_img_stats"), "runid") == [("13",), ("61",), ("89",)]


def test_run_metadata_has_exactly_one_shiraz(warehouse):
    metadata = warehouse.view("sample_metadata")
    assert len(metadata.columns) == 19
    assert _values(metadata.where("varietal = 'shiraz'"), "runid", "wine") == [("13", "chateau one")]


def test_pairs_hold_the_same_runs(warehouse):
    images, metadata = get_data(warehouse, "pairs")
    runids = {r["runid"] for r in images.select("runid").distinct().collect()}
    assert runids == {r["runid"] for r in metadata.collect()} == {"13", "61", "89"}
    mins = [r["mins"] for r in images.where("runid = '13'").orderBy("mins").collect()]
    steps = [b - a for a, b in zip(mins, mins[1:])]
    assert mins[0] == 0 and max(steps) - min(steps) < 1e-12


def test_runids_filter_and_excluded_runs(warehouse):
    images, metadata = get_data(warehouse, "pairs", ["13", "54"])
    assert {r["runid"] for r in images.select("runid").distinct().collect()} == {"13"}
    assert [r["runid"] for r in metadata.collect()] == ["13"]
    files = [f for f in fetch_images(warehouse, ["13"]).inputFiles() if "/extract_" in f]
    assert len(files) == 1 and "013" in files[0]
    assert fetch_images(warehouse, ["54"]).count() == 0


@pytest.mark.parametrize("form,cells", [("array", 1), ("long", len(WAVELENGTHS))])
def test_cube_shape(warehouse, form, cells):
    cube = get_data(warehouse, "cube", rows=50, form=form)
    assert cube.count() == 3 * 50 * cells
    shiraz = cube.where("varietal = 'shiraz'")
    assert {r["runid"] for r in shiraz.select("runid").distinct().collect()} == {"13"}
    assert {"id", "runid", "idx", "mins"} <= set(cube.columns)
    if form == "array":
        row = shiraz.where("idx = 21").first()
        assert list(row["absorbance"]) == [-1.0, -2.0, -3.0]


def test_cube_of_one_wavelength_reads_one_column(warehouse):
    cube = get_data(warehouse, "cube", rows=50, form="long", wavelengths=["256"])
    assert {r["wavelength"] for r in cube.select("wavelength").distinct().collect()} == {256}
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert "256#" in plan and "300#" not in plan


@pytest.fixture(scope="module")
def landed(spark, warehouse, tmp_path_factory):
    """The same warehouse, its images landed run by run; among them a key that is not a number and one with a zero."""
    path = str(tmp_path_factory.mktemp("landed") / "lib")
    images = read_images(spark, warehouse.lib_dir).join(warehouse.table("chm").select("runid", "id"), "id")
    sinks.write_runs(images.select("runid", "id", "mins", *WAVELENGTHS), path)
    sinks.write_runs(images.where("runid = '13'").withColumn("runid", F.lit("013")).select("runid", "id", "mins", *WAVELENGTHS), path)
    return replace(warehouse, lib_dir=path, landed=True)


def test_landed_runs_serve_the_same(warehouse, landed):
    for form in ("long", "array"):
        ours, theirs = (get_data(w, "cube", rows=50, form=form) for w in (landed, warehouse))
        assert _values(ours, *theirs.columns) == _values(theirs, *theirs.columns)
    ours, theirs = (get_data(w, "pairs", ["13", "54", "61", "none"]) for w in (landed, warehouse))
    columns = ["runid", "id", "mins", *WAVELENGTHS]
    assert _values(ours[0], *columns) == _values(theirs[0], *columns) and ours[0].count() == 120
    assert _values(ours[1], *ours[1].columns) == _values(theirs[1], *ours[1].columns)
    assert fetch_images(landed, ["013"]).count() == 0  # landed, but not a run of the warehouse


def test_landed_runs_are_pruned_without_a_list_of_files(landed):
    listed = fetch_images(landed, ["13", "61"], ["256"])
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[runid#\d+ IN \(13,61\)", plan) and "dynamicpruningexpression(runid#" in plan
    assert "300#" not in plan


def test_missing_landed_images_are_named(spark, tmp_path):
    for wavelengths in (None, ["256"]):
        with pytest.raises(QualityError, match="no landed images"):
            read_landed_images(spark, str(tmp_path / "none"), wavelengths)


def test_schema_kinds(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 3.0)], "runid string, mins double, `256` double")
    sinks.write_runs(rows, path)
    sinks.write_runs(rows.withColumn("runid", F.lit("c")).withColumnRenamed("256", "300"), path)
    kinds = {tuple(r["columns"]): r["n"] for r in schema_kinds(spark, f"{path}/*/*.parquet").collect()}
    assert kinds == {("mins", "256"): 2, ("mins", "300"): 1}
    with pytest.raises(QualityError, match="differ in schema"):
        require_same_schema(spark, f"{path}/*/*.parquet")


def test_short_runs_stop_the_cube(warehouse):
    with pytest.raises(Exception, match="has 60 rows, expected 7800"):
        get_data(warehouse, "cube").count()


def test_unknown_output(warehouse):
    with pytest.raises(ValueError, match="output"):
        get_data(warehouse, "netcdf")


def test_rebuilding_needs_overwrite(spark, inputs, out, warehouse):
    with pytest.raises(Exception, match="exist"):
        build_warehouse(spark, **inputs, out=out)
    again = build_warehouse(spark, **inputs, out=out, overwrite=True)
    # nothing listed: the other gradient alone is excluded
    assert _values(again.table("excluded"), "runid", "reason") == [("96", "gradient not equal to 2.5")]
    build_warehouse(spark, **inputs, out=out, overwrite=True, excluded=EXCLUDED)


def test_missing_inputs_are_named(spark, inputs, tmp_path):
    with pytest.raises(QualityError, match="no "):
        build_warehouse(spark, **{**inputs, "register_path": str(tmp_path / "nothing")}, out=str(tmp_path / "o"))
    with pytest.raises(QualityError, match="build the warehouse first"):
        from tracehouse.plans.warehouse import Warehouse

        get_data(Warehouse(spark, str(tmp_path / "empty"), inputs["data_dir"]))


def test_cube_round_trip_and_bucket_pruning(spark, warehouse, tmp_path):
    cube = get_data(warehouse, "cube", rows=10, form="long")
    path = str(tmp_path / "cube")
    sinks.write_cube(cube, path, buckets=8)
    back = sinks.read_cube(spark, path)
    assert sorted(map(str, back.select(cube.columns).collect())) == sorted(map(str, cube.collect()))
    one = sinks.read_cube(spark, path, ["13"])
    assert one.count() == 10 * len(WAVELENGTHS)
    assert "PartitionFilters: [" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="exist"):
        sinks.write_cube(cube, path, buckets=8)


@pytest.mark.parametrize("kind", ["string", "bigint", "int"])
@pytest.mark.parametrize("buckets", [1, 8, 256])
def test_cube_filter_equals_a_full_scan(spark, tmp_path, kind, buckets):
    cube = spark.range(60).select((F.col("id") % 20).cast(kind).alias("runid"), F.col("id").alias("idx"))
    path = str(tmp_path / "cube")
    sinks.write_cube(cube, path, buckets=buckets)
    wanted = ["3", "7", "99"] if kind == "string" else [3, 7, 99]
    found = sinks.read_cube(spark, path, wanted)
    assert _values(found, "runid", "idx") == _values(cube.where(F.col("runid").isin(wanted)), "runid", "idx")
    assert sinks.read_cube(spark, path, []).count() == 0


def test_landed_keys_stay_text(spark, tmp_path):
    path = str(tmp_path / "landing")
    df = spark.createDataFrame([("00", 0.0), ("1e3", 0.0)], "runid string, mins double")
    sinks.write_runs(df, path)
    with pytest.raises(QualityError, match="00"):
        sinks.write_runs(df.where("runid = '00'"), path)
    sinks.write_runs(spark.createDataFrame([("0", 1.0)], "runid string, mins double"), path)
    back = spark.read.schema("mins double, runid string").parquet(path)
    assert _values(back, "runid") == [("0",), ("00",), ("1e3",)]


def test_run_landing_replaces_only_its_runs(spark, tmp_path):
    path = str(tmp_path / "landing")
    df = spark.createDataFrame([("1", 0.0), ("2", 0.0)], "runid string, mins double")
    sinks.write_runs(df, path)
    with pytest.raises(QualityError, match="exist already"):
        sinks.write_runs(df.where("runid = '2'"), path)
    newer = spark.createDataFrame([("2", 5.0), ("3", 6.0)], "runid string, mins double")
    sinks.write_runs(newer, path, overwrite=True)
    back = spark.read.schema("mins double, runid string").parquet(path)
    assert _values(back, "runid", "mins") == [("1", 0.0), ("2", 5.0), ("3", 6.0)]


def test_comments_reach_the_catalog(spark, warehouse):
    name = sinks.save_to_catalog(spark, TABLES["image_stats"], warehouse.out)
    comments = {c.name: c.description for c in spark.catalog.listColumns(name)}
    assert "id and mins" in comments["nm_count"]
    spark.sql(f"DROP TABLE {name}")


def test_runs_land_in_groups(spark, tmp_path):
    """Many runs share few folders; a run is found, refused and replaced there as in a folder of its own."""
    path = str(tmp_path / "runs")
    rows = spark.createDataFrame([(str(k), f"g{k}", m / 2, float(k)) for k in range(200) for m in range(3)] + [(None, "g", 0.0, 9.0), ("00", "h", 0.0, 8.0)], "runid string, id string, mins double, `256` double")
    sinks.write_runs(rows, path, groups=4)
    assert len(list((tmp_path / "runs").glob("run_group=*"))) <= 5
    for wavelengths in (None, ["256"]):
        found = read_landed_images(spark, path, wavelengths, groups=4)
        assert found.columns == rows.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, rows.collect()))
    newer = spark.createDataFrame([("7", "new", 0.0, 1.0), ("new run", "n", 0.0, 2.0)], rows.schema)
    with pytest.raises(QualityError, match="exist already"):
        sinks.write_runs(newer, path, groups=4)
    sinks.write_runs(newer, path, overwrite=True, groups=4)
    want = rows.where("runid IS NULL OR runid != '7'").union(newer)
    found = read_landed_images(spark, path, ["256"], groups=4)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
