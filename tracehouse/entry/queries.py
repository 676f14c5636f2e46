"""Spark queries over the driver tables, each built from the package's operators.

Orders, customers and nations stand for runs, register and catalogue; events for signal traces
(one per user); line items for program rows; embeddings for wide images.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracehouse.functions import text
from tracehouse.functions.times import local_micros
from tracehouse.operators import exclusion, filters, keys, matching, program, quality, reports, reshape, traces
from tracehouse.plans import catalogue, reconcile, register, runs, serve
from tracehouse.plans.warehouse import Warehouse
from tracehouse.schemas import REGISTER_SOURCE, TABLES, ForeignKey, Table
from tracehouse.session import shared_folder
from tracehouse.sources import sinks, xml
from tracehouse.sources import tables as sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TRIM_ROWS = 40
END_CUTOFF = 40_000.0  # minutes
DIMENSIONS = 64  # of the embeddings
DIGITS = 6
SERVED_ROWS = 10
SERVED_GROUPS = 64  # folders of landed runs
SERVED_RUNS = ["3", "7", "12", "13", "14", "100", "99999"]


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def _minutes(ts: Column) -> Column:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return (local_micros(ts) - local_micros(start)) / F.lit(6e7)


def _trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as traces: runid, mins (of the month), value."""
    events = _table(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("runid"), _minutes(F.col("ts")).alias("mins"), "value")


def _image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as wide images of two wavelengths."""
    trace = _trace(spark, sf_dir)
    return trace.select(
        "runid", "mins", F.col("value").alias("256"), (F.col("value") * 2).alias("300")
    )


def _wide_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with one column per dimension, named 200 to 263; another length is an error."""
    vectors = _table(spark, sf_dir, "embeddings")
    other = F.raise_error(F.lit(f"an embedding has not {DIMENSIONS} elements")).cast("boolean")
    vectors = vectors.where(F.when(F.size("embedding") == DIMENSIONS, F.lit(True)).otherwise(other))
    cells = [f"double(embedding[{i}]) AS `{200 + i}`" for i in range(DIMENSIONS)]
    return vectors.selectExpr("vec_id", "label", *cells)


def _timetables(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("runid"),
        F.col("l_linenumber").alias("mins"),
        F.col("l_discount").alias("a"),
        F.col("l_tax").alias("b"),
        F.col("l_returnflag").alias("flow"),
        F.col("l_linestatus").alias("pressure"),
    )


def _solvcomps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("runid"),
        F.when(F.col("o_orderstatus") == "F", "A").otherwise("B").alias("channel"),
        F.col("o_orderpriority").alias("ch1_solv"),
        F.col("o_totalprice").alias("percent"),
    )


# --- run metadata, register, catalogue -----------------------------------------------------------


@_query
def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    chm = orders.select(
        F.col("o_orderkey").alias("runid"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderdate").alias("acq_date"),
        F.col("o_orderpriority").alias("acq_method"),
        F.col("o_orderstatus").alias("seq_name"),
        F.col("o_totalprice").alias("description"),
        F.col("o_custkey").alias("samplecode"),
    )
    customers = _table(spark, sf_dir, "customer")
    st = customers.select(
        F.col("c_custkey").alias("samplecode"),
        F.col("c_mktsegment").alias("detection"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("wine"),
        F.col("c_nationkey").alias("vintage"),
    )
    nations = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    repeated = ("locale", "country", "subregion", "appellation", "producer", "type", "color", "category", "varietal")
    ct = nations.select(
        F.col("n_nationkey").alias("vintage"),
        F.col("n_name").alias("wine"),
        F.col("r_name").alias("region"),
        *[F.col("n_name").alias(c) for c in repeated],
    )
    excluded = orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("runid"))
    return runs.run_metadata(chm, st, ct, excluded)


def _catalogue_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _table(spark, sf_dir, "supplier")
    name = F.concat(F.lit(" '"), F.col("s_name"), F.lit(' &amp; \u00c9t\u00e9" '))
    others = ("Locale", "Country", "Region", "SubRegion", "Appellation", "Producer", "Type", "Color", "Category", "Varietal")
    return suppliers.select(
        F.lit(" 750ml ").alias("Size"),
        F.col("s_nationkey").cast("string").alias("Vintage"),
        name.alias("Wine"),
        *[F.concat(F.lit(f" {c} "), F.col("s_suppkey").cast("string")).alias(c) for c in others],
    )


@_query
def clean_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.clean_catalogue(_catalogue_export(spark, sf_dir))


def _register_and_catalogue(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts as register rows, suppliers' nations as the catalogue."""
    parts = _table(spark, sf_dir, "part")
    raw = parts.select(
        F.when(F.col("p_size") > 10, "raw").otherwise("cuprac").alias("detection"),
        F.upper("p_type").alias("sampler"),
        F.concat(F.lit(" P"), F.col("p_partkey").cast("string")).alias("samplecode"),
        F.col("p_size").cast("string").alias("vintage"),
        F.concat(F.lit(' "'), F.upper("p_name"), F.lit("' ")).alias("wine"),
        F.lit("1/2/2023").alias("open_date"),
        F.lit(None).cast("string").alias("sampled_date"),
        F.when(F.col("p_retailprice") > 1000, "y").alias("added_to_cellartracker"),
        F.col("p_brand").alias("notes"),
        F.col("p_retailprice").cast("string").alias("size"),
    )
    known = parts.where("p_type != 'PROMO'").select(
        F.col("p_name").alias("wine"), F.col("p_size").alias("vintage")
    )
    return raw, known.distinct()


@_query
def load_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched, _ = register.load_register(*_register_and_catalogue(spark, sf_dir))
    return matched.withColumn("size", F.round(F.col("size").cast("double"), 2))


@_query
def register_not_in_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, unmatched = register.load_register(*_register_and_catalogue(spark, sf_dir))
    return unmatched


def _landed_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed run metadata; the key is a padded user id, the date is text."""
    events = _table(spark, sf_dir, "events")
    return events.select(
        F.lpad(F.col("user_id").cast("string"), 4, "0").alias("notebook"),
        F.date_format("ts", "dd-MMM-yy, HH:mm:ss").alias("date"),
        F.concat(F.lit(" "), F.upper("event_type")).alias("method"),
        F.lit("5.00").alias("injection_volume"),
        F.concat(F.lit("Wines_"), F.date_format("ts", "yyyy-MM-dd_HH-00-00")).alias("seq_name"),
        F.col("event_type").alias("seq_desc"),
        F.lit("Vial 1").alias("vialnum"),
        F.lit("C:\\Chem").alias("originalfilepath"),
        F.col("event_id").cast("string").alias("id"),
        F.lit(None).cast("string").alias("desc"),
        F.concat(F.lit("/lib/"), F.col("event_id").cast("string")).alias("path"),
    )


@_query
def stage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = runs.stage_runs(_landed_metadata(spark, sf_dir))
    return staged.withColumn("inj_vol", F.col("inj_vol").cast("double"))


@_query
def registered_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").where("c_acctbal > 0")
    st = customers.select(F.col("c_custkey").cast("string").alias("samplecode"))
    found = runs.load_runs(_landed_metadata(spark, sf_dir), st).runs
    return found.withColumn("inj_vol", F.col("inj_vol").cast("double"))


@_query
def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    name = F.concat(F.lit("run_"), F.date_format("ts", "yyyy-MM-dd_HH-00-00"))
    named = events.select(
        F.when(F.col("event_type") == "error", keys.NO_SEQUENCE).otherwise(name).alias("seq_name"),
        F.col("event_type").alias("seq_desc"),
    )
    return keys.sequences(named)


@_query
def attach_runid(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "event_id", "value")
    customers = _table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return runs.attach_runid(images, customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("runid")))


# --- text and keys -------------------------------------------------------------------------------


@_query
def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    return _table(spark, sf_dir, "documents").select(
        "doc_id",
        text.normalise_name(body, "quotes_first").alias("quotes_first"),
        text.normalise_name(body, "trim_first").alias("trim_first"),
    )


@_query
def html_unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return pages.select("page_id", text.html_unescape(F.col("html")).alias("html"))


@_query
def key_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return _table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.concat_skip_null(["c_name", F.lit(" "), segment]).alias("joined"),
        F.coalesce(segment, F.lit("none")).alias("segment"),
    )


@_query
def string_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    bounds = {
        "first_char": (1, 1), "last_char": (-1, -1), "two_three": (2, 3), "eleventh": (11, 11),
        "last_eight": (-8, -1), "date_part": (-19, -10), "from_six": (6, None), "year": (0, 4),
    }
    slices = [text.slice_text(name, *b).alias(n) for n, b in bounds.items()]
    return _table(spark, sf_dir, "customer").select("c_custkey", *slices, F.length(name).alias("len"))


@_query
def path_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        text.parent_dir(url).alias("parent"),
        text.file_stem(url).alias("stem"),
        text.child_path(url, "data.parquet").alias("data_path"),
    )


@_query
def flags_and_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("p_size") > 25, "y").when(F.col("p_size") > 10, "n")
    vintage = F.when(F.col("p_size") > 40, "null").when(F.col("p_size") > 5, F.col("p_size").cast("string"))
    return _table(spark, sf_dir, "part").select(
        "p_partkey", text.flag_from_text(flag).alias("flag"), text.vintage_or_default(vintage).alias("vintage")
    )


@_query
def remap_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.col("o_custkey").cast("string")
    key = F.when(F.col("o_orderstatus") == "O", F.lpad(plain, 4, "0")).otherwise(plain)
    return _table(spark, sf_dir, "orders").select("o_orderkey", keys.remap_key(key).alias("code"))


@_query
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    name = F.concat(F.lit("wines_"), F.date_format("ts", "yyyy-MM-dd_HH-mm-ss"))
    marked = F.when(F.col("event_type") == "error", keys.NO_SEQUENCE).otherwise(name)
    return events.select(
        "event_id",
        keys.acquisition_time(F.date_format("ts", "d-MMM-yy, HH:mm:ss")).alias("acq_date"),
        keys.sequence_time(marked).alias("dt_run"),
        keys.repair_sequence_name(name).alias("seq_name"),
    )


@_query
def dedupe_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    keyed = orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("notebook"), "o_orderdate")
    return keys.uniquify_keys(keyed, "notebook", "o_orderdate")


@_query
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return keys.surrogate_key(orders, ["o_orderdate", "o_orderkey"])


# --- quality -------------------------------------------------------------------------------------


@_query
def dup_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(_table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


@_query
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").withColumn("l_tax", F.nullif(F.col("l_tax"), F.lit(0.0)))
    parents = {
        "orders": _table(spark, sf_dir, "orders").where("o_orderstatus != 'P'"),
        "part": _table(spark, sf_dir, "part"),
    }
    return quality.violations(
        lines,
        primary_key=["l_orderkey", "l_linenumber"],
        not_null=["l_tax", "l_discount"],
        foreign_keys=[
            ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
            ForeignKey(("l_partkey",), "part", ("p_partkey",)),
        ],
        parents=parents,
    )


@_query
def coverage_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"))
    customers = _table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("key"))
    return quality.coverage(orders, customers, ["key"])


@_query
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    zeros = lines.select(*[F.nullif(c, F.lit(0.0)).alias(c) for c in ("l_discount", "l_tax", "l_quantity")])
    return quality.null_counts(zeros, zeros.columns)


@_query
def row_count_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_count_range(_table(spark, sf_dir, "events"), "user_id")


@_query
def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").where("c_acctbal > 0")
    incoming = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return quality.new_rows(customers, incoming, ["c_custkey"])


# --- program -------------------------------------------------------------------------------------


@_query
def distinct_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return program.mechanical_params(_timetables(spark, sf_dir))


@_query
def unpivot_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return program.channels(_timetables(spark, sf_dir))


@_query
def pivot_solvents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return program.solvents(_solvcomps(spark, sf_dir))


@_query
def pivot_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    return reshape.pivot_values(lines, ["l_orderkey"], "l_linestatus", "l_quantity", ["F", "O"], "max")


@_query
def union_zero_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return program.solvent_program(_timetables(spark, sf_dir), _solvcomps(spark, sf_dir))


@_query
def elution_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One program row per user event, numbered; times are unique per user."""
    trace = _trace(spark, sf_dir)
    timetables = trace.select(
        F.col("runid").alias("num"), F.col("mins").alias("time"), F.col("value").alias("a"), (-F.col("value")).alias("b")
    )
    solvcomps = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("num"), F.lit("A").alias("channel"), F.col("c_acctbal").alias("percent")
    )
    return program.numbered_elution_table(timetables, solvcomps)


def _gradients(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    points = _trace(spark, sf_dir)
    if method == "per_time":
        points = traces.rezero_time(points, "runid")
    return program.gradients(points, value="value", method=method)


@_query
def gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gradients(spark, sf_dir, "per_time")


@_query
def gradient_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gradients(spark, sf_dir, "slope")


@_query
def counts_per_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _gradients(spark, sf_dir, "per_time")
    return program.counts_per_gradient(found.select(F.round("gradient", 1).alias("gradient")))


# --- signals -------------------------------------------------------------------------------------


@_query
def signal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.signal_stats(_trace(spark, sf_dir), "runid", "mins", "value", digits=4)


@_query
def image_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.image_stats(_image(spark, sf_dir), "runid")


@_query
def matrix_columns_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = traces.element_stats(_table(spark, sf_dir, "embeddings"), "embedding")
    return _rounded(stats, "value_min", "value_max", "value_sum")


@_query
def column_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _wide_embeddings(spark, sf_dir).drop("vec_id")
    sums = traces.column_sums(wide, "label")
    return sums.selectExpr("label", *[f"round(`{c}`, {DIGITS}) AS `{c}`" for c in sums.columns if c != "label"])


@_query
def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.wide_to_long(_wide_embeddings(spark, sf_dir), ["vec_id", "label"])


@_query
def rezero_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.rezero_time(_trace(spark, sf_dir), "runid")


@_query
def regrid_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.regrid_time(_trace(spark, sf_dir), "runid", keep_idx=True)


@_query
def trim_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.trim_rows(_trace(spark, sf_dir), "runid", TRIM_ROWS, short="keep", keep_idx=True)


def _run_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer")
    return customers.select(F.col("c_custkey").alias("runid"), "c_name", "c_mktsegment", "c_nationkey")


@_query
def cube_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.cube(_image(spark, sf_dir), _run_dimension(spark, sf_dir), rows=TRIM_ROWS, short="keep")


@_query
def cube_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense form; its array is spread to two columns for comparison."""
    rows = traces.cube(
        _image(spark, sf_dir), _run_dimension(spark, sf_dir), rows=TRIM_ROWS, form="array", short="keep"
    )
    cells = {"nm_256": F.col("absorbance")[0], "nm_300": F.col("absorbance")[1]}
    return rows.withColumns(cells).drop("absorbance")


@_query
def cube_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of one wavelength and one kind of run within a time range."""
    # the wavelength and the runs are chosen below the numbering, the times above it
    runs = _run_dimension(spark, sf_dir).where(F.col("c_mktsegment") == "BUILDING")
    images = _image(spark, sf_dir).select("runid", "mins", "256").join(runs.select("runid"), "runid", "left_semi")
    cells = traces.cube(images, runs, rows=TRIM_ROWS, short="keep")
    return cells.where(F.col("mins").between(100, 20_000))


# --- exclusion and serving -----------------------------------------------------------------------


@_query
def time_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = traces.signal_stats(_trace(spark, sf_dir), "runid", "mins", "value", digits=4)
    return exclusion.time_outliers(stats, _run_dimension(spark, sf_dir), END_CUTOFF)


def _excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer")
    listed = customers.where("c_acctbal < 0").select(
        F.col("c_custkey").alias("runid"), F.lit("negative balance").alias("reason")
    )
    falling = _gradients(spark, sf_dir, "per_time").where("gradient < 0")
    rules = [
        exclusion.manual_rule(_trace(spark, sf_dir), listed),
        falling.select("runid", F.lit("falling").alias("reason")),
    ]
    return exclusion.combine_rules(rules)


@_query
def excluded_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _excluded(spark, sf_dir)


@_query
def exclude_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("runid"), "value")
    return exclusion.without(events, _excluded(spark, sf_dir))


@_query
def run_data_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    located = orders.select(
        F.col("o_orderkey").alias("runid"), F.concat(F.lit("/lib/"), F.col("o_orderkey").cast("string")).alias("path")
    )
    excluded = orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("runid"))
    return exclusion.run_data_paths(exclusion.without(located, excluded))


@_query
def fetch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the runs of one segment, with the file they come from."""
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.col("_metadata.file_name").alias("file"))
    chosen = _table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return events.join(chosen.select(F.col("c_custkey").alias("user_id")), "user_id", "left_semi")


@_query
def filter_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "id")
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), "l_orderkey", "l_quantity")
    wanted = {
        "p_type": {"value": "PROMO", "operator": "="},
        "p_brand": {"value": ["Brand#1", "Brand#7", "Brand#12"], "operator": "IN"},
        "l_quantity": {"value": (10, 20), "operator": "BETWEEN"},
    }
    return filters.query(parts, lines, wanted)


@_query
def filter_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = filters.infer_operators({"p_type": ("PROMO", "LARGE"), "p_size": 10})
    return filters.query(_table(spark, sf_dir, "part"), None, wanted)


@_query
def like_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part")
    return parts.where(F.col("p_name").like("%ring%")).select("p_partkey", "p_name")


# --- matching and reports ------------------------------------------------------------------------


@_query
def match_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best name for every part's misspelt, reordered name with its type in front."""
    parts = _table(spark, sf_dir, "part")
    words = F.split("p_name", " ")
    misspelt = F.concat_ws(" ", F.lower("p_type"), F.translate(words[1], "l", "r"), F.translate(words[0], "o", "0"))
    left = parts.select("p_partkey", misspelt.alias("left_string"))
    right = parts.select(F.col("p_name").alias("name"))
    return matching.best_match(left, right, "left_string", "name", "name", min_score=60)


@_query
def match_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier of every supplier name typed without its zeros and in lower case, where one is close."""
    suppliers = _table(spark, sf_dir, "supplier")
    typed = F.concat_ws(" ", F.lit("suplier"), F.substring("s_name", 10, 20))
    left = suppliers.select("s_suppkey", typed.alias("left_string"))
    right = suppliers.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("place"))
    return matching.best_match(left, right, "left_string", "name", "place", min_score=reconcile.VERIFIED_ABOVE + 1)


def _made_word(number: Column, syllables: int) -> Column:
    """A word of two-letter syllables, one for two decimal digits of a number."""

    def syllable(k: int) -> Column:
        n = F.pmod(F.floor(number / 100**k), F.lit(100)).cast("int")
        first = F.substring(F.lit("bcdfghjklmnpqrstvwxz"), F.floor(n / 5).cast("int") + 1, F.lit(1))
        return F.concat(first, F.substring(F.lit("aeiou"), n % 5 + 1, F.lit(1)))

    return F.concat(*[syllable(k) for k in range(syllables)])


@_query
def match_long_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best of all parts' made six-word names for each of them in reverse order, with letters mistyped."""
    # a small file is read by few tasks, but its names are much work each
    parts = _table(spark, sf_dir, "part").select("p_partkey").repartition("p_partkey")
    words = [
        _made_word(F.crc32(F.concat_ws("-", "p_partkey", F.lit(k)).cast("binary")), 2 + k % 3) for k in range(6)
    ]
    mistyped = [F.translate(w, "bdk", "pgc") if k in (0, 3) else w for k, w in enumerate(words)]
    left = parts.select("p_partkey", F.concat_ws(" ", *mistyped[::-1]).alias("left_string"))
    names = parts.select("p_partkey", F.concat_ws(" ", *words).alias("name"))
    return matching.best_match(left, names, "left_string", "name", "p_partkey")


@_query
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.histogram(_table(spark, sf_dir, "lineitem"), "l_quantity", 5.0)


@_query
def score_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    return reports.percent_of_total(lines, "l_quantity", F.col("l_quantity") > 20)


@_query
def top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_rows(_table(spark, sf_dir, "lineitem"), 5)


@_query
def bool_and_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.all_true(_table(spark, sf_dir, "lineitem"), F.col("l_quantity") > 0, "all_positive")


@_query
def count_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    values = {
        "total": F.count("*"),
        "untaxed": F.count_if(F.col("l_tax") == 0),
        "taxed": F.count_if(F.col("l_tax") != 0),
    }
    return reshape.labelled_values(lines, values)


@_query
def distinct_values_stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    return reshape.stacked_distinct(lines, ["l_returnflag", "l_linestatus", "l_linenumber"])


@_query
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    return reshape.distinct_counts(lines, ["l_returnflag", "l_linestatus", "l_suppkey", "l_partkey"])


@_query
def distinct_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts of a table's columns, and whether the sketches of its two written halves estimate them."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    out, halves = _scratch(spark, "sketched"), []
    for half in ("odd", "even"):
        table = Table(half, "l_orderkey bigint,l_partkey bigint,l_suppkey bigint,l_returnflag string,l_quantity double")
        own = lines.where(F.col("l_orderkey") % 2 == int(half == "odd"))
        halves.append(sinks.write_table(own, table, out, sketched=lines.columns))
    estimated = reshape.estimated_counts(sinks.read_sketches(spark, ["odd", "even"], out))
    exact = reshape.distinct_counts(halves[0].unionByName(halves[1])).unpivot([], lines.columns, "column", "exact")
    close = F.abs(F.col("distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return exact.join(estimated, "column").select("column", "exact", close.alias("close"))


@_query
def update_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    suppliers = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    return reconcile.update_from(customers, suppliers, "c_custkey", {"c_name": "s_name"})


@_query
def conditional_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    flagged = reconcile.correct(parts, F.col("p_size") > 25, "verified", True)
    return reconcile.correct(flagged, F.col("p_size").isin(1, 2, 3), "p_type", "TINY")


# --- XML -----------------------------------------------------------------------------------------


def _method_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One method document per line item, holding its discount, tax and quantity.

    Parsing is bound by the processor and small columns grow into whole documents, so the rows are
    spread over all tasks first, by columns that no single value dominates.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = _table(spark, sf_dir, "lineitem").repartition(tasks, "l_orderkey", "l_partkey", "l_suppkey")

    def row(**values: Column) -> Column:
        parts = [
            F.concat(F.lit(f"<Parameter><Name>{name.replace('_', ' ')}</Name><Value>"), value, F.lit("</Value></Parameter>"))
            for name, value in values.items()
        ]
        return F.concat(F.lit("<Row>"), *parts, F.lit("</Row>"))

    def composition(channel: str, percent: Column) -> Column:
        names = {"Channel": F.lit(channel), "Ch. 1 Solv.": F.col("l_returnflag"), "Name 1": F.lit(""),
                 "Ch2 Solv.": F.col("l_linestatus"), "Name 2": F.lit(""), "Selected": F.lit("Ch. 1"),
                 "Used": F.lit("Yes"), "Percent": percent.cast("string")}
        return row(**names)

    step = row(
        Time=F.col("l_linenumber").cast("string"), A=F.lit("0.0"), B=F.lit("100.0"),
        Flow=F.col("l_quantity").cast("string"), Pressure=F.lit("700"),
    )
    open_to_section = "Doc Content MethodConfiguration MethodDescription Section".split()
    xml_text = F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?><ACAML xmlns="urn:example:acaml">'),
        F.lit("".join(f"<{tag}>" for tag in open_to_section)),
        F.lit("<Section><Name>Sampler</Name></Section><Section><Name>Binary Pump</Name>"),
        F.lit("<Table><Name>Solvent Composition</Name>"),
        composition("A", F.col("l_discount")),
        composition("B", F.col("l_tax")),
        F.lit("</Table><Table><Name>Timetable</Name>"),
        step,
        F.lit("</Table></Section>"),
        F.lit("".join(f"</{tag}>" for tag in reversed(open_to_section)) + "</ACAML>"),
    )
    return lines.select(F.col("l_orderkey").cast("string").alias("id"), xml_text.alias("xml"))


@_query
def xml_solvent_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    methods = xml.parse_methods(_method_documents(spark, sf_dir), tables=("composition",))
    return xml.composition_rows(methods).withColumn("percent", F.round(F.col("percent").cast("double"), 4))


@_query
def xml_timetable(spark: SparkSession, sf_dir: str) -> DataFrame:
    timetable = xml.timetable_rows(xml.parse_methods(_method_documents(spark, sf_dir), tables=("timetable",)))
    numbers = [F.col(c).cast("double").alias(c) for c in ("mins", "a", "b", "flow", "pressure")]
    return timetable.select("id", "idx", *numbers)


@_query
def xml_run_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run id from the sequence document, or from the sample document where there is none."""
    orders = _table(spark, sf_dir, "orders")
    folder = F.concat(F.lit("/lib/"), F.col("o_orderkey").cast("string"), F.lit(".D"))

    def documents(prefix: str, rows: DataFrame) -> DataFrame:
        body = F.concat(
            F.lit('<ACAML xmlns="urn:example:acaml"><Doc><Content><SampleContexts><Setup id="'),
            F.lit(prefix), F.col("o_orderkey").cast("string"),
            F.lit('" ver="0"><Name>x</Name></Setup></SampleContexts></Content></Doc></ACAML>'),
        )
        return rows.select(folder.alias("run_dir"), body.alias("xml"))

    sequence = documents("seq-", orders.where("o_orderstatus = 'F'"))
    return xml.run_identity(orders.select(folder.alias("run_dir")), sequence, documents("smp-", orders))


# --- written and read back -----------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


@_query
def table_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers stacked under customers by name, as written, conformed and read back."""
    people = _table(spark, sf_dir, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_acctbal AS balance")
    more = _table(spark, sf_dir, "supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS key", "s_name AS name")
    table = Table("people", "key bigint,name string,balance double")
    return sinks.write_table(sinks.append_by_name(more, people), table, _scratch(spark, "tables"))


@_query
def register_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as an original register: landed as CSV with quotes and commas, staged, exported and read back."""
    parts, path = _table(spark, sf_dir, "part"), _scratch(spark, "register")
    values = {
        "detection": F.when(F.col("p_size") > 10, "raw").otherwise("cuprac"),
        "sampler": F.upper("p_type"),
        "samplecode": F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")),
        "vintage": F.when(F.col("p_size") > 40, "null").otherwise(F.col("p_size").cast("string")),
        "name": F.concat(F.initcap("p_name"), F.lit(', "'), "p_brand", F.lit('"')),
        "open_date": F.lit("1/2/2023"),
        "sampled_date": F.lit("3/4/2023"),
        "added_to_cellartracker": F.when(F.col("p_retailprice") > 1000, "y").otherwise("n"),
        "notes": F.concat("p_brand", F.lit("\nsecond line")),
        "size": F.col("p_size").cast("string"),
    }
    columns = T._parse_datatype_string(REGISTER_SOURCE).names
    landed = parts.select(*[values[c].alias(c) for c in columns])
    landed.write.csv(f"{path}/csv", header=True, quote='"', escape='"')
    register = reconcile.stage_register(sources.read_register_csv(spark, f"{path}/csv"))
    reconcile.export_register(register, f"{path}/export")
    return spark.read.parquet(f"{path}/export").withColumn("size", F.col("size").cast("double"))


@_query
def runs_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed by priority; one priority is then landed again with other prices."""
    path = _scratch(spark, "runs")
    orders = _table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("runid"), F.col("o_orderkey").alias("mins"), F.col("o_totalprice").alias("value")
    )
    sinks.write_runs(orders, path)
    again = orders.where("runid = '1'").withColumn("value", -F.col("value"))
    sinks.write_runs(again, path, overwrite=True)
    return spark.read.schema(orders.schema).parquet(path)


@_query
def landed_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas of landed files, and the runs that have each: orders of one priority are landed with a further column."""
    path = _scratch(spark, "landed")
    orders = _table(spark, sf_dir, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("runid"), F.col("o_orderkey").alias("mins"), F.col("o_totalprice").alias("value")
    )
    sinks.write_runs(orders.where("runid != '2'"), path)
    sinks.write_runs(orders.where("runid = '2'").withColumn("unit", F.lit("mAU")), path)
    files = sources.file_columns(spark, f"{path}/*/*.parquet")
    return files.select(
        F.regexp_extract("path", "runid=([^/]*)/", 1).alias("runid"),
        F.array_join("columns", ",").alias("columns"),
        F.array_join("types", ",").alias("types"),
    ).distinct()


def _served(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse of customers' traces: images landed run by run, tables written, one segment excluded."""
    out = _scratch(spark, "warehouse")
    events = _image(spark, sf_dir).withColumns(
        {"runid": F.col("runid").cast("string"), "id": F.concat(F.lit("guid-"), F.col("runid").cast("string"))}
    )
    sinks.write_runs(events.select("runid", "id", "mins", "256", "300"), f"{out}/lib", groups=SERVED_GROUPS)
    warehouse = Warehouse(spark, out, f"{out}/lib", landed=True, groups=SERVED_GROUPS)
    customers = _table(spark, sf_dir, "customer").withColumn("runid", F.col("c_custkey").cast("string"))
    nations = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    product = [F.col("n_name").alias(c) for c in ("locale", "country", "subregion", "appellation", "producer", "type", "color", "category", "varietal")]
    tables = {
        "chm": customers.select(
            "runid", F.concat(F.lit("s"), "runid").alias("samplecode"), F.lit("2024-01-01").alias("acq_date"),
            F.col("c_mktsegment").alias("acq_method"), F.lit(10).alias("inj_vol"), F.lit("month").alias("seq_name"),
            F.lit("vial 1").alias("vialnum"), F.lit("x").alias("originalfilepath"),
            F.concat(F.lit("guid-"), "runid").alias("id"), F.col("c_name").alias("description"),
            F.concat(F.lit(f"{out}/lib/runid="), "runid").alias("path"),
        ),
        "st": customers.select(
            F.lit("raw").alias("detection"), F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("wine"),
            (F.col("c_nationkey") + 1990).alias("vintage"), F.lit("JV").alias("sampler"),
            F.concat(F.lit("s"), "runid").alias("samplecode"),
            *[F.lit(None).alias(c) for c in ("open_date", "sampled_date", "added_to_cellartracker", "notes", "size")],
        ),
        "ct": nations.select(
            F.concat((F.col("n_nationkey") + 1990).cast("string"), F.lit(" "), "n_name").alias("wine_key"),
            F.lit("750ml").alias("size"), (F.col("n_nationkey") + 1990).alias("vintage"), F.col("n_name").alias("wine"),
            F.col("r_name").alias("region"), *product,
        ),
        "excluded": customers.where("c_mktsegment = 'MACHINERY'").select("runid", F.lit("segment").alias("reason")),
        "image_stats": traces.image_stats(sources.read_landed_images(spark, f"{out}/lib", groups=SERVED_GROUPS), "runid").withColumn(
            "path", F.concat(F.lit(f"{out}/lib/runid="), "runid")
        ),
    }
    for name, table in tables.items():
        sinks.write_table(table, TABLES[name], out)
    return warehouse


@_query
def get_data_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wavelength of all included runs, as a warehouse serves it."""
    return serve.get_data(_served(spark, sf_dir), "cube", rows=SERVED_ROWS, form="long", wavelengths=["256"])


@_query
def get_data_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-gridded images of some runs, excluded and unknown ones among them, beside their metadata."""
    images, metadata = serve.get_data(_served(spark, sf_dir), "pairs", SERVED_RUNS)
    return images.join(metadata.drop("id"), "runid")


@_query
def filter_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter over two catalog tables, given by bare values."""
    warehouse = _served(spark, sf_dir)
    stem = f"t{uuid4().hex}"
    warehouse.view("sample_metadata").createOrReplaceTempView(f"{stem}_metadata")
    long = traces.wide_to_long(sources.read_landed_images(spark, warehouse.lib_dir, groups=SERVED_GROUPS).drop("runid"), ["id", "mins"])
    long.createOrReplaceTempView(f"{stem}_signal")
    wanted = filters.infer_operators({"wavelength": (256, 299), "mins": [100, 20_000], "region": ["ASIA", "EUROPE"], "detection": "raw"})
    return filters.query_tables(spark, wanted, metadata_table=f"{stem}_metadata", signal_table=f"{stem}_signal")


@_query
def cube_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some runs of a written cube, read through their buckets."""
    path = _scratch(spark, "cube")
    cells = traces.cube(_image(spark, sf_dir), _run_dimension(spark, sf_dir), rows=TRIM_ROWS, short="keep")
    sinks.write_cube(cells, path, buckets=8)
    return sinks.read_cube(spark, path, [3, 7, 50, 10**9])


@_query
def cube_table_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of some runs and one wavelength of a cube saved as a bucketed table, beside their runs' metadata."""
    runs = _run_dimension(spark, sf_dir)
    cells = traces.cube(_image(spark, sf_dir), runs.select("runid"), rows=TRIM_ROWS, short="keep")
    saved = sinks.save_cube(cells, f"cube_{uuid4().hex}", _scratch(spark, "cube_table"), buckets=8)
    chosen = saved.where(F.col("runid").isin(3, 7, 50, 10**9) & (F.col("wavelength") == 256))
    return chosen.join(runs, "runid")


@_query
def reconciled_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A register of misspelt supplier names, corrected from the catalogue of suppliers."""
    suppliers = _table(spark, sf_dir, "supplier")
    year = (F.lit(1990) + F.col("s_nationkey")).cast("string")
    raw = suppliers.select(
        F.lit("raw").alias("detection"), F.lit("JV").alias("sampler"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("samplecode"),
        year.alias("vintage"), F.concat(F.lit("suplier "), F.substring("s_name", 10, 20)).alias("name"),
        F.lit("").alias("open_date"), F.lit("").alias("sampled_date"), F.lit("y").alias("added_to_cellartracker"),
        F.lit("").alias("notes"), F.lit(None).cast("string").alias("size"),
    )
    name = F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit(" ")))
    catalogue = suppliers.select(
        F.concat_ws(" ", year, name).alias("wine_key"), name.alias("wine"), year.cast("int").alias("vintage")
    )
    corrected, _ = reconcile.reconcile(raw, catalogue)
    return corrected.select("samplecode", "wine", "vintage", "wine_key")
