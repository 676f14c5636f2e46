"""Method and identity XML of run folders, parsed as Spark jobs.

Each document is one row. Plain methods are read by the batch (``plain_xml``); every other document
is read by ``from_xml`` with a fixed schema; single rows or sections become one-element arrays.
Broken documents fail in the task that meets them, naming the folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tracehouse.functions.text import parent_dir, plain_path
from tracehouse.operators.quality import QualityError, duplicate_keys
from tracehouse.sources.plain_xml import plain_tables

PUMP_SECTION = "Binary Pump"
PUMP_TABLES = ("composition", "timetable")

_ROWS = "array<struct<Parameter: array<struct<Name: string, Value: string>>>>"
_SECTION = f"struct<Name: string, Table: array<struct<Name: string, Row: {_ROWS}>>>"
METHOD_SCHEMA = (
    "Doc struct<Content: struct<MethodConfiguration: struct<MethodDescription: "
    f"struct<Section: struct<Section: array<{_SECTION}>>>>>>"
)
IDENTITY_SCHEMA = "Doc struct<Content: struct<SampleContexts: struct<Setup: struct<_id: string>>>>"

# Column names of the landed tables by their XML names.
COMPOSITION_COLUMNS = {
    "channel": "channel",
    "ch. 1 solv.": "ch1_solv",
    "name 1": "name_1",
    "ch2 solv.": "ch2_solv",
    "name 2": "name_2",
    "selected": "selected",
    "used": "used",
    "percent": "percent",
}
TIMETABLE_COLUMNS = {"time": "mins", "a": "a", "b": "b", "flow": "flow", "pressure": "pressure"}


def read_documents(spark: SparkSession, data_dir: str, name: str, optional: bool = False) -> DataFrame:
    """Documents called ``name`` in the run folders ``<data_dir>/*.D``: (run_dir, xml)."""
    pattern = f"{data_dir}/*.D/{name}"
    try:
        raw = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as error:
        if not optional:
            raise QualityError(f"no {name} in the run folders of {data_dir}") from error
        return spark.createDataFrame([], "run_dir string, xml string")
    path = plain_path(F.col("path"), encoded=False)
    text = F.regexp_replace(F.decode("content", "UTF-8"), "^﻿", "")
    return raw.select(parent_dir(path).alias("run_dir"), text.alias("xml"))


def run_folders(documents: DataFrame) -> DataFrame:
    """Distinct run folders of the documents; a folder listed twice is an error."""
    if not duplicate_keys(documents, ["run_dir"]).isEmpty():
        raise QualityError("duplicate run folders")
    return documents.select("run_dir")


def run_identity(folders: DataFrame, sequence: DataFrame, sample: DataFrame) -> DataFrame:
    """Run id of each folder: from its sequence document, else its sample document, else an error."""

    def ids(documents: DataFrame, name: str) -> DataFrame:
        parsed = _parsed(IDENTITY_SCHEMA, "run_dir", f"{name} document")
        return documents.select("run_dir", parsed["Doc"]["Content"]["SampleContexts"]["Setup"]["_id"].alias(name))

    joined = folders.join(ids(sequence, "sequence"), "run_dir", "left").join(ids(sample, "sample"), "run_dir", "left")
    missing = F.raise_error(F.concat(F.lit("no run id in "), F.col("run_dir")))
    return joined.select("run_dir", F.coalesce("sequence", "sample", missing.cast("string")).alias("id"))


def _parsed(schema: str, where: str, what: str, text: str = "xml") -> Column:
    """The document in ``text``; a broken one fails with the name of its folder (or other key)."""
    parsed = F.from_xml(text, f"{schema}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    broken = F.raise_error(F.concat(F.lit(f"broken {what} in "), F.col(where)))
    # bound once, so that the document is parsed once
    checked = F.transform(
        F.array(parsed), lambda p: F.when(p["_corrupt_record"].isNull(), p["Doc"]).otherwise(broken.cast(_doc_type(schema)))
    )
    return F.struct(F.get(checked, F.lit(0)).alias("Doc"))


def _doc_type(schema: str) -> str:
    return schema.removeprefix("Doc ")


def parse_methods(
    documents: DataFrame, ids: Sequence[str] = ("id",), where: str = "id", tables: Sequence[str] = PUMP_TABLES
) -> DataFrame:
    """Rows of the pump tables of each document: the ``ids``, ``composition``, ``timetable``.

    They are the first and second table of the first section named ``Binary Pump``. With one of them
    named in ``tables``, the other's rows are not carried on.
    """
    carried = list(dict.fromkeys((*ids, where)))
    read = _read_plain(documents, carried, tables)
    # of plain documents, only their rows are left
    parsed = _parsed(METHOD_SCHEMA, where, "method document", text="__left")
    sections = parsed["Doc"]["Content"]["MethodConfiguration"]["MethodDescription"]["Section"]["Section"]
    pumps = F.filter(sections, lambda s: s["Name"] == PUMP_SECTION)
    absent = F.raise_error(F.concat(F.lit(f"no section {PUMP_SECTION} in "), F.col(where)))
    pump = F.coalesce(F.get(pumps, F.lit(0)), absent.cast(_SECTION))
    found = read.select(*ids, "__plain", *tables, F.when(~F.col("__plain"), pump["Table"]).alias("__tables"))

    def rows(table: str) -> Column:
        left = F.get("__tables", F.lit(PUMP_TABLES.index(table)))["Row"]
        return F.when(F.col("__plain"), F.col(table)).otherwise(left).alias(table)

    return found.select(*ids, *[rows(t) for t in tables])


def _read_plain(documents: DataFrame, carried: Sequence[str], tables: Sequence[str]) -> DataFrame:
    """The carried columns, the ``tables`` of plain documents, the text left of those that are not."""
    numbers = [PUMP_TABLES.index(t) for t in tables]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__left")
            for begin, end, plain, rows in plain_tables(texts, PUMP_SECTION, numbers):
                kept = [batch.column(c).slice(begin, end - begin) for c in carried]
                left = texts.take(pa.array(np.arange(begin, end), mask=plain))
                yield pa.RecordBatch.from_arrays([*kept, left, pa.array(plain), *rows], names=names)

    names = [*carried, "__left", "__plain", *tables]
    given = documents.select(*carried, F.col("xml").alias("__left"))
    added = StructType.fromDDL(", ".join(["__left string", "__plain boolean", *[f"{t} {_ROWS}" for t in tables]]))
    return given.mapInArrow(read, StructType([*given.schema.fields[:-1], *added.fields]))


def _table_rows(methods: DataFrame, ids: Sequence[str], table: str, columns: Mapping[str, str], where: str) -> DataFrame:
    """One pump table as rows: the ids, idx from 0 and the named values as text."""

    def fail(problem: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{table}: {problem} in "), F.col(where)))

    filled = F.size(F.coalesce(table, F.array())) > 0
    rows = F.when(filled, F.col(table)).otherwise(fail("no rows").cast(_ROWS))
    exploded = methods.select(*ids, F.posexplode(rows).alias("idx", "__row"))
    # empty values are absent ones
    values = F.map_from_entries(
        F.transform(
            F.col("__row.Parameter"),
            lambda p: F.struct(F.lower(p["Name"]), F.nullif(p["Value"], F.lit(""))),
        )
    )
    with_values = exploded.select(*ids, "idx", values.alias("__values"))

    def value(name: str) -> Column:
        present = F.map_contains_key("__values", F.lit(name))
        return F.when(present, F.col("__values")[name]).otherwise(fail(f"no column {name!r}").cast("string"))

    return with_values.select(*ids, "idx", *[value(n).alias(c) for n, c in columns.items()])


def composition_rows(methods: DataFrame, ids: Sequence[str] = ("id",), where: str = "id") -> DataFrame:
    """Solvent composition of parsed methods, typed."""
    rows = _table_rows(methods, ids, "composition", COMPOSITION_COLUMNS, where)
    return rows.withColumn("percent", F.col("percent").cast("float"))


def timetable_rows(methods: DataFrame, ids: Sequence[str] = ("id",), where: str = "id") -> DataFrame:
    """Timetable of parsed methods, typed."""
    rows = _table_rows(methods, ids, "timetable", TIMETABLE_COLUMNS, where)
    return rows.select(*ids, "idx", *[F.col(c).cast("float").alias(c) for c in TIMETABLE_COLUMNS.values()])


def pump_tables(methods: DataFrame, ids: Sequence[str] = ("id",), where: str = "id") -> tuple[DataFrame, DataFrame]:
    """(solvent composition, timetable) of parsed methods, typed."""
    return composition_rows(methods, ids, where), timetable_rows(methods, ids, where)


def read_methods(spark: SparkSession, data_dir: str) -> DataFrame:
    """Parsed pump tables of all run folders, with the run ids of their identity documents.

    Write the result before deriving both tables from it: parsing is the cost.
    """
    methods = read_documents(spark, data_dir, "acq.macaml")
    identity = run_identity(
        run_folders(methods),
        read_documents(spark, data_dir, "sequence.acam_", optional=True),
        read_documents(spark, data_dir, "sample.acaml", optional=True),
    )
    return parse_methods(methods.join(identity, "run_dir"))
