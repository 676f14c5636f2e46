"""Readers of tabular inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracehouse import schemas
from tracehouse.functions.columns import named
from tracehouse.functions.text import parent_dir, plain_path
from tracehouse.operators.quality import QualityError, require_columns


def _read(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise QualityError(f"no parquet files at {path}") from error


# one reading of quoted CSV: doubled quotes, line breaks in fields; short and long rows are errors
_CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "FAILFAST"}


def read_catalogue(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed catalogue export with its 13 columns as text; a missing column is an error."""
    raw = spark.read.csv(path, **_CSV) if fmt == "csv" else _read(spark, path)
    require_columns(raw, schemas.CATALOGUE_SOURCE, "catalogue")
    return raw.select(*[F.col(c).cast("string") for c in schemas.CATALOGUE_SOURCE])


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """Register with corrected names (parquet)."""
    return _read(spark, path)


def read_register_csv(spark: SparkSession, path: str) -> DataFrame:
    """Original register (CSV with header). All columns are text: codes such as '00' are not numbers."""
    return spark.read.csv(path, schema=schemas.REGISTER_SOURCE, enforceSchema=False, **_CSV)


def _with_source(df: DataFrame) -> DataFrame:
    return df.withColumn("path", plain_path(F.col("_metadata.file_path"), encoded=True))


def metadata_pattern(lib_dir: str) -> str:
    return f"{lib_dir}/*/extract_*/metadata.parquet"


def image_pattern(lib_dir: str) -> str:
    return f"{lib_dir}/*.D/extract_*/data.parquet"


def read_run_metadata(spark: SparkSession, lib_dir: str) -> DataFrame:
    """Metadata of all runs in one scan, as text, with the extract folder as path."""
    raw = _read(spark, metadata_pattern(lib_dir))
    columns = T._parse_datatype_string(schemas.RUN_METADATA_SOURCE).names
    require_columns(raw, columns, "run metadata")
    df = _with_source(raw).select(*[named(c).cast("string") for c in columns], "path")
    return df.withColumn("path", parent_dir(F.col("path")))


def read_images(
    spark: SparkSession, lib_dir: str, wavelengths: Sequence[str] | None = None,
    files: Sequence[str] | None = None,
) -> DataFrame:
    """Wide images of all runs, with their file as path.

    Without ``wavelengths`` the columns of all files are merged, which reads every footer; a run
    has nulls where another run's wavelength is missing. ``files`` limits the scan to those files.
    """
    if files is not None and not files:
        kinds = ["id string", "mins double", *[f"`{w}` double" for w in wavelengths or ()], "path string"]
        return spark.createDataFrame([], ",".join(kinds))
    sources = list(files) if files else [image_pattern(lib_dir)]
    try:
        if wavelengths is None:
            return _with_source(spark.read.option("mergeSchema", "true").parquet(*sources))
        kinds = ["id string", "mins double", *[f"`{w}` double" for w in wavelengths]]
        return _with_source(spark.read.schema(",".join(kinds)).parquet(*sources))
    except AnalysisException as error:
        raise QualityError(f"no images at {sources[0]}") from error


def read_landed_images(
    spark: SparkSession, path: str, wavelengths: Sequence[str] | None = None, key: str = "runid",
    groups: int | None = None,
) -> DataFrame:
    """Wide images as ``write_runs`` lands them, the run's key in front, as text. ``groups``: those they were landed with.

    The key is a partition column: a filter of runs, or a join with a filtered table of runs, leaves the folders of all
    other runs unread. Without ``wavelengths`` the columns of all files are merged.
    """
    try:
        if wavelengths is None:
            found = spark.read.option("mergeSchema", "true").parquet(path).schema
            # an inferred type would turn '00' into 0
            kinds = T.StructType([T.StructField(key, T.StringType()) if f.name == key else f for f in found])
        else:
            signals = [T.StructField(w, T.DoubleType()) for w in wavelengths]
            kinds = T._parse_datatype_string(f"{key} string, id string, mins double")
            kinds = T.StructType([*kinds.fields, *signals])
        if groups and "run_group" not in kinds.names:
            kinds = T.StructType([*kinds.fields, T.StructField("run_group", T.IntegerType())])
        images = spark.read.schema(kinds).parquet(path)
        images = images.drop("run_group") if groups else images
    except AnalysisException as error:
        raise QualityError(f"no landed images at {path}") from error
    return images.select(key, *[named(c) for c in images.columns if c != key])


def file_columns(spark: SparkSession, pattern: str) -> DataFrame:
    """Column names and types of each parquet file: (path, columns, types).

    Tasks read the footers; the driver only lists the files.
    """

    def footers(batches):
        from urllib.parse import quote

        import pandas as pd
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for path in batch["path"]:
                if "://" in path:
                    scheme, rest = path.split("://", 1)
                    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
                    system, name = fs.FileSystem.from_uri(f"{scheme}://{quote(rest)}")
                else:
                    system, name = fs.LocalFileSystem(), path
                schema = pq.read_schema(name, filesystem=system)
                found.append((path, schema.names, [str(t) for t in schema.types]))
            yield pd.DataFrame(found, columns=["path", "columns", "types"])

    files = spark.read.format("binaryFile").load(pattern)
    paths = files.select(plain_path(F.col("path"), encoded=False).alias("path"))
    return paths.mapInPandas(footers, "path string, columns array<string>, types array<string>")


def image_extents(spark: SparkSession, lib_dir: str) -> DataFrame:
    """Per image file: first and last wavelength and number of columns, id and mins included."""
    files = file_columns(spark, image_pattern(lib_dir))
    names = F.col("columns")
    return files.select(
        "path",
        F.element_at(names, 3).cast("double").cast("int").alias("nm_min"),
        F.element_at(names, -1).cast("double").cast("int").alias("nm_max"),
        F.size(names).alias("nm_count"),
        (F.size(names) - 2).alias("n_wavelengths"),
    )


def schema_kinds(spark: SparkSession, pattern: str) -> DataFrame:
    """The different schemas of the files: (columns, types, path of one such file, n files)."""
    files = file_columns(spark, pattern)
    return files.groupBy("columns", "types").agg(F.min("path").alias("path"), F.count("*").alias("n"))


def require_same_schema(spark: SparkSession, pattern: str) -> None:
    """Raise if the files differ in columns, their order or their types."""
    sample = schema_kinds(spark, pattern).orderBy(F.desc("n")).limit(3).collect()
    if len(sample) > 1:
        shown = "; ".join(f"{row['n']} files like {row['path']}: {row['columns']}" for row in sample)
        raise QualityError(f"files of {pattern} differ in schema: {shown}")


def landed_image(matrix: DataFrame, key: str = "id", time: str = "mins") -> DataFrame:
    """Decoded detector matrix as an image: key, times from zero, then the wavelengths."""
    from tracehouse.operators.traces import image_columns, rezero_time

    wavelengths = image_columns(matrix, (key, time))
    return rezero_time(matrix, key, time).select(key, time, *map(named, wavelengths))


def merge_metadata(
    detector: DataFrame, run: DataFrame, key: str, drop: Sequence[str] = ("unit", "vendor", "signal")
) -> DataFrame:
    """Run metadata over detector metadata (the run's value wins), with canonical column names."""
    shared = [c for c in detector.columns if c in run.columns and c != key]
    joined = detector.drop(*shared, *drop).join(run.drop(*drop), key)
    return joined.toDF(*[c.lower().replace(" ", "_") for c in joined.columns])
