"""Writers: warehouse tables, per-run landings and cubes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracehouse.operators.quality import QualityError
from tracehouse.operators.reshape import column_sketches
from tracehouse.schemas import Table
from tracehouse.sources.staging import staged

CUBE_BUCKETS = 256
SKETCHES = "_sketches"
RUN_GROUP = "run_group"  # folder of the runs that share one


def write_table(
    df: DataFrame, table: Table, out: str, overwrite: bool = False, sketched: Sequence[str] = ()
) -> DataFrame:
    """Write a warehouse table and return it as read back, which also cuts its lineage.

    Sketches of the distinct values of the ``sketched`` columns are kept beside it, see ``read_sketches``.
    """
    path = f"{out}/{table.name}"
    mode = "overwrite" if overwrite else "errorifexists"
    table.conform(df).write.mode(mode).parquet(path)
    back = df.sparkSession.read.schema(table.schema).parquet(path)
    if sketched:
        column_sketches(back, sketched).write.mode(mode).parquet(f"{path}{SKETCHES}")
    return back


def read_sketches(spark: SparkSession, names: Sequence[str], out: str) -> DataFrame:
    """(column, sketch) of written tables, stacked: ``estimated_counts`` merges equal columns without a scan of the tables."""
    return spark.read.parquet(*[f"{out}/{name}{SKETCHES}" for name in names])


def write_parquet(df: DataFrame, path: str, columns: list[str] | None = None, overwrite: bool = False) -> None:
    selected = df.select(*columns) if columns else df
    selected.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def append_by_name(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` stacked under ``target``, columns matched by name."""
    return target.unionByName(df)


def save_to_catalog(spark: SparkSession, table: Table, out: str, database: str = "default") -> str:
    """Register a written table in the catalog, with its comments."""
    name = f"{database}.{table.name}"
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=f"{out}/{table.name}", source="parquet", schema=table.schema)
    if table.comment:
        spark.sql(f"COMMENT ON TABLE {name} IS :text", args={"text": table.comment})
    for column, text in table.column_comments.items():
        escaped = text.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN {column} COMMENT '{escaped}'")
    return name


def _existing_runs(df: DataFrame, path: str, key: str, groups: int | None) -> DataFrame | None:
    """Keys of the landed runs, as text: an inferred type would turn '00' into 0."""
    schema = T.StructType([T.StructField(key, T.StringType())] + ([T.StructField(RUN_GROUP, T.IntegerType())] if groups else []))
    try:
        return df.sparkSession.read.schema(schema).parquet(path).select(key).distinct()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_runs(
    df: DataFrame, path: str, key: str = "runid", overwrite: bool = False, order: str = "mins", groups: int | None = None
) -> None:
    """Land runs, one folder per run in time order, replacing only the runs that are written.

    A run that is there already is an error unless ``overwrite``. Rows are rebalanced by run, and
    AQE splits a run that is too large for one task. With ``groups``, runs share that many folders, told by their key's
    hash: for so many runs that their folders would cost more than their rows. A folder's runs lie one behind the other,
    so readers skip others by their statistics; a run is replaced by writing its group again. All landings of a path
    take the same ``groups``.
    """
    present = _existing_runs(df, path, key, groups)
    if present is not None and not overwrite:
        incoming = df.select(F.col(key).cast("string").alias(key)).distinct()
        clash = incoming.join(present, key, "left_semi").limit(3).collect()
        if clash:
            raise QualityError(f"runs exist already, e.g. {[row[0] for row in clash]}; use overwrite")
    folder = key
    if groups:
        folder = RUN_GROUP
        df = df.withColumn(key, F.nullif(F.col(key).cast("string"), F.lit(""))).withColumn(folder, run_group(F.col(key), groups))
        if present is not None:
            df = _with_neighbours(df, path, key)
    (
        df.hint("rebalance", folder)
        .sortWithinPartitions(*dict.fromkeys([folder, key, order]))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(folder)
        .parquet(path)
    )


def run_group(key: Column, groups: int) -> Column:
    """Folder of a run among ``groups``; null for none."""
    return F.when(key.isNotNull(), F.pmod(F.xxhash64(key.cast("string")), F.lit(groups)).cast("int"))


def _with_neighbours(df: DataFrame, path: str, key: str) -> DataFrame:
    """``df`` with the other landed runs of its groups, as they have to be written again with it."""
    incoming = staged(df, "runs")
    landed = df.sparkSession.read.option("mergeSchema", "true").parquet(path)
    kept = landed.join(incoming.select(RUN_GROUP).distinct(), RUN_GROUP, "left_semi")
    kept = kept.join(incoming.select(key).distinct(), key, "left_anti")
    return staged(incoming.unionByName(kept, allowMissingColumns=True), "runs")


def _bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key), buckets).cast("int")


def write_cube(
    cube: DataFrame, path: str, key: str = "runid", buckets: int = CUBE_BUCKETS, overwrite: bool = False
) -> None:
    """Write a long or array cube under a fixed number of run buckets, sorted for row-group pruning.

    Folders per run would be too many for a large library; within a bucket the sort order lets the
    reader skip the row groups of other runs. The number of buckets is part of the folders' names.
    """
    order = [c for c in (key, "wavelength", "idx") if c in cube.columns]
    bucketed = cube.withColumn("n_buckets", F.lit(buckets)).withColumn("run_bucket", _bucket(F.col(key), F.lit(buckets)))
    (
        bucketed.hint("rebalance", "run_bucket")
        .sortWithinPartitions("run_bucket", *order)
        .write.mode("overwrite" if overwrite else "errorifexists")
        .partitionBy("n_buckets", "run_bucket")
        .parquet(path)
    )


def read_cube(spark: SparkSession, path: str, runids: Sequence | None = None, key: str = "runid") -> DataFrame:
    """Read a written cube; for given runs only their buckets are opened, however many there are."""
    cube = spark.read.parquet(path)
    if runids is not None:
        kind = cube.schema[key].dataType
        wanted = [F.lit(r).cast(kind) for r in runids]
        here = reduce(or_, (F.col("run_bucket") == _bucket(w, F.col("n_buckets")) for w in wanted), F.lit(False))
        cube = cube.where(here & F.col(key).isin(wanted) if wanted else here)
    return cube.drop("n_buckets", "run_bucket")


def save_cube(
    cube: DataFrame, name: str, path: str, key: str = "runid", buckets: int = CUBE_BUCKETS, overwrite: bool = False
) -> DataFrame:
    """The cube as a catalog table in buckets of runs, sorted, and that table.

    A slice by runs opens the buckets of these runs alone, and a join or aggregate by run needs no shuffle of the cells.
    The files are under ``path``, which must be shared storage.
    """
    order = [c for c in (key, "wavelength", "idx") if c in cube.columns]
    (
        # dealt as the table's buckets are, so every bucket is one file
        cube.repartition(buckets, key)
        .write.mode("overwrite" if overwrite else "errorifexists")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(*order)
        .saveAsTable(name)
    )
    return cube.sparkSession.table(name)
