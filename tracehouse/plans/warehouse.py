"""The written tables of a warehouse and the views derived from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tracehouse.operators import exclusion, program
from tracehouse.operators.quality import QualityError
from tracehouse.operators.reports import describe_tables
from tracehouse.plans import runs
from tracehouse.schemas import TABLES

VIEWS = ("gradients", "counts_per_gradient", "inc_chm", "inc_img_stats", "run_data_paths", "sample_metadata")


@dataclass(frozen=True)
class Warehouse:
    """Tables under ``out``, and the library folder whose images they describe.

    ``landed``: the images lie there as ``write_runs`` lands them, in a folder for each run key, or in
    ``groups`` folders.
    """

    spark: SparkSession
    out: str
    lib_dir: str
    landed: bool = False
    groups: int | None = None

    def table(self, name: str) -> DataFrame:
        schema = TABLES[name].schema if name in TABLES else None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.parquet(f"{self.out}/{name}")
        except AnalysisException as error:
            raise QualityError(f"table {name} not found under {self.out}; build the warehouse first") from error

    def view(self, name: str) -> DataFrame:
        """Lazy view, following later changes of the excluded table."""
        if name == "gradients":
            return program.run_gradients(self.table("solvprop_over_mins"), check=False)
        if name == "counts_per_gradient":
            return program.counts_per_gradient(self.view("gradients"))
        if name == "inc_chm":
            return exclusion.without(self.table("chm"), self.table("excluded"))
        if name == "inc_img_stats":
            return exclusion.without(self.table("image_stats"), self.table("excluded"))
        if name == "run_data_paths":
            return exclusion.run_data_paths(self.view("inc_chm"))
        if name == "sample_metadata":
            tables = [self.table(t) for t in ("chm", "st", "ct", "excluded")]
            return runs.run_metadata(*tables)
        raise ValueError(f"unknown view {name!r}; there are {VIEWS}")

    def tables(self) -> dict[str, DataFrame]:
        """The tables that were written, by name."""
        found = {}
        for name in (*TABLES, "st_not_in_ct"):
            try:
                found[name] = self.table(name)
            except QualityError:
                continue  # intermediate forms are not all written
        return found

    def register_views(self) -> None:
        """Make every table and view available to SQL."""
        for name, table in self.tables().items():
            table.createOrReplaceTempView(name)
        for name in VIEWS:
            self.view(name).createOrReplaceTempView(name)

    def describe(self) -> DataFrame:
        """Columns of every table."""
        return describe_tables(self.tables())
