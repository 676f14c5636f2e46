"""The whole build, from landed inputs to the warehouse."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tracehouse.operators import exclusion, program
from tracehouse.operators.quality import QualityError, require_rows, validate
from tracehouse.operators.traces import STATS_WAVELENGTH, image_stats
from tracehouse.plans.catalogue import clean_catalogue
from tracehouse.plans.register import load_register
from tracehouse.plans.runs import registered_runs, sequences, stage_runs
from tracehouse.plans.warehouse import Warehouse
from tracehouse.schemas import TABLES
from tracehouse.sources import tables as sources
from tracehouse.sources.sinks import write_parquet, write_table
from tracehouse.sources.xml import pump_tables, read_methods

logger = logging.getLogger(__name__)


class _Builder:
    """Writes tables in dependency order and checks each as it was written."""

    def __init__(self, out: str, overwrite: bool, check: bool):
        self.out, self.overwrite, self.check = out, overwrite, check
        self.written: dict[str, DataFrame] = {}

    def add(self, name: str, df: DataFrame) -> DataFrame:
        logger.info("writing %s", name)
        table = write_table(df, TABLES[name], self.out, self.overwrite)
        if self.check:
            validate(table, TABLES[name], self.written)
        self.written[name] = table
        return table


def load_pump_tables(builder: _Builder, runs: DataFrame, composition: DataFrame, timetable: DataFrame) -> None:
    """Attach run keys to the parsed pump tables and write their normal forms."""
    keys = runs.select("id", "runid")
    solvcomps = builder.add("solvcomps", composition.join(keys, "id"))
    timetables = builder.add("timetables", timetable.join(keys, "id"))
    builder.add("bin_pump_mech_params", program.mechanical_params(timetables))
    builder.add("solvents", program.solvents(solvcomps))
    builder.add("solvprop_over_mins", program.solvent_program(timetables, solvcomps))


def load_image_stats(builder: _Builder, images: DataFrame, extents: DataFrame) -> DataFrame:
    """Statistics of the images' trace, with the wavelength extent of each file."""
    if "chm" not in builder.written:
        raise QualityError("image statistics need the chm table")
    trace = image_stats(images, ["id", "path"])
    stats = trace.drop(*[c for c in extents.columns if c != "path"]).join(extents, "path")
    return builder.add("image_stats", stats.join(builder.written["chm"].select("id", "runid"), "id"))


def exclude_runs(runs: DataFrame, gradients: DataFrame, listed: Iterable[Mapping[str, str]] | DataFrame,
                 rules: Iterable[DataFrame] = ()) -> DataFrame:
    """Excluded runs: the listed ones, further rules' (runid, reason), then other gradients."""
    return exclusion.combine_rules(
        [exclusion.manual_rule(runs, listed), *rules, exclusion.gradient_rule(gradients)]
    )


def build_warehouse(
    spark: SparkSession, data_dir: str, register_path: str, catalogue_path: str, out: str, *,
    excluded: Iterable[Mapping[str, str]] | DataFrame = (), overwrite: bool = False,
    order: str = "time", check: bool = True, catalogue_format: str = "parquet",
) -> Warehouse:
    """Build every table from a library of run folders, a register and a catalogue export.

    Each table is written to shared storage and read back, so a lost executor never recomputes
    more than the table at hand. Constraints are checked on the written tables.
    """
    build = _Builder(out, overwrite, check)
    catalogue = build.add("ct", clean_catalogue(sources.read_catalogue(spark, catalogue_path, catalogue_format)))
    register, unmatched = load_register(sources.read_register(spark, register_path), catalogue)
    build.add("st", register)
    write_parquet(unmatched, f"{out}/st_not_in_ct", overwrite=overwrite)

    if check:
        sources.require_same_schema(spark, sources.metadata_pattern(data_dir))
    loading = build.add("chm_loading", stage_runs(sources.read_run_metadata(spark, data_dir), order))
    build.add("sequences", sequences(loading))
    runs = build.add("chm", registered_runs(loading, build.written["st"]))

    write_parquet(read_methods(spark, data_dir), f"{out}/pump_methods", overwrite=overwrite)
    load_pump_tables(build, runs, *pump_tables(spark.read.parquet(f"{out}/pump_methods")))
    gradients = program.run_gradients(require_rows(build.written["solvprop_over_mins"], "solvprop_over_mins"), False)

    images = sources.read_images(spark, data_dir, [STATS_WAVELENGTH])
    load_image_stats(build, images, sources.image_extents(spark, data_dir))
    build.add("excluded", exclude_runs(runs, gradients, excluded))
    return Warehouse(spark, out, data_dir)
