"""Serving: images of included runs, re-gridded, as a cube or beside their metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracehouse.functions.columns import named
from tracehouse.operators.quality import require_rows
from tracehouse.operators.traces import CUBE_ROWS, cube, regrid_time
from tracehouse.plans.warehouse import Warehouse
from tracehouse.sources.tables import read_images, read_landed_images

OUTPUTS = ("cube", "pairs")


def fetch_images(
    warehouse: Warehouse, runids: Sequence[str] | None = None, wavelengths: Sequence[str] | None = None
) -> DataFrame:
    """Images of included runs with runid and path in front; excluded runs are silently absent.

    For listed runs only their files are opened. Otherwise the library is scanned once and joined
    to the paths. Landed images have no path: the run's key is a partition column, and the join with
    the included runs prunes their folders while the query runs. Runs in groups have theirs in the files, in order.
    """
    if warehouse.landed:
        included = warehouse.view("inc_chm").select("runid")
        if runids:
            included = included.where(F.col("runid").isin(list(runids)))
        images = read_landed_images(warehouse.spark, warehouse.lib_dir, wavelengths, groups=warehouse.groups)
        return images.join(included, "runid", "left_semi")
    paths = warehouse.view("run_data_paths")
    if runids:
        wanted = paths.where(F.col("runid").isin(list(runids)))
        # at most as many rows as the caller listed
        files = [row["data_path"] for row in wanted.select("data_path").collect()]
        images = read_images(warehouse.spark, warehouse.lib_dir, wavelengths, files)
        paths = wanted
    else:
        images = read_images(warehouse.spark, warehouse.lib_dir, wavelengths)
    keyed = images.join(paths.select("runid", F.col("data_path").alias("path")), "path")
    return keyed.select("runid", "path", *[named(c) for c in images.columns if c != "path"])


def get_data(
    warehouse: Warehouse, output: str = "cube", runids: Sequence[str] | None = None, *,
    rows: int = CUBE_ROWS, form: str = "array", wavelengths: Sequence[str] | None = None,
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Signals of the included runs, or of those of ``runids`` that are included.

    ``cube`` gives equal-length runs with the metadata on every row; ``pairs`` gives (images,
    metadata), both keyed by runid. Choosing ``wavelengths`` keeps the others from being read.
    """
    if output not in OUTPUTS:
        raise ValueError(f"output must be one of {OUTPUTS}, got {output!r}")
    require_rows(warehouse.view("inc_chm"), "inc_chm")
    images = fetch_images(warehouse, runids, wavelengths)
    metadata = warehouse.view("sample_metadata")
    if runids:
        metadata = metadata.where(F.col("runid").isin(list(runids)))
    # the rows of each run were counted when its statistics were written
    most = warehouse.table("image_stats").agg(F.max("mins_count")).first()[0]
    if output == "pairs":
        return regrid_time(images, "runid", most_rows=most), metadata
    if warehouse.landed:
        return cube(images, metadata, rows=rows, form=form, most_rows=most)
    paths = warehouse.view("run_data_paths").select("runid", F.col("data_path").alias("path"))
    return cube(images, metadata.join(paths, "runid"), rows=rows, form=form, most_rows=most)
