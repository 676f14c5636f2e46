"""Session defaults for local work; a cluster brings its own session."""

from __future__ import annotations

import os
import shutil
import sys
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, once an application, for functions that run in Python there."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parent
        base = Path(tempfile.mkdtemp(prefix="ship-")) / package.name
        archive = shutil.make_archive(str(base), "zip", root_dir=package.parent, base_dir=package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.

    Where it is unset, a local session takes a folder of its own; a cluster has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not chosen.isDefined():
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stage-"))
            chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = chosen.get()
    return folder.rstrip("/")


def local_session(cpus: int | str = "*", app: str = "tracehouse", **conf: str) -> SparkSession:
    """A local session. Every option here can be set in a cluster's own configuration instead."""
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a skewed join even where the aggregate above it then needs a shuffle of its own
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # plans with hundreds of columns: no call-site capture for each of their expressions
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
