"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "candlewick", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC clock, adaptive execution and Arrow transfer.

    Shuffle width is left to the cluster (adaptive execution coalesces it) unless given in ``conf``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local["):
        ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers need not have it installed."""
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="candlewick-ship-")  # read by the driver, which serves it to the executors
    archive = shutil.make_archive(os.path.join(folder, "candlewick"), "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names, a temporary one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="candlewick-checkpoint-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(folder)
    return folder
