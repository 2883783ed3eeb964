"""Session settings the library relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# UTC keeps wall-clock timestamps stable; adaptive execution picks join sides
# from measured sizes and splits skewed join partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # No Python call site per Column: plans build several times faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "adtrail", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster use the one given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(os.cpu_count() or 8),
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession, default: str | None = None) -> str:
    """The shared folder for checkpoints and streaming state.

    The cluster names it in ``spark.checkpoint.dir``; ``default`` is used only
    where that is unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or default
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder
