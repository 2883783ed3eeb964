"""Tables written between two steps of a run, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from adtrail.session import checkpoint_folder


def staging_path(spark: SparkSession, label: str) -> str:
    """A folder of its own under ``spark.checkpoint.dir``.

    Only where that setting is absent and the master is local does a local folder serve.
    """
    local = spark.conf.get("spark.master", "").startswith("local[")
    folder = checkpoint_folder(spark, f"{tempfile.gettempdir()}/adtrail-staging" if local else None)
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under ``spark.checkpoint.dir`` and read back: computed once, and nothing is lost with an executor."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
