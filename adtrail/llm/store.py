"""Where operators keep intermediate tables: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a local one only where that is unset and the master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local["):
        return tempfile.gettempdir() + "/adtrail-shared"
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own for one run, so that a rerun never meets the files of an earlier one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, and a lost executor loses nothing."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Remove a table of this run that nothing will read again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
