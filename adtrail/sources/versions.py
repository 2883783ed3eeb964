"""Tables that change in whole versions: upserts, loads of what is new, and backfills.

``data/<load>/_part=<value>/`` holds the rows of a partition as one load left them; such files never change.
``versions/<number>/`` lists the folder of every partition and the mark up to which the source has been read. A load writes
its data first and then renames its list into place as the next number, which fails where that number exists. So a reader
sees a version whole or not at all, a load that breaks off before the rename has changed nothing, and of two loads at
once the later one starts again from the version that the earlier one made.

Rows of one key must stay in one partition. Of several rows of a key the highest version stays, whatever the order in which
they come: a load that is repeated, overlaps another or fills an old window gives the same table. Old loads may be removed
by age once no reader is on their versions. Lists are as long as the table has partitions.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adtrail.sources.sinks import latest_per_key

LISTED = "part string, folder string, mark timestamp"


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the newest version; None where there is no table yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n) for n in names if n.isdigit()), default=None)


def listed(spark: SparkSession, path: str, version: int | None) -> DataFrame:
    """(part, folder, mark) of a version. The row without a part carries the mark alone."""
    if version is None:
        return spark.createDataFrame([], LISTED)
    return spark.read.schema(LISTED).parquet(f"{path}/versions/{version}")


def read_version(spark: SparkSession, path: str, schema: StructType, version: int | None = None, parts: DataFrame | None = None) -> DataFrame:
    """Rows of a version (the newest unless one is named), of all partitions or those in ``parts``."""
    version = newest_version(spark, path) if version is None else version
    rows = listed(spark, path, version).where("part IS NOT NULL")
    if parts is not None:
        rows = rows.join(parts, "part", "left_semi")
    folders = [f"{path}/data/{r.folder}/_part={r.part}" for r in rows.collect()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _publish(spark: SparkSession, staged: str, final: str) -> bool:
    """Rename ``staged`` to ``final``; False where ``final`` exists."""
    jvm = spark._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, final))
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target.getParent())
    options = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(source, target, options)
    except (Py4JJavaError, PySparkException) as refused:
        if "FileAlreadyExistsException" not in str(refused):
            raise
        return False
    return True


def put(
    incoming: DataFrame, path: str, key: list[str], by: str, version: Column, mark: Column | None = None, attempts: int = 5
) -> int:
    """Put ``incoming`` over the stored rows: of each key the row with the highest ``version`` stays. The number of the new version.

    Only partitions that ``incoming`` meets are written. ``by`` is a date or a whole number; null is a partition of its own.
    """
    spark = incoming.sparkSession
    if dict(incoming.dtypes)[by] not in ("date", "int", "bigint"):
        raise ValueError(f"{by!r} must be a date or a whole number")
    part = F.coalesce(F.col(by).cast("string"), F.lit("none"))
    for _ in range(attempts):
        base, load = newest_version(spark, path), uuid.uuid4().hex
        touched = incoming.select(part.alias("part")).distinct()
        stored = read_version(spark, path, incoming.schema, base, touched)
        merged = latest_per_key(stored.unionByName(incoming), key, version)
        # Days of any size: adaptive execution splits large ones and joins small ones.
        merged.withColumn("_part", part).hint("rebalance", "_part").write.partitionBy("_part").parquet(f"{path}/data/{load}")
        before = listed(spark, path, base)
        new = spark.read.schema("_part string").parquet(f"{path}/data/{load}").select(F.col("_part").alias("part")).distinct()
        reached = before.agg(F.max("mark").alias("mark")).select(F.greatest("mark", F.lit(None).cast("timestamp") if mark is None else mark).alias("mark"))
        rows = before.where("part IS NOT NULL").join(new, "part", "left_anti").select("part", "folder").union(new.select("part", F.lit(load)))
        rows = rows.withColumn("mark", F.lit(None).cast("timestamp")).union(reached.select(F.lit(None), F.lit(None), "mark"))
        staged, number = f"{path}/staged/{load}", (base or 0) + 1
        rows.coalesce(1).write.parquet(staged)
        if _publish(spark, staged, f"{path}/versions/{number}"):
            return number
    raise RuntimeError(f"{attempts} other loads came first")


def mark_of(spark: SparkSession, path: str) -> Column:
    """Up to where the source has been read, as a constant; null at the start."""
    micros = listed(spark, path, newest_version(spark, path)).agg(F.unix_micros(F.max("mark"))).head()[0]
    return F.timestamp_micros(F.lit(micros).cast("long"))


def load_new(source: DataFrame, path: str, key: list[str], by: str, updated: str = "updated_at", lag: str = "1 hour") -> int | None:
    """Load the rows of ``source`` that are newer than ``lag`` behind the mark; the number of the new version, None if there are none.

    The mark is the highest ``updated`` seen and is stored with the rows, in the same rename. Rows that come up to ``lag``
    late are met by the overlap; older ones need ``backfill``. Rows without ``updated`` are read every time and yield to
    any other row of their key; of rows with one time the greatest in the order of its columns stays.
    """
    spark = source.sparkSession
    if newest_version(spark, path) is not None:
        after = mark_of(spark, path) - F.expr(f"INTERVAL {lag}")
        source = source.where(after.isNull() | F.col(updated).isNull() | (F.col(updated) >= after))
    reached = source.agg(F.unix_micros(F.max(F.col(updated).cast("timestamp"))).alias("top"), F.count(F.lit(1)).alias("n")).head()
    if not reached["n"]:
        return None
    return put(source, path, key, by, _newest(source, updated), F.timestamp_micros(F.lit(reached["top"]).cast("long")))


def backfill(source: DataFrame, path: str, key: list[str], by: str, start: str, end: str, updated: str = "updated_at") -> int:
    """Load rows with ``updated`` from ``start`` up to ``end`` (left out) again; the mark stays."""
    window = source.where((F.col(updated) >= F.lit(start).cast("timestamp")) & (F.col(updated) < F.lit(end).cast("timestamp")))
    return put(window, path, key, by, _newest(source, updated))


def _newest(source: DataFrame, updated: str) -> Column:
    return F.struct(F.col(updated), *[F.col(c) for c in source.columns if c != updated])
