"""Rendezvous hashing of record keys over weighted shards, with a gapless slot for every record of a shard.

Each (key, shard) pair gets a hash; the record goes to the shard with the best weighted score, ``-ln(u) / weight``
being least. Adding a shard only moves the records which the new shard wins. The score needs the key and the list of
shards alone, so no table is consulted and nothing is shuffled to place a record.

Slots follow the order of the key's own hash, then the key, then the other columns. Rows that agree in all columns are
counted first, before the shuffle too, and take slots in a row. The others are laid out by range over that order, so
a key or a shard with a large share of the rows spreads over many ranges; a slot is the number of rows in earlier
ranges of the shard plus the place within the range. Nothing depends on the order in which tasks meet their rows.

Defined cases: a null key is a key of its own; repeated rows go to one shard and get slots of their own; an empty
table gives no rows; columns of a type without an order (maps, variants) are refused. Only built-in functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adtrail.llm.store import fresh_folder, written


def key_text(key: str | Column) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))


def _unit(text: Column) -> Column:
    """Thirteen hex digits of the MD5 as a whole number of 52 bits: exact in a double."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def place(key: Column, weights: dict[int, float]) -> Column:
    """The shard of ``key`` among ``weights`` (shard number to weight over 0); on equal scores the lower number."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("shards need weights over 0")
    equal = len(set(weights.values())) == 1

    def cost(shard: int) -> Column:
        hashed = _unit(F.concat(key, F.lit(f"#{shard}")))
        if equal:  # the order of -ln(u) is that of -u
            return (-hashed).cast("double")
        return -F.log((hashed + F.lit(1)) / F.lit(float(2**52 + 1))) / F.lit(float(weights[shard]))

    return F.array_min(F.array(*[F.struct(cost(s).alias("cost"), F.lit(s).alias("shard")) for s in sorted(weights)]))["shard"]


def assign_shards(records: DataFrame, key: str, weights: dict[int, float], grown: dict[int, float] | None = None) -> DataFrame:
    """All columns of ``records`` and ``shard``, ``slot`` and, with ``grown``, the shard under that larger list.

    A column of ``records`` that bears one of these names is replaced.
    """
    spark, names = records.sparkSession, [c for c in records.columns if c not in ("shard", "slot", "grown_shard")]
    if key not in names:
        raise ValueError(f"{key!r} names a result column")
    if unordered := [c for c, kind in records.dtypes if c in names and ("map<" in kind or "variant" in kind)]:
        raise ValueError(f"columns without an order: {unordered}")
    placed = ["shard", *(["grown_shard"] if grown else [])]
    rows = records.select(
        *names, place(key_text(key), weights).alias("shard"), *([place(key_text(key), grown).alias("grown_shard")] if grown else [])
    )
    counted = rows.groupBy(*names, *placed).agg(F.count("*").alias("_rows")).withColumn("_order", F.md5(key_text(key)))
    order = ["_order", key, *[c for c in names if c != key]]
    laid = counted.repartitionByRange("shard", *order).withColumn("_range", F.spark_partition_id())
    laid = written(laid, fresh_folder(spark, "shards"))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid.groupBy("shard", "_range").agg(F.sum("_rows").alias("_sum"))  # no more rows than ranges plus shards
        .select("shard", "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("shard", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = laid.withColumn("_upto", F.sum("_rows").over(within)).join(offsets, ["shard", "_range"])
    last = F.col("_before") + F.col("_upto") - 1
    return numbered.select(*names, *placed, F.explode(F.sequence(last - F.col("_rows") + 1, last)).alias("slot")).select(
        *names, "shard", "slot", *placed[1:]
    )
