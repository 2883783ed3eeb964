"""Running sums and carried values along each key's timeline, safe for hot keys.

A window partitioned by a user alone puts a hot user's whole history into one
task. Here all timelines, end to end, are cut by rows into ranges of about equal
size, and a segment is what one range holds of one key. A small table holds one
row per key and segment, prefixes run over that table, and the row-level window
runs inside (key, segment). The largest task holds one range, however crowded an
hour of a key is, and the largest prefix one row per range. Every frame starts at
the segment's first row, so the work is linear; no pair of rows is ever formed.

The cut rows are written once to the shared folder, so that every later step sees
the same ranges and the source is read once.

Rows with a null key are a group of their own and stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtrail.sources.staging import staged

SEGMENT = "_segment"


def micros(ts) -> Column:
    """Microseconds since the epoch; a zone-less time is taken as it stands, in any session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    second = F.floor(F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("long")
    minutes = (F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    wall = minutes * F.lit(60_000_000) + second
    return F.when(F.typeof(ts) == "timestamp_ntz", wall).otherwise(F.unix_micros(ts.cast("timestamp")))


def with_segments(df: DataFrame, keys: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """Cut rows, sorted by keys and ``order``, into ``ranges``; add each row's segment and lay rows out by (key, segment).

    Segment numbers grow along a key's order. Only rows that agree in keys and order can't be parted.
    """
    count = ranges or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(count, *keys, *order).withColumn(SEGMENT, F.spark_partition_id())
    return staged(cut, "timeline").repartition(*keys, SEGMENT)


def _met(df: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Each row with what its segment starts from; null keys meet null keys."""
    named = carried.withColumnsRenamed({c: f"_of_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys])
    return df.join(named, same).drop(*[f"_of_{c}" for c in keys])


def _orders(order: list[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def carry_last(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    out: str,
    inclusive: bool = True,
    descending: bool = False,
) -> DataFrame:
    """The latest non-null ``value`` up to each row (``descending``: the next one after it).

    ``df`` must carry the segment column; ``order`` sorts rows inside a key and
    must agree with the segments.
    """
    df = df.withColumn("_value", value)
    pick = F.min_by if descending else F.max_by
    tails = df.groupBy(*keys, SEGMENT).agg(
        pick("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_tail"),
    )
    before = (
        Window.partitionBy(*keys)
        .orderBy(*_orders([SEGMENT], descending))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = tails.select(*keys, SEGMENT, F.last("_tail", True).over(before).alias("_carry"))
    inside = (
        Window.partitionBy(*keys, SEGMENT)
        .orderBy(*_orders(order, descending))
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        _met(df, carried, [*keys, SEGMENT])
        .withColumn(out, F.coalesce(F.last("_value", True).over(inside), F.col("_carry")))
        .drop("_value", "_carry")
    )


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column],
    kind: str = "double",
    descending: bool = False,
) -> DataFrame:
    """Running totals of type ``kind`` up to and including each row (``descending``: back to it)."""
    parts = {f"_part_{name}": name for name in sums}
    for part, name in parts.items():
        df = df.withColumn(part, sums[name])
    totals = df.groupBy(*keys, SEGMENT).agg(*[F.sum(p).alias(f"_seg{p}") for p in parts])
    before = (
        Window.partitionBy(*keys)
        .orderBy(*_orders([SEGMENT], descending))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = totals.select(
        *keys, SEGMENT, *[F.sum(f"_seg{p}").over(before).alias(f"_carry{p}") for p in parts]
    )
    inside = (
        Window.partitionBy(*keys, SEGMENT)
        .orderBy(*_orders(order, descending))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = _met(df, carried, [*keys, SEGMENT])
    for part, name in parts.items():
        local, carry = F.sum(part).over(inside), F.col(f"_carry{part}")
        zero = F.lit(0).cast(kind)
        joined = joined.withColumn(
            name, F.coalesce(local.cast(kind), zero) + F.coalesce(carry.cast(kind), zero)
        )
    return joined.drop(*parts, *[f"_carry{p}" for p in parts])
