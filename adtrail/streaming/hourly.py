"""Tumbling-hour metrics, sessions and incremental loads."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adtrail.functions.text import hour_label
from adtrail.session import checkpoint_folder
from adtrail.sources.sinks import upsert_partitions

HOURLY_EVENT_KEY = ["date_start", "hour_start", "ad_id"]


def hourly_metrics(events: DataFrame, time: str = "ts", by: tuple[str, ...] = ("ad_id",), hours: int = 1) -> DataFrame:
    """Impressions, clicks, spend, purchases and value per tumbling window; batch or stream.

    The window is built on the time column as it is: a cast would hide the
    column's watermark, and a stream would then keep its state for ever.
    """
    kind = F.col("event_type")
    paid = kind.isin("view", "click")
    return (
        events.groupBy(F.window(time, f"{hours} hour"), *by)
        .agg(
            F.count_if(kind == "view").alias("impressions"),
            F.count_if(kind == "click").alias("clicks"),
            F.coalesce(F.sum(F.when(paid, F.col("value"))), F.lit(0)).alias("spend"),
            F.count_if(kind == "purchase").alias("purchases"),
            F.coalesce(F.sum(F.when(kind == "purchase", F.col("value"))), F.lit(0)).alias("revenue"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.to_date("window.start").alias("date_start"),
            F.hour("window.start").alias("hour_start"),
            hour_label(F.hour("window.start")).alias("hour_window"),
            *by, "impressions", "clicks", "spend", "purchases", "revenue",
        )
    )


def watermarked(stream: DataFrame, time: str = "ts", late: str = "1 hour", id: str | None = "event_id") -> DataFrame:
    """Rows up to ``late`` behind the newest are taken; repeats of an id inside that span are dropped."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.dropDuplicatesWithinWatermark([id]) if id else timed


def stream_sessions(events: DataFrame, gap_minutes: int = 30, key: str = "user_id", time: str = "ts") -> DataFrame:
    """Sessions closed by a gap, for streams (state per open session only)."""
    return (
        events.groupBy(F.session_window(F.col(time), f"{gap_minutes} minutes"), key)
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("event_type") == "view").alias("pageviews_count"),
            F.count_if(F.col("event_type") == "purchase").alias("conversions"),
            F.min(time).alias("session_start_time"),
            F.max(time).alias("session_end_time"),
        )
        .drop("session_window")
    )


def with_ad_names(metrics: DataFrame, ad_dimension: DataFrame) -> DataFrame:
    """Stream-static join with the ad dimension; unknown ads stay."""
    return metrics.join(ad_dimension, "ad_id", "left")


def incremental(
    stream: DataFrame,
    name: str,
    handle: Callable[[DataFrame, int], None],
    checkpoint_default: str | None = None,
    once: bool = True,
    every: str = "1 minute",
    mode: str = "update",
) -> StreamingQuery:
    """Run ``handle`` on each micro-batch, from where the last run stopped.

    With ``once`` all data there is gets taken in bounded batches and the query
    ends: the form for scheduled runs and for backfills. Progress and state live
    in the shared checkpoint folder, so a lost executor or a new run resumes.
    """
    folder = f"{checkpoint_folder(stream.sparkSession, checkpoint_default)}/{name}"
    writer = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", folder).queryName(name)
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()


def upsert_hours(path: str, key: list[str] = HOURLY_EVENT_KEY) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler that puts hourly rows over stored ones; a repeated batch changes nothing."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        # An empty batch touches no partition.
        upsert_partitions(batch.sparkSession, batch, path, key)

    return handle


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late and were dropped, over the query's known progress."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0))
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )


def read_table_stream(spark: SparkSession, schema, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
