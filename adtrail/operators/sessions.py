"""Sessions from events: a gap longer than the timeout starts a new one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.functions.measures import mean, safe_div
from adtrail.functions.text import hour_label
from adtrail.operators.timeline import carry_last, micros, with_segments


def sessionize(events: DataFrame, gap_minutes: int = 30, key: str = "user_id", time: str = "ts", id: str = "event_id") -> DataFrame:
    """One row per session: start, end, duration, pageviews, purchases, value."""
    rows = events.select(
        key, F.col(time).alias("ts"), F.col(id).alias("id"), "event_type", "value", micros(time).alias("t")
    )
    order = ["t", "id"]
    rows = with_segments(rows, [key], order)
    previous = carry_last(rows, [key], order, F.col("t"), "previous_t", inclusive=False)
    opens = F.col("previous_t").isNull() | (F.col("t") - F.col("previous_t") > F.lit(gap_minutes * 60_000_000))
    marked = carry_last(previous, [key], order, F.when(opens, F.col("t")), "start_t")
    purchase = F.col("event_type") == "purchase"
    return (
        marked.groupBy(key, "start_t")
        .agg(
            F.min("ts").alias("session_start_time"),
            F.max("ts").alias("session_end_time"),
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("event_type") == "view").alias("pageviews_count"),
            F.count_if(purchase).alias("conversions"),
            F.coalesce(F.sum(F.when(purchase, F.col("value"))), F.lit(0)).alias("conversion_value"),
            ((F.max("t") - F.min("t")) / F.lit(1_000_000)).alias("time_on_site_seconds"),
        )
        .withColumn("is_conversion_session", F.col("conversions") > 0)
        .drop("start_t")
    )


def engagement_by_hour(sessions: DataFrame, bot_flag: str | None = None) -> DataFrame:
    """Hourly pageviews, mean duration and bounce rate; bot sessions are left out."""
    people = sessions.where(~F.coalesce(F.col(bot_flag), F.lit(False))) if bot_flag else sessions
    hour = F.hour("session_start_time")
    return (
        people.groupBy(F.to_date("session_start_time").alias("date_start"), hour.alias("hour_start"))
        .agg(
            F.count(F.lit(1)).alias("total_sessions"),
            F.sum("pageviews_count").alias("total_pageviews"),
            mean("time_on_site_seconds").alias("avg_session_duration_seconds"),
            safe_div(F.count_if(F.col("events") == 1), F.count(F.lit(1)), 100, 4).alias("bounce_rate"),
        )
        .withColumn("hour_window", hour_label("hour_start"))
    )
