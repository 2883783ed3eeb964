"""Live attribution: a stream of orders meets a stream of touches, and then the ad dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.streaming.hourly import with_ad_names


def live_last_click(
    touches: DataFrame, conversions: DataFrame, days: int = 30, dims=("campaign_id", "ad_id"), late: str = "1 hour"
) -> DataFrame:
    """One row per order: the last touch of its look-back, or nulls where there was none. Batch or stream.

    touches(user_id, touch_id, touch_time, <dims>), conversions(user_id, order_id, order_time, order_value). Both sides
    may come up to ``late`` behind their newest row. A touch is held for the look-back and an order until its touches
    can no longer come, so state is bounded by time; an order is put out once, when the watermark has passed it. Rows
    without a user are one anonymous user's, as in the batch models; an order that is repeated counts once.
    """
    dims = list(dims)
    t = touches.select(
        F.col("user_id").alias("_user"), "touch_id", F.col("touch_time").cast("timestamp").alias("touch_time"), *dims
    ).withWatermark("touch_time", late)
    c = conversions.withColumn("order_time", F.col("order_time").cast("timestamp")).withWatermark("order_time", late)
    met = c.join(
        t,
        F.col("user_id").eqNullSafe(F.col("_user"))
        & (F.col("touch_time") <= F.col("order_time"))
        & (F.col("touch_time") >= F.col("order_time") - F.expr(f"interval {days} days")),
        "left",
    )
    touch = F.struct("touch_id", "touch_time", *dims)
    newest = F.struct("touch_time", F.col("touch_id").cast("string"))
    last = met.groupBy("order_id", "user_id", "order_time", "order_value").agg(
        F.max_by(touch, F.when(F.col("touch_time").isNotNull(), newest)).alias("touch")
    )
    return last.select("order_id", "order_time", "order_value", "user_id", "touch.*", F.lit("last_click").alias("attribution_model"))


def live_named(touches: DataFrame, conversions: DataFrame, ad_dimension: DataFrame, days: int = 30, late: str = "1 hour") -> DataFrame:
    """Live last-click orders with the names of their ads; ``ad_dimension`` (ad_id, ...) is a table, read anew in each batch."""
    return with_ad_names(live_last_click(touches, conversions, days, late=late), ad_dimension)
