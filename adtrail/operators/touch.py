"""Single- and multi-touch attribution over a look-back window.

Inputs:  touches(user_id, touch_id, touch_time, <dimensions>)
         conversions(user_id, order_id, order_time, order_value)

A touch earns credit from the conversions that follow it within the look-back.
Linear and time-decay credit is a difference of two running totals per touch,
so a user with a billion touches costs a sort, not touches x conversions rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.operators.timeline import carry_last, micros, running_sums, with_segments

DAY_US = 86_400_000_000
MODELS = ["first_click", "last_click", "linear", "time_decay"]
# Order of rows that share an instant: a touch counts for a conversion at the
# same instant, and still counts at exactly the end of the look-back.
PROBE, TOUCH, CONVERSION, EXPIRY = -1, 0, 1, 2
ORDER = ["t", "rank", "id"]
# Half-lives that the weights of one block may span: 2^900 leaves a double room for sums.
MOST_HALF_LIVES = 900


def _touch_rows(touches: DataFrame, dims: list[str]) -> DataFrame:
    return touches.select(
        "user_id",
        micros("touch_time").alias("t"),
        F.lit(TOUCH).alias("rank"),
        F.col("touch_id").cast("string").alias("id"),
        F.struct("touch_id", "touch_time", *dims).alias("touch"),
    )


def _conversion_rows(conversions: DataFrame, rank: int, shift_us: int = 0) -> DataFrame:
    return conversions.select(
        "user_id",
        (micros("order_time") + F.lit(shift_us)).alias("t"),
        F.lit(rank).alias("rank"),
        F.col("order_id").cast("string").alias("id"),
        F.struct("order_id", "order_time", "order_value").alias("conversion"),
    )


def _one_touch(touches, conversions, days, dims, first: bool) -> DataFrame:
    if first:
        # Going back in time from the look-back's start, the touch met last is
        # the first one inside the window.
        probes = _conversion_rows(conversions, PROBE, -days * DAY_US)
    else:
        probes = _conversion_rows(conversions, CONVERSION)
    rows = _touch_rows(touches, dims).unionByName(probes, allowMissingColumns=True)
    rows = with_segments(rows, ["user_id"], ORDER)
    found = carry_last(rows, ["user_id"], ORDER, F.col("touch"), "chosen", descending=first)
    touch_t = micros(F.col("chosen.touch_time"))
    order_t = micros(F.col("conversion.order_time"))
    return found.where(
        F.col("conversion").isNotNull()
        & (touch_t <= order_t)
        & (order_t - touch_t <= F.lit(days * DAY_US))
    ).select(
        "conversion.*",
        "user_id",
        "chosen.*",
        F.lit("first_click" if first else "last_click").alias("attribution_model"),
        F.lit(1.0).alias("attribution_weight"),
        ((order_t - touch_t) / F.lit(DAY_US)).alias("age_days"),
    )


def first_click(touches, conversions, days: int = 30, dims=("campaign_id", "ad_id")) -> DataFrame:
    """One row per order that had a touch in the look-back: its first touch, weight 1."""
    return _one_touch(touches, conversions, days, list(dims), True)


def last_click(touches, conversions, days: int = 30, dims=("campaign_id", "ad_id")) -> DataFrame:
    """One row per order that had a touch in the look-back: its last touch, weight 1."""
    return _one_touch(touches, conversions, days, list(dims), False)


def _blocks(days: int, half_life_days: float) -> tuple[int, int]:
    """(microseconds of a block, microseconds of the look-back) such that weights inside a block fit a double."""
    reach, room = days * DAY_US, int(MOST_HALF_LIVES * half_life_days * DAY_US)
    if room < reach * 1.1:
        raise ValueError(f"a look-back of {days} days is over {int(MOST_HALF_LIVES / 1.1)} half-lives")
    return room - reach, reach


def shared_credit(
    touches: DataFrame,
    conversions: DataFrame,
    days: int = 30,
    half_life_days: float | None = None,
    dims=("campaign_id", "ad_id"),
) -> DataFrame:
    """Credit of every touch: equal parts, or halving per ``half_life_days`` of age.

    An order's touches carry weights that sum to 1. With touch weight w (1, or
    2^(time / half life)) and A the sum of w over the touches alive at a
    conversion, the touch's part of it is w / A. So its credit is
    w x (sum of value / A over the conversions of its window).

    Under decay, time is counted from the start of a block of conversions, less
    the look-back, so weights fit a double at any date; a touch is a row in
    every block that its window meets. Rows without a user are one anonymous
    user's.
    """
    dims = list(dims)
    linear = half_life_days is None
    width, reach = (1, days * DAY_US) if linear else _blocks(days, half_life_days)
    block = lambda t: F.lit(0).cast("long") if linear else F.floor(t / F.lit(width)).cast("long")
    alive_for = F.sequence(block(F.col("t")), block(F.col("t") + F.lit(reach)))
    touch_rows = _touch_rows(touches, dims).withColumn("touch_t", F.col("t")).withColumn("_block", F.explode(alive_for))
    # One pass over the touches: each is a row where it begins and a row where it ends to count.
    ends = F.array(F.struct("t", F.lit(TOUCH).alias("rank")), F.struct((F.col("t") + F.lit(reach)).alias("t"), F.lit(EXPIRY).alias("rank")))
    touch_rows = touch_rows.withColumn("_end", F.explode(ends)).withColumns({"t": F.col("_end.t"), "rank": F.col("_end.rank")}).drop("_end")
    orders = _conversion_rows(conversions, CONVERSION).withColumn("_block", block(F.col("t")))
    rows = touch_rows.unionByName(orders, allowMissingColumns=True)
    keys = ["user_id", "_block"]
    rows = with_segments(rows, keys, ORDER)
    sign = F.when(F.col("rank") == TOUCH, 1).when(F.col("rank") == EXPIRY, -1)

    if linear:
        weight = F.lit(1.0)
        alive = {"alive": sign}
        # Parts are decimals, so differences of running totals are exact.
        part, kind = "decimal(22,12)", "decimal(36,12)"
        mass = F.col("alive").cast("double")
    else:
        origin = F.col("_block") * F.lit(width) - F.lit(reach)
        weight = F.pow(F.lit(2.0), (F.col("touch_t") - origin) / F.lit(half_life_days * DAY_US))
        alive = {"alive": sign, "mass": sign * weight}
        part = kind = "double"
        mass = F.col("mass")

    counted = running_sums(rows, keys, ORDER, alive)
    earning = (F.col("rank") == CONVERSION) & (F.col("alive") > 0)
    parts = {
        "value_after": F.when(earning, (F.col("conversion.order_value").cast("double") / mass).cast(part)),
        "orders_after": F.when(earning, (F.lit(1.0) / mass).cast(part)),
    }
    # Totals run from the end backwards: later parts are the smaller ones under
    # decay, so the difference keeps its precision.
    summed = running_sums(counted, keys, ORDER, parts, kind, descending=True)

    def gained(running: str):
        return F.sum(F.when(F.col("rank") == TOUCH, F.col(running)).otherwise(-F.col(running)))

    per_block = (
        summed.where(F.col("rank") != CONVERSION)
        .groupBy(*keys, F.col("touch.touch_id").alias("touch_id"))
        .agg(
            F.max("touch").alias("touch"),
            F.max("touch_t").alias("touch_t"),
            gained("value_after").cast("double").alias("value"),
            gained("orders_after").cast("double").alias("orders"),
        )
        .select("user_id", "touch", (weight * F.col("value")).alias("revenue"), (weight * F.col("orders")).alias("orders"))
    )
    if not linear:
        per_block = per_block.groupBy("user_id", "touch").agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    return per_block.select(
        "user_id",
        "touch.*",
        F.lit("linear" if linear else "time_decay").alias("attribution_model"),
        F.col("revenue").alias("credited_revenue"),
        F.col("orders").alias("credited_orders"),
    )


def linear(touches, conversions, days: int = 30, dims=("campaign_id", "ad_id")) -> DataFrame:
    return shared_credit(touches, conversions, days, None, dims)


def time_decay(touches, conversions, days: int = 30, half_life_days: float = 7.0, dims=("campaign_id", "ad_id")):
    return shared_credit(touches, conversions, days, half_life_days, dims)


def credit_by(
    touches, conversions, by: list[str], model: str = "last_click", days: int = 30, half_life_days: float = 7.0
) -> DataFrame:
    """Weighted orders and revenue by dimension under one attribution model."""
    if model in ("first_click", "last_click"):
        pick = first_click if model == "first_click" else last_click
        rows = pick(touches, conversions, days, by).select(
            *by,
            F.col("attribution_weight").alias("credited_orders"),
            (F.col("attribution_weight") * F.col("order_value").cast("double")).alias("credited_revenue"),
        )
    elif model == "linear":
        rows = linear(touches, conversions, days, by)
    elif model == "time_decay":
        rows = time_decay(touches, conversions, days, half_life_days, by)
    else:
        raise ValueError(f"unknown attribution model {model!r}; one of {MODELS}")
    return rows.groupBy(*by).agg(
        F.sum("credited_orders").alias("credited_orders"),
        F.sum("credited_revenue").alias("credited_revenue"),
    )


def last_click_windows(touches, conversions, by: list[str], windows=(1, 7, 28)) -> DataFrame:
    """Last-click orders and revenue by dimension for several look-back lengths, in one pass."""
    hits = last_click(touches, conversions, max(windows), by)
    inside = F.filter(F.array(*[F.lit(w) for w in windows]), lambda w: F.col("age_days") <= w)
    return (
        hits.select(*by, F.explode(inside).alias("window_days"), "order_value")
        .groupBy(*by, "window_days")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_value").alias("revenue"))
    )
