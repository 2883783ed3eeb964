"""The model's functions for spark.sql: a channel by rules, and the attribution of a period by a chosen model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.functions.channels import CHANNEL_RULES, RULE_OUTPUTS
from adtrail.functions.measures import half_up
from adtrail.operators import touch

ARGUMENTS = ["p_utm_source", "p_utm_medium", "p_utm_campaign", "p_utm_content"]
#: The hourly metrics hold the last click; the other models' credit comes from touches and orders.
CREDIT_MODELS = ["first_click", "linear", "time_decay"]
SLICE = ["date_start", "hour_start", "campaign_id", "ad_id", "utm_source", "utm_medium", "utm_campaign", "channel"]


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_channel_function(spark: SparkSession, rules=None, name: str = "get_utm_channel") -> None:
    """``get_utm_channel(source, medium, campaign, content)``: a struct of the best rule's outputs, null where none fits.

    The rules become one CASE in priority order; rules of one priority keep their order.
    """
    fits = lambda arg, pattern: f"{arg} IS NULL" if pattern is None else f"coalesce({arg} RLIKE {_text(pattern)}, false)"
    cases = []
    for rule in sorted(CHANNEL_RULES if rules is None else rules, key=lambda r: -r[8]):
        outputs = ", ".join(f"'{n}', cast({_text(v)} AS STRING)" for n, v in zip(RULE_OUTPUTS, rule[4:8]))
        cases.append("WHEN " + " AND ".join(fits(a, p) for a, p in zip(ARGUMENTS, rule[:4])) + f" THEN named_struct({outputs})")
    kind = "STRUCT<" + ", ".join(f"{n}: STRING" for n in RULE_OUTPUTS) + ">"
    arguments = ", ".join(f"{a} STRING" for a in ARGUMENTS)
    body = f"CASE {' '.join(cases)} END" if cases else f"cast(NULL AS {kind})"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")


def model_credit(touches: DataFrame, conversions: DataFrame, model: str, days: int = 30, half_life_days: float = 7.0) -> DataFrame:
    """(date_start, hour_start, campaign_id, ad_id, revenue, orders): what ``model`` credits to the touches of each hour."""
    if model in ("first_click", "last_click"):
        pick = touch.first_click if model == "first_click" else touch.last_click
        rows = pick(touches, conversions, days).select(
            "touch_time", "campaign_id", "ad_id", F.col("order_value").cast("double").alias("revenue"), F.lit(1.0).alias("orders")
        )
    elif model in ("linear", "time_decay"):
        rows = touch.shared_credit(touches, conversions, days, None if model == "linear" else half_life_days).select(
            "touch_time", "campaign_id", "ad_id", half_up(F.col("credited_revenue"), 4).alias("revenue"), half_up(F.col("credited_orders"), 4).alias("orders")
        ).where("orders > 0")
    else:
        raise ValueError(f"unknown attribution model {model!r}; one of {touch.MODELS}")
    hour = [F.to_date("touch_time").alias("date_start"), F.hour("touch_time").alias("hour_start")]
    return rows.groupBy(*hour, "campaign_id", "ad_id").agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))


def register_period_function(
    hourly: DataFrame, touches: DataFrame, conversions: DataFrame, days: int = 30, half_life_days: float = 7.0,
    name: str = "calculate_utm_attribution", view: str = "utm_attribution_by_model",
) -> None:
    """``calculate_utm_attribution(start, end [, model])``: hourly rows of a period under a model, 'last_click' if none is named.

    Under last_click these are the hourly metrics; under first_click, linear and time_decay the hours, campaigns and ads
    of the touches with the revenue and orders that the model credits to them (sessions and UTM fields are then null).
    A model that does not exist is an error.
    """
    spark = hourly.sparkSession
    stored = hourly.select(
        *SLICE, F.col("total_sessions").cast("long").alias("sessions"), F.col("total_conversions").cast("long").alias("conversions"),
        F.col("total_revenue").cast("double").alias("revenue"), F.col("total_orders").cast("double").alias("orders"), F.lit("last_click").alias("model"),
    )
    parts = [model_credit(touches, conversions, m, days, half_life_days).withColumn("model", F.lit(m)) for m in CREDIT_MODELS]
    reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [stored, *parts]).createOrReplaceTempView(view)
    known = ", ".join(_text(m) for m in ["last_click", *CREDIT_MODELS])
    columns = [*SLICE, "sessions", "conversions", "revenue", "orders"]
    kinds = {"date_start": "DATE", "hour_start": "INT", "sessions": "BIGINT", "conversions": "BIGINT", "revenue": "DOUBLE", "orders": "DOUBLE"}
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(p_start DATE, p_end DATE, p_model STRING DEFAULT 'last_click')
        RETURNS TABLE({', '.join(f'{c} {kinds.get(c, "STRING")}' for c in columns)})
        RETURN SELECT {', '.join(columns)} FROM {view} WHERE date_start BETWEEN p_start AND p_end
            AND model = CASE WHEN p_model IN ({known}) THEN p_model ELSE raise_error(concat('unknown attribution model ', p_model)) END""")
