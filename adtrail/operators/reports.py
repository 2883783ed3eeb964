"""Summary reports over attributed orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.functions.measures import safe_div, total
from adtrail.operators.ads import AD_NAMES, ad_totals


def _breakdown(attributed: DataFrame, by: str) -> DataFrame:
    """Orders, revenue and percentage of all orders per value of ``by`` (null left out)."""
    # The total runs over the few grouped rows, not over the orders.
    everyone = F.sum("orders").over(Window.partitionBy())
    return (
        attributed.groupBy(by)
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_value").alias("revenue"))
        .withColumn("percentage", safe_div(F.col("orders"), everyone, 100))
        .where(F.col(by).isNotNull())
    )


def channel_breakdown(attributed: DataFrame) -> DataFrame:
    return _breakdown(attributed, "channel")


def source_breakdown(attributed: DataFrame) -> DataFrame:
    return _breakdown(attributed, "attribution_source")


def grand_totals(attributed: DataFrame) -> DataFrame:
    """One row: orders, revenue, attributed orders, attribution rate."""
    yes = F.count_if("is_attributed")
    return attributed.agg(
        F.count(F.lit(1)).alias("total_orders"),
        total("order_value").alias("total_revenue"),
        yes.alias("attributed_orders"),
        safe_div(yes, F.count(F.lit(1)), 100).alias("attribution_rate"),
    )


def _performance(sales: DataFrame, ads: DataFrame, names: list[str]) -> DataFrame:
    joined = sales.join(ad_totals(ads, names), names, "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("ad_impressions", "ad_clicks", "ad_spend")}
    )
    return joined.withColumns(
        {
            "shopify_purchases": F.col("orders"),
            "shopify_revenue": F.col("total_sales"),
            "roas": safe_div("total_sales", "ad_spend"),
            "ctr": safe_div("ad_clicks", "ad_impressions", 100),
            "conversion_rate": safe_div("orders", "ad_clicks", 100),
            "avg_order_value": safe_div("total_sales", "orders"),
        }
    ).orderBy(F.col("total_sales").desc(), *names)


def _sales(attributed: DataFrame, by: list[str]) -> DataFrame:
    return (
        attributed.where("is_attributed")
        .dropna(subset=by)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("order_value").alias("total_sales"),
            F.sum("total_cogs").alias("total_cogs"),
        )
    )


def campaign_performance(attributed: DataFrame, daily: DataFrame) -> DataFrame:
    """Orders, sales, cogs per campaign, ad set, ad and channel beside the ad's own totals.

    Both sides are aggregated before they meet, so neither fans out. The ad's
    totals repeat where one ad has orders in several channels; ``spend_once``
    carries its spend on one row only (most sales, then channel name).
    """
    rows = _performance(_sales(attributed, [*AD_NAMES, "channel"]), daily, AD_NAMES)
    # Rows of one ad are its channels: four at most.
    best = Window.partitionBy(*AD_NAMES).orderBy(F.col("total_sales").desc(), "channel")
    return rows.withColumn(
        "spend_once", F.when(F.row_number().over(best) == 1, F.col("ad_spend")).otherwise(F.lit(0))
    )


def campaign_summary(attributed: DataFrame, daily: DataFrame) -> DataFrame:
    """The same report at campaign grain."""
    return _performance(_sales(attributed, ["campaign_name"]), daily, ["campaign_name"])


def ad_performance(attributed: DataFrame, daily: DataFrame) -> DataFrame:
    """The same report at ad grain, all channels together."""
    return _performance(_sales(attributed, AD_NAMES), daily, AD_NAMES)


def split_attributed(attributed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return attributed.where("is_attributed"), attributed.where(~F.col("is_attributed"))


def batch_metrics(attributed: DataFrame, ad_level: DataFrame) -> DataFrame:
    """One row of run metrics from the order and the ad-level results."""
    orders = attributed.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if("is_attributed").alias("attributed_orders"),
        F.count_if(~F.col("is_attributed")).alias("unattributed_orders"),
        total("order_value").alias("total_sales"),
    )
    ads = ad_level.agg(F.count(F.lit(1)).alias("total_ads"), total("spend").alias("total_spend"))
    # Two one-row frames side by side, without a join.
    both = orders.unionByName(ads, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
