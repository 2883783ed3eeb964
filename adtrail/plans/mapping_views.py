"""Views over the SKU-to-ad mapping."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.functions.measures import half_up, mean, ratio
from adtrail.operators.utm import since

SKU = ["sku", "product_title"]
AD = ["ad_id", "ad_name", "campaign_name"]


def _lines() -> Column:
    return F.count(F.lit(1))


def _sum(column: str) -> Column:
    return F.sum(column)


REVENUE, PROFIT, SPEND, UNITS = "line_item_revenue", "line_item_profit", "ad_spend", "quantity"


def _per(num: str | Column, den: str | Column, scale: int = 1) -> Column:
    num = _sum(num) if isinstance(num, str) else num
    den = _sum(den) if isinstance(den, str) else den
    return ratio(num, den, scale, 2)


def _mean2(column: str) -> Column:
    return half_up(mean(column), 2)


def sku_ad_performance(m: DataFrame) -> DataFrame:
    return m.groupBy(*SKU, *AD).agg(
        _lines().alias("orders"), _sum(UNITS).alias("total_quantity_sold"), _sum(REVENUE).alias("total_revenue"),
        _sum("line_item_cogs").alias("total_cogs"), _sum(PROFIT).alias("total_profit"),
        _mean2("profit_margin").alias("avg_profit_margin"), _mean2("roas").alias("avg_roas"),
        _per(REVENUE, UNITS).alias("revenue_per_unit"),
        _per(PROFIT, REVENUE, 100).alias("overall_profit_margin"),
    ).orderBy(F.col("total_revenue").desc(), *SKU, *AD)


def ad_sku_performance(m: DataFrame) -> DataFrame:
    return m.groupBy(*AD).agg(
        F.countDistinct("sku").alias("unique_skus"), _lines().alias("total_orders"),
        _sum(UNITS).alias("total_quantity_sold"), _sum(REVENUE).alias("total_revenue"), _sum(SPEND).alias("total_spend"),
        _mean2("roas").alias("avg_roas"), _per(REVENUE, SPEND).alias("overall_roas"),
        _per(SPEND, _lines()).alias("cost_per_order"), _per(REVENUE, _lines()).alias("revenue_per_order"),
    ).orderBy(F.col("total_revenue").desc(), *AD)


def daily_order_ad_performance(m: DataFrame) -> DataFrame:
    orders = F.countDistinct("order_id")
    return m.groupBy("order_date").agg(
        orders.alias("total_orders"), F.countDistinct("sku").alias("unique_skus"),
        F.countDistinct("ad_id").alias("unique_ads"), F.countDistinct("campaign_name").alias("unique_campaigns"),
        _sum(REVENUE).alias("total_revenue"), _sum(SPEND).alias("total_spend"),
        _per(REVENUE, SPEND).alias("daily_roas"), _per(SPEND, orders).alias("cost_per_order"),
        _per(REVENUE, orders).alias("revenue_per_order"),
    ).orderBy(F.col("order_date").desc())


def campaign_sku_breakdown(m: DataFrame) -> DataFrame:
    skus, ads = F.countDistinct("sku"), F.countDistinct("ad_id")
    return m.groupBy("campaign_name").agg(
        skus.alias("unique_skus"), ads.alias("unique_ads"), _lines().alias("total_orders"),
        _sum(UNITS).alias("total_quantity_sold"), _sum(REVENUE).alias("total_revenue"), _sum(SPEND).alias("total_spend"),
        _per(REVENUE, SPEND).alias("campaign_roas"), _per(REVENUE, skus).alias("revenue_per_sku"),
        _per(SPEND, ads).alias("spend_per_ad"), _per(REVENUE, _lines()).alias("revenue_per_order"),
    ).orderBy(F.col("total_revenue").desc(), "campaign_name")


def top_performing_skus(m: DataFrame, min_orders: int = 5) -> DataFrame:
    return m.groupBy(*SKU).agg(
        F.countDistinct("ad_id").alias("ads_count"), _lines().alias("total_orders"),
        _sum(UNITS).alias("total_quantity_sold"), _sum(REVENUE).alias("total_revenue"), _sum(PROFIT).alias("total_profit"),
        _mean2("profit_margin").alias("avg_profit_margin"), _per(REVENUE, UNITS).alias("revenue_per_unit"),
        _per(PROFIT, REVENUE, 100).alias("overall_profit_margin"),
    ).where(F.col("total_orders") >= min_orders).orderBy(F.col("total_revenue").desc(), *SKU)


def top_performing_ads(m: DataFrame, min_orders: int = 3) -> DataFrame:
    return m.groupBy(*AD).agg(
        F.countDistinct("sku").alias("unique_skus"), _lines().alias("total_orders"),
        _sum(REVENUE).alias("total_revenue"), _sum(SPEND).alias("total_spend"),
        _per(REVENUE, SPEND).alias("overall_roas"), _per(SPEND, _lines()).alias("cost_per_order"),
        _per(REVENUE, _lines()).alias("revenue_per_order"),
    ).where(F.col("total_orders") >= min_orders).orderBy(F.col("total_revenue").desc(), *AD)


def sku_ad_efficiency(m: DataFrame) -> DataFrame:
    return m.groupBy(*SKU, *AD).agg(
        _lines().alias("orders"), _sum(UNITS).alias("quantity_sold"), _sum(REVENUE).alias("revenue"),
        _sum(SPEND).alias("spend"), _per(REVENUE, SPEND).alias("roas"), _per(SPEND, _lines()).alias("cost_per_order"),
        _per(REVENUE, _lines()).alias("revenue_per_order"), _per(REVENUE, UNITS).alias("revenue_per_unit"),
        _per(REVENUE, SPEND).alias("efficiency_score"),
    ).where(F.col("spend") > 0).orderBy(F.col("efficiency_score").desc(), *SKU, *AD)


def campaign_sku_matrix(m: DataFrame) -> DataFrame:
    return m.groupBy("campaign_name", *SKU).agg(
        _lines().alias("orders"), _sum(UNITS).alias("quantity_sold"), _sum(REVENUE).alias("revenue"),
        _sum(SPEND).alias("spend"), _per(REVENUE, SPEND).alias("roas"), _per(REVENUE, _lines()).alias("revenue_per_order"),
    ).orderBy("campaign_name", F.col("revenue").desc(), *SKU)


def daily_sku_performance(m: DataFrame) -> DataFrame:
    return m.groupBy("order_date", *SKU).agg(
        _lines().alias("orders"), _sum(UNITS).alias("quantity_sold"), _sum(REVENUE).alias("revenue"),
        _per(REVENUE, _lines()).alias("revenue_per_order"), _per(REVENUE, UNITS).alias("revenue_per_unit"),
    ).orderBy(F.col("order_date").desc(), F.col("revenue").desc(), *SKU)


def daily_ad_performance(m: DataFrame) -> DataFrame:
    return m.groupBy("order_date", *AD).agg(
        _lines().alias("orders"), _sum(REVENUE).alias("revenue"), _sum(SPEND).alias("spend"),
        _per(REVENUE, SPEND).alias("roas"), _per(SPEND, _lines()).alias("cost_per_order"),
    ).orderBy(F.col("order_date").desc(), F.col("revenue").desc(), *AD)


def best_sku_ads(m: DataFrame, k: int = 10) -> DataFrame:
    by = ["sku", "product_title", "ad_name", "campaign_name"]
    return (
        m.groupBy(*by).agg(_sum(REVENUE).alias("revenue"), _per(REVENUE, SPEND).alias("roas"), _sum(SPEND).alias("_spend"))
        .where(F.col("_spend") > 0).drop("_spend")
        .orderBy(F.col("roas").desc(), F.col("revenue").desc(), *by).limit(k)
    )


def underperforming_ads(m: DataFrame, min_spend: float = 100, k: int = 10) -> DataFrame:
    return (
        m.groupBy(*AD).agg(_sum(REVENUE).alias("revenue"), _sum(SPEND).alias("spend"), _per(REVENUE, SPEND).alias("roas"))
        .where(F.col("spend") > min_spend)
        .orderBy("roas", F.col("spend").desc(), *AD).limit(k)
    )


def daily_trend(m: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return m.where(since(as_of, days, "order_date")).groupBy("order_date").agg(
        F.countDistinct("order_id").alias("orders"), _sum(REVENUE).alias("revenue"), _per(REVENUE, SPEND).alias("roas")
    ).orderBy(F.col("order_date").desc())
