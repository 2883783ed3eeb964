"""Views and reports over hourly UTM metrics."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.functions.measures import mean, safe_div
from adtrail.operators.utm import since, utm_with_ads
from adtrail.sources.tables import DateWindow

SUMS = ["total_sessions", "total_conversions", "total_revenue", "total_orders"]


def utm_ad_hourly_performance(hourly: DataFrame, ads: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return utm_with_ads(hourly, ads, DateWindow(as_of - timedelta(days=days), as_of))


def utm_daily_summary(performance: DataFrame) -> DataFrame:
    by = ["date_start", "channel", "sub_channel", "utm_source", "utm_campaign"]
    return performance.groupBy(*by).agg(
        F.sum("utm_sessions").alias("total_sessions"), F.sum("utm_visitors").alias("total_visitors"),
        F.sum("utm_customers").alias("total_customers"), F.sum("utm_conversions").alias("total_conversions"),
        F.sum("utm_revenue").alias("total_revenue"), F.sum("utm_orders").alias("total_orders"),
        F.sum("ad_spend").alias("total_ad_spend"),
        F.sum("attributed_revenue").alias("total_attributed_revenue"),
        F.sum("attributed_orders").alias("total_attributed_orders"),
    ).withColumns(
        {
            "conversion_rate_percent": safe_div("total_conversions", "total_sessions", 100, 4),
            "roas": safe_div("total_revenue", "total_ad_spend", 1, 4),
            "avg_order_value": safe_div("total_revenue", "total_orders", 1, 2),
            "attribution_rate_percent": safe_div("total_attributed_revenue", "total_revenue", 100, 4),
        }
    ).orderBy(F.col("date_start").desc(), F.col("total_revenue").desc(), "channel", "sub_channel", "utm_source", "utm_campaign")


def recent_hours(hourly: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    return hourly.where(since(as_of, days)).select(
        "date_start", "hour_start", "hour_window", "channel", "utm_source", "utm_campaign",
        "total_sessions", "total_conversions", "total_revenue", "total_orders", "conversion_rate", "attribution_rate",
    ).orderBy(F.col("date_start").desc(), F.col("hour_start").desc())


def recent_hours_with_ads(hourly: DataFrame, ads: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    rows = utm_with_ads(hourly, ads, DateWindow(as_of - timedelta(days=days), as_of))
    return rows.select(
        "date_start", "hour_start", "hour_window", "campaign_id", "campaign_name", "ad_id", "ad_name",
        "utm_source", "utm_medium", "utm_campaign", "channel",
        "ad_impressions", "ad_clicks", "ad_spend", "ad_cpm", "ad_cpc", "ad_ctr",
        "utm_sessions", "utm_conversions", "utm_revenue", "utm_orders", "utm_avg_order_value",
        safe_div("utm_revenue", "ad_spend", 1, 4).alias("roas"),
        safe_div("utm_conversions", "ad_clicks", 100, 4).alias("conversion_rate_percent"),
    ).orderBy(F.col("date_start").desc(), F.col("hour_start").desc(), F.col("utm_revenue").desc())


def _conversion() -> Column:
    return safe_div(F.sum("total_conversions"), F.sum("total_sessions"), 100, 4).alias("conversion_rate_percent")


def _summary(hourly: DataFrame, by: list[str], as_of: date, days: int, having: bool = True) -> DataFrame:
    rows = hourly.where(since(as_of, days)).groupBy(*by).agg(
        F.countDistinct("date_start").alias("active_days"), *[F.sum(c).alias(c) for c in SUMS]
    ).withColumns(
        {
            "conversion_rate_percent": safe_div("total_conversions", "total_sessions", 100, 4),
            "avg_order_value": safe_div("total_revenue", "total_orders", 1, 2),
        }
    )
    return rows.where(F.col("total_revenue") > 0) if having else rows


def channel_summary(hourly: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    by = ["channel", "sub_channel"]
    return _summary(hourly, by, as_of, days).orderBy(F.col("total_revenue").desc(), *by)


def top_campaigns(hourly: DataFrame, as_of: date, days: int = 30, k: int = 20) -> DataFrame:
    by = ["campaign_name", "channel", "utm_source", "utm_medium"]
    return _summary(hourly, by, as_of, days).orderBy(F.col("total_revenue").desc(), *by).limit(k)


def hour_pattern(hourly: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    return _summary(hourly, ["hour_start"], as_of, days, having=False).orderBy("hour_start")


def source_summary(hourly: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    by = ["utm_source", "utm_medium", "utm_campaign"]
    return _summary(hourly, by, as_of, days).orderBy(F.col("total_revenue").desc(), *by)


def attribution_by_campaign(hourly: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    by = ["channel", "campaign_name"]
    sums = ["attributed_revenue", "attributed_orders", "total_revenue", "total_orders"]
    return hourly.where(since(as_of, days)).groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums]).where(
        F.col("total_revenue") > 0
    ).withColumn(
        "attribution_rate_percent", safe_div("attributed_revenue", "total_revenue", 100, 4)
    ).orderBy(F.col("attribution_rate_percent").desc(), *by)


def batch_quality(hourly: DataFrame, as_of: date, days: int = 7, created: str = "created_at") -> DataFrame:
    """Per batch, latest created first."""
    score = F.col("data_completeness_score")
    return hourly.where(since(as_of, days, created)).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_records"),
        mean(score).alias("avg_data_quality"), F.min(score).alias("min_data_quality"), F.max(score).alias("max_data_quality"),
        F.count_if(score >= 90).alias("high_quality_records"), F.count_if(score < 70).alias("low_quality_records"),
        F.max(created).alias("last_created"),
    ).orderBy(F.col("last_created").desc(), "batch_id")


def period_dashboard(hourly: DataFrame, as_of: date) -> DataFrame:
    """Today, Yesterday and Last 7 Days; one line each, also for an empty period."""
    day = F.col("date_start")
    periods = {
        "Today": day == F.lit(as_of),
        "Yesterday": day == F.date_sub(F.lit(as_of), 1),
        "Last 7 Days": since(as_of, 7),
    }
    lines = [
        hourly.where(inside).agg(
            F.countDistinct("campaign_id").alias("active_campaigns"),
            F.countDistinct("ad_id").alias("active_ads"),
            *[F.sum(c).alias(c) for c in SUMS],
            _conversion(),
        ).select(F.lit(name).alias("period"), "*")
        for name, inside in periods.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def campaign_roas(performance: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    by = ["campaign_name", "channel"]
    return performance.where(since(as_of, days)).groupBy(*by).agg(
        F.sum("utm_revenue").alias("total_revenue"), F.sum("ad_spend").alias("total_spend"),
        safe_div(F.sum("utm_revenue"), F.sum("ad_spend"), 1, 4).alias("roas"),
        F.sum("utm_conversions").alias("total_conversions"), F.sum("utm_sessions").alias("total_sessions"),
    ).where(F.col("total_revenue") > 0).orderBy(F.col("total_revenue").desc(), *by)


def source_performance(performance: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    by = ["utm_source", "utm_medium", "utm_campaign"]
    return performance.where(since(as_of, days)).groupBy(*by).agg(
        F.countDistinct("date_start").alias("active_days"),
        F.sum("utm_sessions").alias("total_sessions"), F.sum("utm_conversions").alias("total_conversions"),
        F.sum("utm_revenue").alias("total_revenue"),
        safe_div(F.sum("utm_conversions"), F.sum("utm_sessions"), 100, 4).alias("conversion_rate_percent"),
    ).where(F.col("total_revenue") > 0).orderBy(F.col("total_revenue").desc(), *by)


def conversion_pattern(performance: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    return performance.where(since(as_of, days)).groupBy("hour_start").agg(
        F.sum("utm_conversions").alias("total_conversions"), F.sum("utm_revenue").alias("total_revenue"),
        mean("utm_avg_order_value").alias("avg_order_value"), F.countDistinct("campaign_id").alias("active_campaigns"),
    ).orderBy("hour_start")


def hourly_check(hourly: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    return hourly.where(since(as_of, days)).groupBy("date_start", "hour_start").agg(
        F.count(F.lit(1)).alias("record_count"), F.sum("total_revenue").alias("total_revenue")
    ).orderBy(F.col("date_start").desc(), "hour_start")
