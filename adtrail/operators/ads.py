"""Hourly ad facts rolled up to days and to ads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.functions.measures import safe_div

AD_KEYS = ["campaign_id", "campaign_name", "adset_id", "adset_name", "ad_id", "ad_name"]
AD_NAMES = ["campaign_name", "adset_name", "ad_name"]
METRICS = [
    "impressions", "clicks", "spend",
    "action_onsite_web_purchase", "value_onsite_web_purchase",
    "action_onsite_web_add_to_cart", "action_onsite_web_initiate_checkout",
    "action_onsite_web_view_content", "action_link_click",
]
DAILY_NAMES = {
    "impressions": "daily_impressions",
    "clicks": "daily_clicks",
    "spend": "daily_spend",
    "action_onsite_web_purchase": "daily_purchases",
    "value_onsite_web_purchase": "daily_revenue",
    "action_onsite_web_add_to_cart": "daily_add_to_cart",
    "action_onsite_web_initiate_checkout": "daily_checkout",
    "action_onsite_web_view_content": "daily_content_views",
    "action_link_click": "daily_link_clicks",
}


def ad_rates(df: DataFrame, prefix: str = "") -> DataFrame:
    """Add cpm, cpc and ctr worked out from the summed metrics."""
    impressions, clicks, spend = (f"{prefix}{m}" for m in ("impressions", "clicks", "spend"))
    return (
        df.withColumn(f"{prefix}cpm", safe_div(spend, impressions, 1000))
        .withColumn(f"{prefix}cpc", safe_div(spend, clicks))
        .withColumn(f"{prefix}ctr", safe_div(clicks, impressions, 100))
    )


def daily_ads(hourly: DataFrame) -> DataFrame:
    """Daily totals per ad; rows with a missing key take no part."""
    sums = [F.sum(m).alias(m) for m in METRICS]
    keyed = hourly.dropna(subset=["date_start", *AD_KEYS])
    return ad_rates(keyed.groupBy("date_start", *AD_KEYS).agg(*sums))


def daily_ads_named(hourly: DataFrame) -> DataFrame:
    """Daily totals per ad under ``daily_*`` names; rows with a missing key are kept."""
    sums = [F.sum(m).alias(name) for m, name in DAILY_NAMES.items()]
    return ad_rates(hourly.groupBy("date_start", *AD_KEYS).agg(*sums), "daily_")


def ad_totals(ads: DataFrame, by: list[str] = AD_NAMES) -> DataFrame:
    """Impressions, clicks and spend over all dates."""
    return ads.groupBy(*by).agg(
        F.sum("impressions").alias("ad_impressions"),
        F.sum("clicks").alias("ad_clicks"),
        F.sum("spend").alias("ad_spend"),
    )


def first_ad_per_id(daily: DataFrame) -> DataFrame:
    """(attribution_type, attribution_id) -> the earliest daily ad record under that id.

    content names an ad, campaign a campaign, medium an ad set. "Earliest" is
    the order date, campaign, ad set, ad; the minimum folds before the shuffle.
    """
    record = F.struct("date_start", *AD_KEYS, *METRICS)
    ids = F.array(
        *[
            F.struct(F.lit(kind).alias("attribution_type"), F.col(column).alias("attribution_id"))
            for kind, column in (("content", "ad_id"), ("campaign", "campaign_id"), ("medium", "adset_id"))
        ]
    )
    return (
        daily.select(F.inline(ids), record.alias("record"))
        .groupBy("attribution_type", "attribution_id")
        .agg(F.min("record").alias("ad"))
    )
