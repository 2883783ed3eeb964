"""Every sold SKU beside the ad that earned it, on the order's day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.functions.journey import UTM_FIELDS
from adtrail.functions.measures import safe_div
from adtrail.operators.ads import daily_ads_named
from adtrail.operators.attribution import with_ad_id
from adtrail.operators.orders import priced_lines, with_margin
from adtrail.sources.tables import DateWindow, ads_window, order_window

AD_DAY = {
    "daily_impressions": "ad_impressions",
    "daily_clicks": "ad_clicks",
    "daily_spend": "ad_spend",
    "daily_purchases": "ad_purchases",
    "daily_revenue": "ad_revenue",
    "daily_cpm": "ad_cpm",
    "daily_cpc": "ad_cpc",
    "daily_ctr": "ad_ctr",
}
AD_FIELDS = ["campaign_id", "campaign_name", "adset_id", "adset_name", "ad_name"]


def best_ad_day(daily: DataFrame) -> DataFrame:
    """One record per (day, ad): highest spend first, then lowest campaign and ad set."""
    pick = F.struct(F.negate(F.col("daily_spend")).alias("_order"), *AD_FIELDS, *AD_DAY)
    return (
        daily.groupBy("date_start", "ad_id")
        .agg(F.min(pick).alias("ad"))
        .select("date_start", "ad_id", *[f"ad.{c}" for c in AD_FIELDS], *[F.col(f"ad.{c}").alias(n) for c, n in AD_DAY.items()])
    )


def order_ad_mapping(
    orders: DataFrame, line_items: DataFrame, variants: DataFrame, ads: DataFrame, window: DateWindow | None = None
) -> DataFrame:
    """One row per order line with a SKU whose order's ad ran on the order's day.

    Orders without an ad id, and ad ids without a record that day, drop out.
    ``ad_spend`` repeats the ad-day's spend on every line; sums over it count
    it once per line. Use ``spend_once`` for each ad-day counted once.
    """
    own = with_ad_id(order_window(orders, window)).select(
        "order_id", "order_name", "order_date",
        F.col("total_price_amount").alias("order_value"),
        F.col("total_price_currency").alias("order_currency"),
        "ad_id",
        *[F.col(f"customer_utm_{f}").alias(f"utm_{f}") for f in UTM_FIELDS],
    ).where(F.col("ad_id").isNotNull())
    ad_days = best_ad_day(daily_ads_named(ads_window(ads, window)))
    matched = own.join(ad_days.withColumnRenamed("date_start", "order_date"), ["order_date", "ad_id"])
    lines = priced_lines(line_items, variants).where(F.col("sku").isNotNull())
    mapped = matched.join(lines, "order_id")
    return with_margin(mapped, "line_item_profit", "line_item_revenue", "profit_margin").withColumns(
        {
            "roas": safe_div("line_item_revenue", "ad_spend"),
            "cost_per_order": safe_div("ad_spend", "ad_purchases"),
        }
    )


def spend_once(mapping: DataFrame, by: list[str]) -> DataFrame:
    """Spend per group with each ad-day of the group counted once."""
    ad_days = mapping.groupBy(*by, *[c for c in ("order_date", "ad_id") if c not in by]).agg(
        F.max("ad_spend").alias("ad_spend")
    )
    return ad_days.groupBy(*by).agg(F.sum("ad_spend").alias("spend_once"))
