"""Views over attributed orders and over the ad-level summary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.functions.measures import mean, ratio, safe_div, share
from adtrail.operators.ads import AD_KEYS
from adtrail.operators.utm import since

SOURCES = {
    "customer_journey": "journey_attributions",
    "custom_attributes": "attributes_attributions",
    "direct_utm": "direct_utm_attributions",
}


def _orders() -> Column:
    return F.count(F.lit(1)).alias("total_orders")


def _revenue(alias: str = "total_revenue") -> Column:
    return F.sum("order_value").alias(alias)


def _cogs(alias: str = "total_cogs") -> Column:
    return F.sum("total_cogs").alias(alias)


def _attributed() -> Column:
    return F.count_if("is_attributed").alias("attributed_orders")


def _rate() -> Column:
    return share(F.col("is_attributed")).alias("attribution_rate")


def _aov() -> Column:
    return mean("order_value").alias("avg_order_value")


def _cogs_share() -> Column:
    return ratio(F.sum("total_cogs"), F.sum("order_value"), 100, 2).alias("cogs_percentage")


def _dates() -> list[Column]:
    return [F.min("order_ts").alias("first_order_date"), F.max("order_ts").alias("last_order_date")]


def _source_counts() -> list[Column]:
    return [F.count_if(F.col("attribution_source") == s).alias(name) for s, name in SOURCES.items()]


def _by_revenue(df: DataFrame, *ties: str) -> DataFrame:
    return df.orderBy(F.col("total_revenue").desc_nulls_first(), *ties)


def daily_attribution_summary(attributed: DataFrame) -> DataFrame:
    return attributed.groupBy(F.col("order_date").alias("date_start")).agg(
        _orders(), _revenue(), _cogs(), _attributed(),
        F.count_if("is_paid_channel").alias("paid_channel_orders"),
        _rate(), share(F.col("is_paid_channel")).alias("paid_channel_rate"), _cogs_share(), _aov(),
    ).orderBy(F.col("date_start").desc())


def channel_performance(attributed: DataFrame) -> DataFrame:
    return _by_revenue(
        attributed.groupBy("channel").agg(
            _orders(), _revenue(), _cogs(), _attributed(), _rate(), _cogs_share(), _aov(), *_dates()
        ),
        "channel",
    )


def campaign_performance(attributed: DataFrame) -> DataFrame:
    by = [*AD_KEYS, "channel"]
    rows = attributed.where("is_attributed").groupBy(*by).agg(
        _orders(), _revenue(), _cogs(), _cogs_share(), _aov(),
        # One row per order: distinct orders are the rows.
        F.count("order_id").alias("unique_orders"), *_dates(), *_source_counts(),
    )
    return _by_revenue(rows, *by)


def attribution_source_analysis(attributed: DataFrame) -> DataFrame:
    by = ["attribution_source", "channel"]
    rows = attributed.where("is_attributed").groupBy(*by).agg(
        _orders(), _revenue(), _aov(), F.countDistinct("attribution_id").alias("unique_attribution_ids"), *_dates()
    )
    return _by_revenue(rows, *by)


def sku_performance(attributed: DataFrame) -> DataFrame:
    """Per SKU, channel and campaign; every SKU of an order carries the full order value."""
    rows = attributed.where(F.col("is_attributed") & F.col("skus").isNotNull()).select(
        F.explode(F.split("skus", ", ")).alias("sku"), "channel", "campaign_name",
        "order_value", "total_cogs", "total_sku_quantity",
    )
    return rows.groupBy("sku", "channel", "campaign_name").agg(
        F.count(F.lit(1)).alias("orders"), _revenue("revenue"), _cogs("cogs"), _cogs_share(), _aov(),
        F.sum("total_sku_quantity").alias("total_quantity_sold"),
    ).orderBy(F.col("revenue").desc_nulls_first(), "sku", "channel", "campaign_name")


MONTHLY_CHANNELS = {"meta_orders": "Meta", "google_orders": "Google", "organic_orders": "Organic", "direct_orders": "Direct"}


def monthly_attribution_trends(attributed: DataFrame, channels: dict[str, str] | None = None) -> DataFrame:
    """Per month with one count per channel; ``channels`` maps column names to channel values."""
    return attributed.groupBy(F.trunc("order_date", "month").alias("month_start")).agg(
        _orders(), _revenue(), _attributed(),
        F.count_if("is_paid_channel").alias("paid_channel_orders"),
        _rate(), share(F.col("is_paid_channel")).alias("paid_channel_rate"), _aov(),
        *[F.count_if(F.col("channel") == c).alias(n) for n, c in (channels or MONTHLY_CHANNELS).items()],
    ).orderBy(F.col("month_start").desc())


def attribution_quality_analysis(attributed: DataFrame) -> DataFrame:
    matched = F.count("campaign_id")
    return attributed.groupBy(F.col("order_date").alias("date_start")).agg(
        _orders(), _attributed(), *_source_counts(),
        matched.alias("campaign_matched_orders"), _rate(),
        ratio(matched, F.count_if("is_attributed"), 100, 2).alias("campaign_match_rate"),
    ).orderBy(F.col("date_start").desc())


def top_performing_campaigns(attributed: DataFrame, k: int = 100, min_orders: int = 5) -> DataFrame:
    profit = F.sum("order_value") - F.sum("total_cogs")
    rows = attributed.where(F.col("is_attributed") & F.col("campaign_name").isNotNull()).groupBy("campaign_name", "channel").agg(
        _orders(), _revenue(), _cogs(),
        profit.alias("gross_profit"),
        ratio(profit, F.sum("order_value"), 100, 2).alias("profit_margin"),
        _aov(), F.countDistinct("order_date").alias("active_days"), *_dates(),
    )
    return _by_revenue(rows.where(F.col("total_orders") >= min_orders), "campaign_name", "channel").limit(k)


def campaign_totals(daily_ads: DataFrame) -> DataFrame:
    """Impressions, clicks and spend per campaign id, for the funnel."""
    return daily_ads.groupBy("campaign_id").agg(
        F.sum("impressions").alias("ad_impressions"), F.sum("clicks").alias("ad_clicks"), F.sum("spend").alias("ad_spend")
    )


def attribution_funnel(attributed: DataFrame, campaigns: DataFrame, fan_out: bool = True) -> DataFrame:
    """Impressions to clicks to orders per campaign and channel.

    The plain join adds a campaign's ad figures once per order. Orders are
    folded to (campaign, channel) first and the figures multiplied by the
    order count, which is the same sum without the fan-out;
    ``fan_out=False`` counts them once.
    """
    orders = attributed.where("is_attributed").groupBy("campaign_id", "campaign_name", "channel").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("order_value").alias("_value")
    )
    times = F.col("_n") if fan_out else F.lit(1)
    joined = orders.join(campaigns, "campaign_id", "left").withColumns(
        {c: F.col(c) * times for c in ("ad_impressions", "ad_clicks", "ad_spend")}
    )
    rows = joined.groupBy("campaign_name", "channel").agg(
        F.sum("ad_impressions").alias("total_impressions"),
        F.sum("ad_clicks").alias("total_clicks"),
        F.sum("ad_spend").alias("total_spend"),
        F.sum("_n").alias("total_orders"),
        F.sum("_value").alias("total_revenue"),
    )
    return _by_revenue(
        rows.where(F.col("total_impressions") > 0).withColumns(
            {
                "ctr": ratio("total_clicks", "total_impressions", 100, 2),
                "conversion_rate": ratio("total_orders", "total_clicks", 100, 2),
                "roas": ratio("total_revenue", "total_spend", 1, 2),
                "cost_per_order": ratio("total_spend", "total_orders", 1, 2),
            }
        ),
        "campaign_name", "channel",
    )


def geographic_analysis(attributed: DataFrame) -> DataFrame:
    by = ["ship_country", "ship_province", "ship_city", "channel"]
    rows = attributed.where(F.col("ship_country").isNotNull()).groupBy(*by).agg(
        _orders(), _revenue(), _aov(), _attributed(), _rate()
    )
    return _by_revenue(rows, *by)


def attribution_daily_summary(attributed: DataFrame) -> DataFrame:
    return attributed.groupBy(F.col("order_date").alias("analysis_date"), "channel").agg(
        _orders(), _attributed(), share(F.col("is_attributed")).alias("attribution_rate_percent"),
        _revenue(), _cogs(), (F.sum("order_value") - F.sum("total_cogs")).alias("total_profit"),
        F.countDistinct("campaign_id").alias("unique_campaigns"), F.countDistinct("ad_id").alias("unique_ads"),
    ).orderBy(F.col("analysis_date").desc(), F.col("total_revenue").desc_nulls_first(), "channel")


def _level_sums() -> list[Column]:
    return [
        F.sum("orders").alias("total_orders"), F.sum("attributed_orders").alias("total_attributed_orders"),
        F.sum("total_sales").alias("total_sales"), F.sum("spend").alias("total_spend"),
        F.sum("net_profit").alias("total_net_profit"),
        F.sum("impressions").alias("_impressions"), F.sum("clicks").alias("_clicks"),
    ]


def campaign_performance_summary(ad_level: DataFrame) -> DataFrame:
    by = ["campaign_id", "campaign_name", "channel"]
    return ad_level.groupBy(*by).agg(*_level_sums()).select(
        *by, "total_orders", "total_attributed_orders", "total_sales", "total_spend", "total_net_profit",
        safe_div("total_sales", "total_spend", 1, 4).alias("roas"),
        safe_div("_clicks", "_impressions", 100, 4).alias("ctr_percent"),
        safe_div("total_orders", "_clicks", 100, 4).alias("conversion_rate_percent"),
        safe_div("total_sales", "total_orders", 1, 2).alias("avg_order_value"),
        safe_div("total_net_profit", "total_sales", 100, 2).alias("profit_margin_percent"),
    ).orderBy(F.col("total_sales").desc_nulls_first(), *by)


def ad_performance_summary(ad_level: DataFrame) -> DataFrame:
    columns = [
        "ad_id", "ad_name", "campaign_name", "adset_name", "channel", "attributed", "orders", "attributed_orders",
        "total_sales", "spend", "net_profit", "roas", "ctr", "conversion_rate", "avg_order_value", "profit_margin",
        "total_unique_skus", "analysis_date_start", "analysis_date_end", "created_at",
    ]
    return ad_level.select(*[c for c in columns if c in ad_level.columns]).orderBy(
        F.col("total_sales").desc_nulls_first(), F.col("spend").desc_nulls_first(), "ad_id", "channel"
    )


def channel_performance_summary(ad_level: DataFrame) -> DataFrame:
    return ad_level.groupBy("channel").agg(
        F.countDistinct("campaign_id").alias("unique_campaigns"), F.countDistinct("ad_id").alias("unique_ads"), *_level_sums()
    ).select(
        "channel", "unique_campaigns", "unique_ads", "total_orders", "total_attributed_orders",
        ratio("total_attributed_orders", "total_orders", 100, 2).alias("attribution_rate_percent"),
        "total_sales", "total_spend", "total_net_profit",
        safe_div("total_sales", "total_spend", 1, 4).alias("roas"),
        safe_div("total_net_profit", "total_sales", 100, 2).alias("profit_margin_percent"),
    ).orderBy(F.col("total_sales").desc_nulls_first(), "channel")


def top_campaigns_by_roas(ad_level: DataFrame, min_sales: float = 10_000, k: int = 10) -> DataFrame:
    rows = campaign_performance_summary(ad_level).where(F.col("total_sales") > min_sales)
    return rows.orderBy(F.col("roas").desc(), F.col("total_sales").desc(), "campaign_name", "channel").limit(k)


def attribution_rate_by_channel(attributed: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return attributed.where(since(as_of, days, "order_date")).groupBy("channel").agg(
        _orders(), _attributed(), share(F.col("is_attributed")).alias("attribution_rate_percent")
    ).orderBy(F.col("attribution_rate_percent").desc(), "channel")
