"""Ad-level summary and the daily shop-versus-platform comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.functions.measures import safe_div, total
from adtrail.operators.ads import AD_KEYS, AD_NAMES
from adtrail.operators.attribution import UTM_COLUMNS


def _same(left: str, right: str, columns: list[str]):
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return same


def _merged_keys(left: str, right: str, columns: list[str]):
    return [F.coalesce(F.col(f"{left}.{c}"), F.col(f"{right}.{c}")).alias(c) for c in columns]


def _orders_by_ad(attributed: DataFrame) -> DataFrame:
    """Order measures and the sorted distinct SKU list per ad and channel, in one pass.

    Orders spread into their SKUs; the first SKU carries the order's measures.
    Rows fold to (ad, SKU) first, so the list step sees each SKU once.
    """
    by = [*AD_KEYS, "channel"]
    sums = ["orders", "attributed_orders", "total_sales", "total_cogs", "total_unique_skus", "total_sku_quantity"]
    spread = attributed.where(F.col("campaign_name").isNotNull()).select(
        *by, "is_attributed", "order_value", "total_cogs", "unique_skus_count", "total_sku_quantity",
        F.posexplode_outer(F.split("skus", ", ")).alias("_pos", "sku"),
    )
    first = F.coalesce(F.col("_pos") == 0, F.lit(True))
    once = lambda value: F.sum(F.when(first, value).otherwise(F.lit(0)))
    pairs = spread.groupBy(*by, "sku").agg(
        F.min("is_attributed").alias("attributed"),
        once(F.lit(1)).alias("orders"),
        once(F.col("is_attributed").cast("int")).alias("attributed_orders"),
        once(F.col("order_value")).alias("total_sales"),
        once(F.col("total_cogs")).alias("total_cogs"),
        once(F.col("unique_skus_count")).alias("total_unique_skus"),
        once(F.col("total_sku_quantity")).alias("total_sku_quantity"),
    )
    return pairs.groupBy(*by).agg(
        F.min("attributed").alias("attributed"),
        *[F.sum(c).alias(c) for c in sums],
        F.array_join(F.sort_array(F.collect_list("sku")), ", ").alias("all_skus"),
    )


def ad_level_summary(attributed: DataFrame, daily: DataFrame) -> DataFrame:
    """One row per ad and channel: orders, sales, spend, profit and rates.

    Ads without orders stay, with channel 'Unknown' and attributed true.
    ``attributed`` tells whether all of the ad's orders are. An ad's spend
    repeats for each of its channels; ``spend_once`` carries it on one row
    (most sales, then channel name), so totals are taken from there.
    """
    orders = _orders_by_ad(attributed)
    ads = daily.groupBy(*AD_KEYS).agg(*[F.sum(c).alias(c) for c in ("impressions", "clicks", "spend")])
    joined = (
        ads.alias("a")
        .join(orders.alias("o"), _same("a", "o", AD_KEYS), "full")
        .select(
            *_merged_keys("a", "o", AD_KEYS),
            F.coalesce("channel", F.lit("Unknown")).alias("channel"),
            F.coalesce("attributed", F.lit(True)).alias("attributed"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in (
                "orders", "attributed_orders", "total_sales", "total_cogs",
                "impressions", "clicks", "spend", "total_unique_skus", "total_sku_quantity",
            )],
            F.coalesce("all_skus", F.lit("")).alias("all_skus"),
        )
    )
    # Rows of one ad are its channels: a handful.
    first = Window.partitionBy(*AD_KEYS).orderBy(F.col("total_sales").desc(), "channel")
    return joined.withColumn("net_profit", F.col("total_sales") - F.col("total_cogs") - F.col("spend")).withColumns(
        {
            "roas": safe_div("total_sales", "spend"),
            "ctr": safe_div("clicks", "impressions", 100),
            "conversion_rate": safe_div("orders", "clicks", 100),
            "avg_order_value": safe_div("total_sales", "orders"),
            "profit_margin": safe_div("net_profit", "total_sales", 100),
            "spend_once": F.when(F.row_number().over(first) == 1, F.col("spend")).otherwise(F.lit(0)),
        }
    )


def platform_comparison(attributed: DataFrame, daily: DataFrame) -> DataFrame:
    """Per ad-day: what the ad platform reports beside what the shop recorded.

    Differences are shop minus platform. Every ad-day has one row; days with
    orders but no ad record are kept with zero platform figures.
    """
    by = [*AD_NAMES, "date_start"]
    # Folded to (ad, day, SKU) first: an order's figures stand on its first SKU, and the list holds each SKU once.
    texts = ["channel", *UTM_COLUMNS]
    spread = attributed.where(F.col("campaign_name").isNotNull()).select(
        *AD_NAMES, F.to_date("order_ts").alias("date_start"), "order_id", *texts,
        "order_value", "total_cogs", "unique_skus_count", "total_sku_quantity", F.posexplode_outer(F.split("skus", ", ")).alias("_pos", "sku"),
    )
    once = lambda value: F.sum(F.when(F.coalesce(F.col("_pos") == 0, F.lit(True)), value).otherwise(F.lit(0)))
    figures = {
        "shopify_orders": F.lit(1), "shopify_revenue": F.col("order_value"), "shopify_cogs": F.col("total_cogs"),
        "unique_sku_count": F.col("unique_skus_count"), "total_sku_quantity": F.col("total_sku_quantity"),
    }
    pairs = spread.groupBy(*by, "sku").agg(
        *[once(value).alias(name) for name, value in figures.items()],
        *[F.min(F.when(F.col(c) != "", F.struct("order_id", c))).alias(f"_{c}") for c in texts],
    )
    orders = pairs.groupBy(*by).agg(
        *[total(name).alias(name) for name in figures],
        *[F.min(f"_{c}")[c].alias(c) for c in texts],
        F.array_join(F.sort_array(F.collect_list("sku")), ", ").alias("unique_skus"),  # no more than the catalogue
    )
    platform = daily.groupBy(*by).agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("spend").alias("spend"),
        F.sum("action_onsite_web_purchase").alias("fb_action_onsite_web_purchase"),
        F.sum("value_onsite_web_purchase").alias("fb_value_onsite_web_purchase"),
    )
    joined = (
        platform.alias("p")
        .join(orders.alias("o"), _same("p", "o", by), "full")
        .select(
            *_merged_keys("p", "o", by),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in (
                "impressions", "clicks", "spend", "fb_action_onsite_web_purchase", "fb_value_onsite_web_purchase",
                "shopify_orders", "shopify_revenue", "shopify_cogs", "unique_sku_count", "total_sku_quantity",
            )],
            *[F.coalesce(c, F.lit("")).alias(c) for c in ("channel", *UTM_COLUMNS, "unique_skus")],
        )
    )
    rated = joined.withColumns(
        {
            "ctr": safe_div("clicks", "impressions", 100),
            "cpm": safe_div("spend", "impressions", 1000),
            "cpc": safe_div("spend", "clicks"),
            "fb_roas": safe_div("fb_value_onsite_web_purchase", "spend"),
            "shopify_profit": F.col("shopify_revenue") - F.col("shopify_cogs"),
            "shopify_roas": safe_div("shopify_revenue", "spend"),
            "shopify_conversion_rate": safe_div("shopify_orders", "clicks", 100),
            "shopify_avg_order_value": safe_div("shopify_revenue", "shopify_orders"),
            "revenue_difference": F.col("shopify_revenue") - F.col("fb_value_onsite_web_purchase"),
            "orders_difference": F.col("shopify_orders") - F.col("fb_action_onsite_web_purchase"),
        }
    )
    return rated.withColumn("roas_difference", F.col("shopify_roas") - F.col("fb_roas"))


def range_kpis(attributed: DataFrame, ad_level: DataFrame, dedupe_spend: bool = False) -> DataFrame:
    """Per channel: orders, sales, spend and margin, spend looked up by ad, campaign and date range.

    ``ad_level`` rows hold an analysis range. An order falling into several
    ranges counts once per range and its ad's spend counts per order, as a
    plain join would give; ``dedupe_spend`` counts each ad-level row once per
    channel. Orders are folded to (channel, ad, campaign, day) before the
    range test, so its cost follows ad-days, not orders.
    """
    days = (
        attributed.withColumn("day", F.to_date("order_ts"))
        .groupBy("channel", "ad_id", "campaign_id", "day")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("is_attributed").alias("n_attributed"),
            F.sum("order_value").alias("sales"),
            F.sum("total_cogs").alias("cogs"),
        )
    )
    ranges = ad_level.select(
        F.col("ad_id").alias("r_ad"), F.col("campaign_id").alias("r_campaign"),
        "analysis_date_start", "analysis_date_end", "batch_id", "spend",
    )
    # Rows without an ad match no range; folded, they are one per channel, campaign and day.
    joined = days.join(
        ranges,
        (F.col("ad_id") == F.col("r_ad"))
        & (F.col("campaign_id") == F.col("r_campaign"))
        & F.col("day").between(F.col("analysis_date_start"), F.col("analysis_date_end")),
        "left",
    )
    if dedupe_spend:
        # One line per channel and ad-level row carries the spend.
        once = joined.groupBy("channel", "r_ad", "r_campaign", "analysis_date_start", "analysis_date_end", "batch_id").agg(
            *[F.sum(c).alias(c) for c in ("n", "n_attributed", "sales", "cogs")], F.max("spend").alias("spend")
        )
    else:
        once = joined.withColumn("spend", F.col("spend") * F.col("n"))
    sums = once.groupBy("channel").agg(
        F.sum("n").alias("total_orders"),
        F.sum("n_attributed").alias("attributed_orders"),
        F.sum("sales").alias("total_sales"),
        total("spend").alias("total_spend"),
        F.sum("cogs").alias("_cogs"),
    )
    return sums.select(
        "channel", "total_orders", "attributed_orders",
        safe_div("attributed_orders", "total_orders", 100, 2).alias("attribution_rate"),
        "total_sales", "total_spend",
        safe_div("total_sales", "total_spend", 1, 4).alias("roas"),
        safe_div(F.col("total_sales") - F.col("_cogs") - F.col("total_spend"), F.col("total_sales"), 100, 2).alias("profit_margin"),
    ).orderBy(F.col("total_sales").desc(), "channel")
