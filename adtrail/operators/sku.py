"""SKU-level attribution, the campaign hierarchy and SKU facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.functions.measures import half_up, ratio, safe_div
from adtrail.operators.ads import AD_KEYS, AD_NAMES, ad_totals
from adtrail.operators.attribution import UTM_COLUMNS

LEVELS = ["campaign_name", "adset_name", "ad_name", "sku"]


def sku_lines(lines: DataFrame, last_line: bool = False) -> DataFrame:
    """One row per order and SKU: its lines summed, or only the last one (``last_line``)."""
    with_sku = lines.where(F.col("sku").isNotNull())
    if last_line:
        fields = ["product_title", "variant_title", "quantity", "unit_price", "unit_cost"]
        line = F.struct("item_id", *fields, "line_item_revenue", "line_item_cogs", "line_item_profit")
        return (
            with_sku.groupBy("order_id", "sku")
            .agg(F.max(line).alias("l"))
            .select(
                "order_id", "sku", *[f"l.{f}" for f in fields],
                F.col("l.line_item_revenue").alias("sku_revenue"),
                F.col("l.line_item_cogs").alias("sku_cogs"),
                F.col("l.line_item_profit").alias("sku_profit"),
            )
        )
    return with_sku.groupBy("order_id", "sku").agg(
        F.max("product_title").alias("product_title"),
        F.max("variant_title").alias("variant_title"),
        F.sum("quantity").alias("quantity"),
        F.max("unit_price").alias("unit_price"),
        F.max("unit_cost").alias("unit_cost"),
        F.sum("line_item_revenue").alias("sku_revenue"),
        F.sum("line_item_cogs").alias("sku_cogs"),
        F.sum("line_item_profit").alias("sku_profit"),
    )


def sku_attribution(attributed: DataFrame, lines: DataFrame, ads: DataFrame, last_line: bool = False) -> DataFrame:
    """One row per attributed order and SKU with its revenue, profit and the ad's spend."""
    orders = attributed.where("is_attributed").select(
        "order_id", "order_name", "order_date", "order_value", *AD_KEYS, "channel", "attribution_source", *UTM_COLUMNS
    )
    spend = ad_totals(ads).select(*AD_NAMES, "ad_spend")
    # Spend is looked up per order, before orders spread into SKUs. Orders without
    # an ad are spread by their id: their few shared names would crowd one partition.
    spread = F.when(F.col("ad_id").isNull(), F.concat(F.lit("order "), "order_id")).otherwise(F.lit("ad"))
    priced = orders.withColumn("_spread", spread).join(spend.withColumn("_spread", F.lit("ad")), [*AD_NAMES, "_spread"], "left").drop("_spread")
    rows = priced.withColumn("ad_spend", F.coalesce("ad_spend", F.lit(0))).join(sku_lines(lines, last_line), "order_id")
    return rows.withColumns(
        {
            "sku_profit_margin": safe_div("sku_profit", "sku_revenue", 100),
            "sku_roas": safe_div("sku_revenue", "ad_spend"),
            "sku_net_profit": F.col("sku_profit") - F.col("ad_spend"),
        }
    )


def ad_sku_performance(sku_rows: DataFrame) -> DataFrame:
    """Orders, revenue, cogs and roas per campaign, ad set, ad and SKU; missing names are 'Unknown'."""
    named = sku_rows.withColumns({c: F.coalesce(c, F.lit("Unknown")) for c in LEVELS})
    return named.groupBy(*LEVELS).agg(
        F.sum("sku_revenue").alias("sku_revenue"),
        F.sum("sku_cogs").alias("sku_cogs"),
        F.count(F.lit(1)).alias("orders"),
    )


def hierarchy(ad_sku: DataFrame, ad_totals_by_name: DataFrame) -> DataFrame:
    """SKU rows with Ad, Adset and Campaign total rows.

    The four levels come from one grouping-sets pass over the (ad, SKU)
    aggregate. An ad's spend is carried by one of its SKU rows, so every level
    counts it once; ``ad_spent_repeated`` is the figure that adds it once per
    SKU above the ad level.
    """
    ads = ad_totals_by_name.select(*AD_NAMES, "ad_impressions", "ad_clicks", "ad_spend")
    rows = ad_sku.join(ads, AD_NAMES, "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("ad_impressions", "ad_clicks", "ad_spend")}
    )
    firsts = ad_sku.groupBy(*AD_NAMES).agg(F.min("sku").alias("_first_sku"))
    rows = rows.join(firsts, AD_NAMES)
    first = F.col("sku") == F.col("_first_sku")
    rows = rows.withColumns(
        {f"{c}_once": F.when(first, F.col(c)).otherwise(F.lit(0)) for c in ("ad_spend", "ad_clicks", "ad_impressions")}
    )
    campaign, adset, ad, sku = (F.col(c) for c in LEVELS)
    sets = [[campaign, adset, ad, sku], [campaign, adset, ad], [campaign, adset], [campaign]]
    grouped = rows.groupingSets(sets, campaign, adset, ad, sku).agg(
        F.grouping_id(*LEVELS).alias("_level"),
        F.sum("sku_revenue").alias("total_sales"),
        F.sum("sku_cogs").alias("total_cogs"),
        F.sum("orders").alias("orders"),
        F.sum("ad_spend_once").alias("_spend"),
        F.sum("ad_spend").alias("_repeated"),
        F.max("ad_clicks").alias("_ad_clicks"),
        F.max("ad_impressions").alias("_ad_impressions"),
        F.sum("ad_clicks_once").alias("_clicks"),
        F.sum("ad_impressions_once").alias("_impressions"),
    )
    is_sku, is_ad = F.col("_level") == 0, F.col("_level") == 1
    level = F.when(is_sku, "SKU").when(is_ad, "Ad Total").when(F.col("_level") == 3, "Adset Total").otherwise("Campaign Total")
    clicks = F.when(is_sku, F.col("_ad_clicks")).otherwise(F.col("_clicks"))
    impressions = F.when(is_sku, F.col("_ad_impressions")).otherwise(F.col("_impressions"))
    spend = F.when(~is_sku, F.col("_spend"))
    base = F.when(is_sku, F.col("_repeated")).otherwise(F.col("_spend"))
    return grouped.select(
        level.alias("level"), *LEVELS, "orders",
        "total_sales", "total_cogs",
        spend.alias("ad_spent"),
        F.when(is_ad, F.col("_spend")).when(~is_sku, F.col("_repeated")).alias("ad_spent_repeated"),
        F.when(~is_sku, F.col("total_sales") - F.col("total_cogs") - F.col("_spend")).alias("net_profit"),
        clicks.alias("clicks"),
        safe_div(clicks, impressions, 100, 2).alias("ctr"),
        safe_div(F.col("total_sales"), base, 1, 2).alias("purchase_roas"),
        safe_div(F.col("orders"), clicks, 100, 2).alias("conversion_rate"),
    )


def hierarchy_report(rows: DataFrame) -> DataFrame:
    """Reading order with repeated names blanked, as the printed report shows them.

    The first row of every ad is found by an aggregate, those of ad sets and
    campaigns by aggregates over that; no task sorts a campaign.
    """
    depth = F.when(F.col("level") == "SKU", 0).otherwise(1)
    order = [
        F.col("adset_name").asc_nulls_last(), F.col("ad_name").asc_nulls_last(),
        depth, F.col("total_sales").desc(), F.col("sku"),
    ]
    nulls_last = lambda c: F.struct(F.col(c).isNull(), c)
    place = F.struct(depth.alias("depth"), (-F.col("total_sales")).alias("sales"), "sku")
    ads = rows.groupBy(*AD_NAMES).agg(F.min(place).alias("_place"))
    adsets = ads.groupBy("campaign_name", "adset_name").agg(F.min(nulls_last("ad_name")).alias("_ad"))
    campaigns = adsets.groupBy("campaign_name").agg(F.min(nulls_last("adset_name")).alias("_adset"))

    def met(df, firsts, keys):
        named = firsts.withColumnsRenamed({k: f"_of_{k}" for k in keys})
        return df.join(named, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])).drop(*[f"_of_{k}" for k in keys])

    firsts = met(met(ads, adsets, ["campaign_name", "adset_name"]), campaigns, ["campaign_name"])
    rows = met(rows, firsts, AD_NAMES)
    new_ad = place == F.col("_place")
    new_adset = new_ad & (nulls_last("ad_name") == F.col("_ad"))
    new_campaign = new_adset & (nulls_last("adset_name") == F.col("_adset"))
    shown = rows.withColumns(
        {
            "shown_campaign": F.when(new_campaign, F.col("campaign_name")).otherwise(F.lit("")),
            "shown_adset": F.when(new_adset, F.col("adset_name")).otherwise(F.lit("")),
            "shown_ad": F.when(new_ad, F.col("ad_name")).otherwise(F.lit("")),
        }
    )
    return shown.drop("_place", "_ad", "_adset").orderBy("campaign_name", *order)


def sku_campaign_fact(sku_rows: DataFrame, products: DataFrame) -> DataFrame:
    """Fact per SKU, campaign, channel and day with product title and category."""
    titles = products.where(F.col("sku").isNotNull()).groupBy("sku").agg(
        F.min("product_title").alias("product_title"), F.min("product_category").alias("product_category")
    )
    fact = sku_rows.groupBy("sku", "campaign_id", "campaign_name", "channel", F.col("order_date").alias("date_start")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("sku_revenue").alias("total_revenue"),
        F.sum("sku_cogs").alias("total_cogs"),
    )
    return fact.join(titles, "sku", "left").withColumns(
        {
            "quantity_per_order": ratio("total_quantity_sold", "total_orders", 1, 2),
            "revenue_per_order": ratio("total_revenue", "total_orders", 1, 2),
            "profit_margin": safe_div(F.col("total_revenue") - F.col("total_cogs"), F.col("total_revenue"), 100, 2),
        }
    )


def _cogs_share():
    return ratio(F.sum("total_cogs"), F.sum("total_revenue"), 100, 2)


def sku_campaign_performance(fact: DataFrame) -> DataFrame:
    by = ["sku", "product_title", "product_category", "campaign_name", "channel"]
    return fact.groupBy(*by).agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_quantity_sold").alias("total_quantity_sold"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_cogs").alias("total_cogs"),
        _cogs_share().alias("cogs_percentage"),
        ratio(F.sum("total_revenue"), F.sum("total_orders"), 1, 2).alias("revenue_per_order"),
        ratio(F.sum("total_quantity_sold"), F.sum("total_orders"), 1, 2).alias("quantity_per_order"),
    ).orderBy(F.col("total_revenue").desc(), *by)


def campaign_sku_breakdown(fact: DataFrame) -> DataFrame:
    skus = F.countDistinct("sku")
    return fact.groupBy("campaign_name", "channel").agg(
        skus.alias("unique_skus"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_cogs").alias("total_cogs"),
        _cogs_share().alias("cogs_percentage"),
        ratio(F.sum("total_revenue"), skus, 1, 2).alias("revenue_per_sku"),
        ratio(F.sum("total_orders"), skus, 1, 2).alias("orders_per_sku"),
    ).orderBy(F.col("total_revenue").desc(), "campaign_name", "channel")


def category_performance(fact: DataFrame) -> DataFrame:
    skus = F.countDistinct("sku")
    return fact.where(F.col("product_category").isNotNull()).groupBy("product_category", "channel").agg(
        skus.alias("unique_skus"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_cogs").alias("total_cogs"),
        _cogs_share().alias("cogs_percentage"),
        ratio(F.sum("total_revenue"), skus, 1, 2).alias("revenue_per_sku"),
    ).orderBy(F.col("total_revenue").desc(), "product_category", "channel")


def sku_detail(fact: DataFrame) -> DataFrame:
    """Per SKU, campaign and channel over the fact's whole date range."""
    by = ["sku", "product_title", "product_category", "campaign_id", "campaign_name", "channel"]
    revenue, cogs, orders, units = (F.sum(c) for c in ("total_revenue", "total_cogs", "total_orders", "total_quantity_sold"))
    return fact.groupBy(*by).agg(
        orders.alias("total_orders"), units.alias("total_quantity_sold"),
        revenue.alias("total_revenue"), cogs.alias("total_cogs"),
        ratio(revenue, units, 1, 2).alias("avg_unit_price"),
        ratio(cogs, units, 1, 2).alias("avg_unit_cost"),
        safe_div(revenue - cogs, revenue, 100, 2).alias("profit_margin"),
        ratio(revenue, orders, 1, 2).alias("revenue_per_order"),
        ratio(units, orders, 1, 2).alias("quantity_per_order"),
        F.min("date_start").alias("date_start"), F.max("date_start").alias("date_end"),
    )


def campaign_detail(ad_level: DataFrame) -> DataFrame:
    """Ad-level rows with the detailed table's rates; the match rate is over orders with a campaign id."""
    matched = F.when(F.col("campaign_id").isNotNull(), F.col("orders")).otherwise(F.lit(0))
    return ad_level.select(
        *AD_KEYS, "channel", "impressions", "clicks", "spend", "orders", "total_sales", "total_cogs",
        half_up(F.col("roas"), 2).alias("roas"),
        half_up(F.col("ctr"), 2).alias("ctr"),
        half_up(F.col("conversion_rate"), 2).alias("conversion_rate"),
        safe_div("spend", "orders", 1, 2).alias("cost_per_order"),
        half_up(F.col("profit_margin"), 2).alias("profit_margin"),
        safe_div("attributed_orders", "orders", 100, 2).alias("attribution_rate"),
        safe_div(matched, F.col("orders"), 100, 2).alias("campaign_match_rate"),
    )
