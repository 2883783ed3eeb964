"""Hourly insight: ad hours beside the orders that fall into them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.functions.measures import total
from adtrail.functions.text import hour_label, normal_hour_window, normal_id, wall_clock
from adtrail.operators.ads import AD_KEYS, ad_rates
from adtrail.operators.attribution import UTM_COLUMNS, classified, direct_with_campaign, reclassified

HOUR_KEY = [*AD_KEYS, "date_start", "hour_label"]
IDS = ["campaign_id", "adset_id", "ad_id"]
NAMES = {"campaign_name": "Campaign", "adset_name": "Adset", "ad_name": "Ad"}
FIRST_COLUMNS = ["channel", "attribution_source", *UTM_COLUMNS]
AD_METRICS = ["impressions", "clicks", "spend", "action_onsite_web_purchase", "value_onsite_web_purchase"]


def first_filled(column: str, by: str) -> Column:
    """Value of the row that is lowest in ``by`` among rows where it is neither null nor ''."""
    return F.min_by(column, F.when(F.col(column) != "", F.col(by)))


def hourly_ads(ads: DataFrame) -> DataFrame:
    """Ad rows with normal ids and a canonical hour; rows without an hour are left out."""
    keyed = ads.withColumns({c: normal_id(c) for c in IDS}).withColumn(
        "hour_label", normal_hour_window("hourly_window")
    )
    return keyed.where(F.col("hour_label").isNotNull()).select(*HOUR_KEY, *AD_METRICS)


def backfill_times(attributed: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders without a time get the one their source order was created at; an order kept several times gives the earliest."""
    base = orders.select(F.col("order_id").alias("_id"), wall_clock("created_at_ist").alias("_t")).groupBy("_id").agg(F.min("_t").alias("_t"))
    filled = attributed.join(base, F.col("order_id") == F.col("_id"), "left").withColumn("order_ts", F.coalesce("order_ts", "_t"))
    return filled.drop("_id", "_t")


def keyed_orders(attributed: DataFrame) -> DataFrame:
    """Attributed orders with the eight-part hour key."""
    return attributed.withColumns(
        {
            **{c: normal_id(c) for c in IDS},
            **{c: F.coalesce(c, F.lit("")) for c in NAMES},
            "date_start": F.to_date("order_ts"),
            "hour_label": hour_label(F.hour("order_ts")),
        }
    )


def orders_by_hour(attributed: DataFrame) -> DataFrame:
    """Orders per hour key; one row per order is expected, so orders are counted, not deduplicated."""
    return keyed_orders(attributed).groupBy(*HOUR_KEY).agg(
        F.count(F.lit(1)).alias("shopify_orders"),
        total("order_value").alias("shopify_revenue"),
        total("total_cogs").alias("shopify_cogs"),
        total("total_sku_quantity").alias("total_sku_quantity"),
        *[first_filled(c, "order_id").alias(c) for c in FIRST_COLUMNS],
    )


def id_lists(attributed: DataFrame, dealt: int = 64) -> DataFrame:
    """All order ids of each hour key, as an array.

    Ids are gathered over ``dealt`` parts of a key first, so a key with a large share of the orders is gathered by
    many tasks; its list is whole, whatever its size.
    """
    keyed = keyed_orders(attributed).select(*HOUR_KEY, "order_id", F.pmod(F.xxhash64("order_id"), F.lit(dealt)).alias("_part"))
    parts = keyed.groupBy(*HOUR_KEY, "_part").agg(F.collect_set("order_id").alias("_ids"))
    return parts.groupBy(*HOUR_KEY).agg(F.flatten(F.collect_list("_ids")).alias("_ids"))


def id_text(ids) -> Column:
    return F.array_join(F.array_sort(ids), ", ")


def order_ids_by_hour(attributed: DataFrame, dealt: int = 64) -> DataFrame:
    """The sorted order-id list of each hour key."""
    return id_lists(attributed, dealt).select(*HOUR_KEY, id_text(F.col("_ids")).alias("order_ids"))


def granular_insights(attributed: DataFrame, ads: DataFrame, order_ids: bool = False) -> DataFrame:
    """Full outer join of ad hours and order hours, with channels settled per row.

    Both sides are keyed null-safe, so missing keys meet each other; orders are
    folded to their key first, so the join adds no rows. Ad hours without
    orders stay with an empty channel, orders without ad hours are named
    "Unknown ... - <channel>".
    """
    left = hourly_ads(ads).withColumn("_ads", F.lit(True)).alias("a")
    right = orders_by_hour(attributed)
    if order_ids:
        lists = id_lists(attributed)
        same = reduce(lambda a, b: a & b, [right[c].eqNullSafe(lists[c]) for c in HOUR_KEY])
        right = right.join(lists, same, "left").select(*[right[c] for c in right.columns], "_ids")
    right = right.withColumn("_orders", F.lit(True)).alias("o")
    same = reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"o.{c}")) for c in HOUR_KEY])
    measures = ["shopify_orders", "shopify_revenue", "shopify_cogs", "total_sku_quantity"]
    joined = left.join(right, same, "full").select(
        *[F.when(F.col("_ads"), F.col(f"a.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in HOUR_KEY],
        *[F.when(F.col("_ads"), F.col(c)).otherwise(F.lit(0)).alias(c) for c in AD_METRICS],
        *[F.coalesce(c, F.lit(0)).alias(c) for c in measures],
        *[F.coalesce(c, F.lit("")).alias(c) for c in FIRST_COLUMNS],
        *(["_ids"] if order_ids else []),
        F.coalesce("_ads", F.lit(False)).alias("has_ads"),
        F.coalesce("_orders", F.lit(False)).alias("has_orders"),
    )
    again = F.col("_again")
    settled = (
        classified(joined, "_again")
        .withColumn("channel", F.when(again != "Direct", again).otherwise(F.col("channel")))
        .drop("_again")
        .withColumn("_moved", direct_with_campaign())
        .withColumn(
            "_meta_name",
            F.concat(
                F.lit("Meta Campaign - "),
                F.when(F.col("utm_campaign").isin("", "null"), "Unknown").otherwise(F.col("utm_campaign")),
            ),
        )
        .withColumn("channel", reclassified())
        .withColumn("campaign_name", F.when(F.col("_moved"), F.col("_meta_name")).otherwise(F.col("campaign_name")))
        .drop("_moved", "_meta_name")
    )
    label = F.when(F.col("channel") == "", "Direct/Unknown").otherwise(F.col("channel"))
    named = settled.withColumns(
        {
            c: F.when(F.col("has_ads"), F.col(c)).otherwise(F.concat(F.lit(f"Unknown {level} - "), label))
            for c, level in NAMES.items()
        }
    )
    return one_row_per_key(named, order_ids)


def one_row_per_key(granular: DataFrame, order_ids: bool) -> DataFrame:
    """Rows that end up under the same key are summed, their id lists joined and their rates worked out anew."""
    order = F.struct(~F.col("has_orders"), *FIRST_COLUMNS)
    lists = [id_text(F.flatten(F.collect_list("_ids"))).alias("order_ids")] if order_ids else []
    folded = (
        granular.groupBy(*HOUR_KEY)
        .agg(
            *[F.sum(c).alias(c) for c in (
                *AD_METRICS, "shopify_orders", "shopify_revenue", "shopify_cogs", "total_sku_quantity",
            )],
            F.min(order).alias("_first"),
            *lists,
            F.max("has_ads").alias("has_ads"),
            F.max("has_orders").alias("has_orders"),
        )
        .select("*", *[F.col(f"_first.{c}").alias(c) for c in FIRST_COLUMNS])
        .drop("_first")
    )
    return ad_rates(folded).withColumn("hourly_window", F.col("hour_label"))


def granular_report(granular: DataFrame) -> DataFrame:
    """In reading order: day, hour, revenue from high to low."""
    return granular.orderBy("date_start", "hour_label", F.col("shopify_revenue").desc(), *AD_KEYS)


def channel_summary(granular: DataFrame, unmatched_only: bool = False) -> DataFrame:
    rows = granular.where(F.col("campaign_name").contains("Unknown Campaign")) if unmatched_only else granular
    return rows.groupBy("channel").agg(
        *[
            F.round(F.sum(c), 2).alias(c)
            for c in ("shopify_orders", "shopify_revenue", *([] if unmatched_only else ["shopify_cogs"]))
        ]
    )
