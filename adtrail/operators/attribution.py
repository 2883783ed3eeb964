"""Which channel, campaign and ad earned each order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.functions import journey
from adtrail.functions.channels import PAID_CHANNELS, channel_of, clean
from adtrail.functions.journey import UTM_FIELDS
from adtrail.functions.measures import as_column
from adtrail.functions.text import non_empty, trimmed
from adtrail.operators.ads import AD_KEYS, daily_ads, first_ad_per_id
from adtrail.operators.orders import priced_lines, with_line_totals
from adtrail.sources.tables import DateWindow, ads_window, order_window

# Channels that get an "Unknown ..." ad when no ad record is found.
NAMED_UNKNOWN = ["Meta", "Google", "Organic"]
UTM_COLUMNS = [f"utm_{f}" for f in UTM_FIELDS]


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters and projections read instead of working them out again.

    Catalyst copies a projected expression into every filter it pushes below
    the projection; for parsed JSON that means parsing a row dozens of times.
    A generator's output is never copied, so a one-row ``inline`` keeps each
    expression in one place. Filters on the other columns still go below it.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_touch(orders: DataFrame) -> DataFrame:
    """Add attribution source, id, type, UTM fields and the first channel guess.

    JSON text is parsed once, fields are picked from the parsed values once,
    and the cascade reads the picked fields. The texts themselves stop here;
    flags tell that they were there.
    """
    kept = [c for c in orders.columns if c not in ("customer_journey", "custom_attributes")]
    parsed = evaluate_once(
        orders, {"_moments": journey.moments("customer_journey"), "_pairs": journey.pairs("custom_attributes")}
    )
    own = journey.attribute_fields(F.col("_pairs"))
    picked = evaluate_once(
        parsed,
        {
            "_journey": journey.last_usable(F.col("_moments")),
            "_attributes": F.struct(*[c.alias(f) for f, c in own.items()]),
            **{f"_own_{f}": F.when(trimmed(c) != "", F.col(c)) for f, c in journey.ORDER_COLUMNS.items()},
        },
    )
    touch, label = journey.first_touch_found(
        F.col("_journey"),
        journey.known_touch({f: F.col(f"_attributes.{f}") for f in UTM_FIELDS}),
        journey.known_touch({f: F.col(f"_own_{f}") for f in UTM_FIELDS}),
    )
    found = evaluate_once(picked, {"_touch": touch, "attribution_source": label})
    spread = found.select(
        *kept, "attribution_source",
        *[F.col(f"_touch.{f}").alias(f"utm_{f}") for f in UTM_FIELDS],
        "_touch.attribution_id", "_touch.attribution_type",
        F.col("attribution_source").isNotNull().alias("is_attributed"),
        F.col("customer_journey").isNotNull().alias("has_customer_journey"),
        F.col("custom_attributes").isNotNull().alias("has_custom_attributes"),
    )
    return classified(spread, "channel")


def classified(df: DataFrame, out: str) -> DataFrame:
    """Add the channel of the UTM columns, cleaning each of them once."""
    cleaned = {f"_clean_{f}": clean(f"utm_{f}") for f in UTM_FIELDS}
    rows = evaluate_once(df, cleaned)
    return evaluate_once(rows, {out: channel_of(*cleaned, cleaned=True)}).drop(*cleaned)


def with_ad_id(orders: DataFrame) -> DataFrame:
    """Add the order's ad id: journey content, then attribute content, then the UTM column."""
    found = evaluate_once(
        orders,
        {
            "_journey_ad": journey.journey_ad_id("customer_journey"),
            "_attribute_ad": journey.attributes_ad_id("custom_attributes"),
        },
    )
    return evaluate_once(
        found,
        {"ad_id": F.coalesce(non_empty("_journey_ad"), non_empty("_attribute_ad"), non_empty(trimmed("customer_utm_content")))},
    ).drop("_journey_ad", "_attribute_ad")


def settle_channel(channel="channel", is_attributed="is_attributed", hint: Column | None = None) -> Column:
    """Channel of orders without attribution: Meta counts as Organic.

    The channel rules always end in one of four channels. For other rule sets
    ``hint`` (such as ``hinted_channel``) decides where they end in none.
    """
    channel, attributed = as_column(channel), as_column(is_attributed)
    settled = F.when(~attributed & (channel == "Meta"), "Organic")
    if hint is not None:
        settled = settled.when(~attributed & ~channel.isin("Google", "Organic", "Direct"), hint)
    return settled.otherwise(channel)


def _filled(column: str) -> Column:
    return F.coalesce(~F.col(column).isin("", "null"), F.lit(False))


def direct_with_campaign(with_names: bool = True) -> Column:
    """Direct rows that still carry a campaign, a source label or a known campaign name."""
    found = _filled("utm_campaign") | F.coalesce(F.col("attribution_source") != "", F.lit(False))
    if with_names:
        name = F.col("campaign_name")
        found = found | F.coalesce((name != "") & ~name.contains("Unknown"), F.lit(False))
    return (F.col("channel") == "Direct") & found


def reclassified(with_names: bool = True) -> Column:
    """Direct with campaign data becomes Meta, Direct with source data Organic."""
    return (
        F.when(direct_with_campaign(with_names), "Meta")
        .when((F.col("channel") == "Direct") & (_filled("utm_source") | _filled("utm_medium")), "Organic")
        .otherwise(F.col("channel"))
    )


def with_channels(orders: DataFrame) -> DataFrame:
    """Touch, channel and flags of each order, without the ad lookup.

    A known campaign name needs an attribution, so these channels equal those
    of ``attribute`` and reports by channel need no join with ads.
    """
    settled = with_touch(orders).withColumn("first_channel", settle_channel()).drop("channel")
    settled = settled.withColumn("channel", F.col("first_channel"))
    paid = F.col("channel").isin(PAID_CHANNELS) | direct_with_campaign(False)
    final = evaluate_once(settled, {"_final": reclassified(False), "is_paid_channel": paid})
    return final.withColumn("channel", F.col("_final")).drop("_final")


def unknown_name(level: str, channel: Column) -> Column:
    """'Unknown Campaign - Meta' and the like; null for other channels."""
    return F.when(channel.isin(NAMED_UNKNOWN), F.concat(F.lit(f"Unknown {level} - "), channel))


def match_ads(orders: DataFrame, daily: DataFrame) -> DataFrame:
    """Add the earliest ad record under each order's attribution id.

    The ad side holds one row per id, so the join never multiplies orders. Its
    size decides at run time between a broadcast and a sort-merge join whose
    skewed order partitions are split. Orders without an id are spread by their
    own id, as equal null keys would all land in one partition.
    """
    ads = first_ad_per_id(daily).withColumnsRenamed({"attribution_type": "_type", "attribution_id": "_id"})
    spread_id = F.coalesce("attribution_id", "order_id")
    joined = orders.join(ads, (F.col("attribution_type") == ads["_type"]) & (spread_id == ads["_id"]), "left")
    channel = F.col("first_channel")
    names = {"campaign_name": "Campaign", "adset_name": "Adset", "ad_name": "Ad"}
    columns = {}
    for key in AD_KEYS:
        found = F.col(f"ad.{key}")
        columns[key] = F.coalesce(found, F.when(F.col("ad").isNull(), unknown_name(names[key], channel))) if key in names else found
    metrics = {
        "matched_impressions": "impressions",
        "matched_clicks": "clicks",
        "matched_spend": "spend",
        "matched_purchases": "action_onsite_web_purchase",
        "matched_revenue": "value_onsite_web_purchase",
    }
    for out, metric in metrics.items():
        columns[out] = F.coalesce(F.col(f"ad.{metric}"), F.lit(0))
    return joined.withColumns(columns).drop("ad", "_type", "_id")


ORDER_COLUMNS = [
    "order_id", "order_name", "order_date", "order_ts", "order_value", "order_currency",
    "ship_city", "ship_province", "ship_country",
]
LINE_COLUMNS = ["total_cogs", "line_items_count", "skus", "unique_skus_count", "total_sku_quantity"]
MATCH_COLUMNS = [
    *AD_KEYS, "matched_impressions", "matched_clicks", "matched_spend", "matched_purchases", "matched_revenue",
]
FLAG_COLUMNS = ["has_customer_journey", "has_custom_attributes", "is_attributed", "is_paid_channel"]


def attribute(
    orders: DataFrame,
    line_items: DataFrame | None = None,
    variants: DataFrame | None = None,
    ads: DataFrame | None = None,
    window: DateWindow | None = None,
) -> DataFrame:
    """One row per order with its attribution.

    Leave out the line items (no cogs and SKU columns) or the ads (no campaign
    and ad columns) where a report does not need them: their joins then never run.
    """
    rows = with_channels(order_window(orders, window)).withColumnsRenamed(
        {"total_price_amount": "order_value", "total_price_currency": "order_currency"}
    )
    columns = list(ORDER_COLUMNS)
    rows = rows.select(
        *ORDER_COLUMNS, "channel", "first_channel", "attribution_source", "attribution_id",
        "attribution_type", *UTM_COLUMNS, *FLAG_COLUMNS,
    )
    if line_items is not None:
        rows = with_line_totals(rows, priced_lines(line_items, variants))
        columns += LINE_COLUMNS
    if ads is not None:
        rows = match_ads(rows, daily_ads(ads_window(ads, window)))
        columns += MATCH_COLUMNS
    return rows.select(
        *columns, "channel", "attribution_source", "attribution_id", "attribution_type",
        *UTM_COLUMNS, *FLAG_COLUMNS,
    )
