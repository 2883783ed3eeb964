"""UTM sessions, order mapping, hourly metrics and their join with hourly ads."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.functions.channels import match_status, ruled_channel, utm_channel_of
from adtrail.functions.journey import UTM_FIELDS
from adtrail.functions.measures import half_up, mean, ratio, safe_div
from adtrail.functions.text import digits_or_null, hour_label, window_hour
from adtrail.operators.ads import ad_rates
from adtrail.sources.staging import staged
from adtrail.sources.tables import DateWindow, utm_orders

UTM = [f"utm_{f}" for f in UTM_FIELDS]
AD_COLUMNS = ["campaign_id", "campaign_name", "adset_id", "adset_name", "ad_id", "ad_name"]
HOUR_DIMS = [*AD_COLUMNS, *UTM, "channel", "sub_channel"]
SESSION_DEFAULTS = {"visitor_id": "string", "adset_id": "string"}


def _customer_utm() -> list[Column]:
    return [F.col(f"customer_utm_{f}").alias(f"utm_{f}") for f in UTM_FIELDS]


def session_token(order_id="order_id") -> Column:
    """The same token every run, so storing sessions again changes nothing."""
    return F.concat(F.lit("session_"), F.col(order_id))


def utm_sessions(orders: DataFrame, window: DateWindow | None = None) -> DataFrame:
    """One purchase session per UTM-bearing order."""
    return utm_orders(orders, window).select(
        session_token().alias("session_token"),
        F.lit(None).cast("string").alias("visitor_id"),
        "customer_id",
        *_customer_utm(),
        F.col("customer_utm_campaign").alias("campaign_id"),
        digits_or_null("customer_utm_content").alias("ad_id"),
        F.col("order_ts").alias("session_start_time"),
        F.col("order_ts").alias("first_pageview_time"),
        F.lit(True).alias("is_conversion_session"),
        F.lit("purchase").alias("conversion_type"),
        F.coalesce("total_price_amount", F.lit(0)).alias("conversion_value"),
        F.coalesce("total_price_currency", F.lit("INR")).alias("conversion_currency"),
        F.lit("shopify_orders").alias("data_source"),
    )


def utm_order_mapping(orders: DataFrame, window: DateWindow | None = None, batch_id: str = "batch") -> DataFrame:
    """Each UTM-bearing order mapped to its session: last click, weight 1, primary."""
    null = F.lit(None).cast("string")
    channel = utm_channel_of("customer_utm_source", "customer_utm_medium")
    ruled = ruled_channel(*[f"customer_utm_{f}" for f in ("source", "medium", "campaign", "content")])
    return utm_orders(orders, window).select(
        "order_id", "order_name",
        F.col("order_ts").alias("order_date"),
        F.coalesce("total_price_amount", F.lit(0)).alias("order_value"),
        F.coalesce("total_price_currency", F.lit("INR")).alias("order_currency"),
        session_token().alias("session_token"),
        F.lit("last_click").alias("attribution_model"),
        F.lit(1.0).cast("decimal(5,4)").alias("attribution_weight"),
        F.lit(True).alias("is_primary_attribution"),
        *_customer_utm(),
        F.col("customer_utm_campaign").alias("campaign_id"),
        null.alias("campaign_name"), null.alias("adset_id"), null.alias("adset_name"),
        digits_or_null("customer_utm_content").alias("ad_id"),
        null.alias("ad_name"),
        channel.alias("channel"),
        ruled["sub_channel"].alias("sub_channel"),
        F.lit("order_utm").alias("data_source"),
        F.lit(batch_id).alias("batch_id"),
    )


def completeness(fields: list[str]) -> Column:
    """Share (0-100) of the fields a row has filled in."""
    filled = sum(F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) != "", 1).otherwise(0) for f in fields)
    return filled * F.lit(100.0 / len(fields))


REQUIRED = ["order_id", "order_date", "order_value", "utm_source", "utm_medium", "utm_campaign", "ad_id", "channel"]


def hourly_utm_metrics(mapping: DataFrame, sessions: DataFrame, batch_id: str = "batch") -> DataFrame:
    """Sessions, customers, orders and revenue per hour and UTM dimension.

    An order maps to one session, and a session stored several times counts
    once, so orders and sessions are counted as rows; only visitors and
    customers need distinct counts.
    """
    once = sessions.groupBy("session_token").agg(F.max("visitor_id").alias("visitor_id"), F.max("customer_id").alias("customer_id"))
    joined = mapping.join(once.withColumn("_session", F.col("session_token")), "session_token", "left")
    hour = F.hour("order_date")
    orders = F.count(F.lit(1))
    sessions_seen = F.count("_session")
    attributed = F.col("utm_source").isNotNull() | F.col("utm_campaign").isNotNull()
    revenue_kept = F.coalesce(F.sum(F.when(attributed, F.col("order_value"))), F.lit(0))
    return (
        joined.withColumn("_completeness", completeness(REQUIRED))
        .groupBy(F.to_date("order_date").alias("date_start"), hour.alias("hour_start"), *HOUR_DIMS)
        .agg(
            sessions_seen.alias("total_sessions"),
            F.countDistinct("visitor_id").alias("unique_visitors"),
            F.countDistinct("customer_id").alias("unique_customers"),
            orders.alias("total_conversions"),
            F.sum("order_value").alias("total_revenue"),
            orders.alias("total_orders"),
            mean("order_value").alias("avg_order_value"),
            revenue_kept.alias("attributed_revenue"),
            F.count_if(attributed).alias("attributed_orders"),
            safe_div(orders, sessions_seen, 100, 4).alias("conversion_rate"),
            safe_div(F.count_if(attributed), orders, 100, 4).alias("attribution_rate"),
            half_up(mean("_completeness"), 2).alias("data_completeness_score"),
        )
        .withColumn("hour_window", hour_label("hour_start"))
        .withColumn("batch_id", F.lit(batch_id))
    )


def newest_batch(hourly: DataFrame) -> DataFrame:
    """Rows of the latest batch per hour key, for tables that hold several runs."""
    from adtrail.sources.sinks import HOURLY_KEY, latest_per_key

    return latest_per_key(hourly, [c for c in HOURLY_KEY if c != "batch_id"], F.col("batch_id"))


def period_slice(hourly: DataFrame, window: DateWindow) -> DataFrame:
    """Hourly rows of a period, newest first."""
    return hourly.where(window.covers("date_start")).select(
        "date_start", "hour_start", "campaign_id", "ad_id", "utm_source", "utm_medium", "utm_campaign", "channel",
        F.col("total_sessions").alias("sessions"),
        F.col("total_conversions").alias("conversions"),
        F.col("total_revenue").alias("revenue"),
        F.col("total_orders").alias("orders"),
    ).orderBy(F.col("date_start").desc(), F.col("hour_start").desc())


def utm_with_ads(
    hourly: DataFrame, ads: DataFrame, window: DateWindow | None = None, keep_ads_only: bool = False
) -> DataFrame:
    """Hourly UTM rows full-joined with hourly ads on day, hour, campaign and ad.

    The plain form filters on the UTM side's date, which leaves UTM rows only
    (a left join does). ``keep_ads_only`` filters on whichever date is there, so
    ad hours without UTM rows stay.

    The full join is a left join and the ad hours that no UTM key meets: unlike a
    full join, a left one lets adaptive execution split an hour that is crowded
    with rows without ids. The second part meets distinct keys only.
    """
    a = ads.select(
        F.col("date_start").alias("a_date"), window_hour("hourly_window").alias("a_hour"),
        *[F.col(c).alias(f"a_{c}") for c in (*AD_COLUMNS, "impressions", "clicks", "spend", "cpm", "cpc", "ctr")],
    )
    key = lambda c: F.coalesce(c, F.lit(""))
    in_hour = [("date_start", "a_date"), ("hour_start", "a_hour")]
    in_ids = [("campaign_id", "a_campaign_id"), ("ad_id", "a_ad_id")]
    if keep_ads_only:  # read by both parts
        hourly = staged(hourly, "utm-hours")
    u = hourly.alias("u")
    same = reduce(and_, [F.col(f"u.{x}") == F.col(y) for x, y in in_hour] + [key(f"u.{x}") == key(y) for x, y in in_ids])
    joined = u.join(a, same, "left")
    day = F.col("u.date_start")
    if keep_ads_only:
        met = hourly.select(*[F.col(x).alias(f"_{x}") for x, _ in in_hour], *[key(x).alias(f"_{x}") for x, _ in in_ids]).distinct()
        known = reduce(and_, [F.col(f"_{x}") == F.col(y) for x, y in in_hour] + [F.col(f"_{x}") == key(y) for x, y in in_ids])
        joined = joined.unionByName(a.join(met, known, "left_anti"), allowMissingColumns=True).select(
            F.struct(*hourly.columns).alias("u"), *a.columns
        )
        day = F.coalesce("u.date_start", "a_date")
    kept = joined.where(day.between(F.lit(window.start), F.lit(window.end)) if window else day.isNotNull())
    zero = lambda c, name: F.coalesce(c, F.lit(0)).alias(name)
    spend, clicks = F.coalesce("a_spend", F.lit(0)), F.coalesce("a_clicks", F.lit(0))
    conversions, sessions = F.coalesce("u.total_conversions", F.lit(0)), F.coalesce("u.total_sessions", F.lit(0))
    return kept.select(
        (day if keep_ads_only else F.col("u.date_start")).alias("date_start"),
        (F.coalesce("u.hour_start", "a_hour") if keep_ads_only else F.col("u.hour_start")).alias("hour_start"),
        (F.coalesce("u.hour_window", hour_label("a_hour")) if keep_ads_only else F.col("u.hour_window")).alias("hour_window"),
        *[F.coalesce(f"u.{c}", f"a_{c}").alias(c) for c in AD_COLUMNS],
        *[F.col(f"u.{c}").alias(c) for c in (*UTM, "channel", "sub_channel")],
        zero("a_impressions", "ad_impressions"), zero("a_clicks", "ad_clicks"), zero("a_spend", "ad_spend"),
        zero("a_cpm", "ad_cpm"), zero("a_cpc", "ad_cpc"), zero("a_ctr", "ad_ctr"),
        zero("u.total_sessions", "utm_sessions"), zero("u.unique_visitors", "utm_visitors"),
        zero("u.unique_customers", "utm_customers"), zero("u.total_conversions", "utm_conversions"),
        zero("u.conversion_rate", "utm_conversion_rate"), zero("u.total_revenue", "utm_revenue"),
        zero("u.total_orders", "utm_orders"), zero("u.avg_order_value", "utm_avg_order_value"),
        zero("u.attributed_revenue", "attributed_revenue"), zero("u.attributed_orders", "attributed_orders"),
        zero("u.attribution_rate", "attribution_rate"),
        safe_div(F.coalesce("u.attributed_revenue", F.lit(0)), spend, 1, 4).alias("roas"),
        safe_div(conversions, clicks, 100, 4).alias("conversion_rate_percent"),
        safe_div(conversions, sessions, 100, 4).alias("session_to_conversion_rate"),
        zero("u.data_completeness_score", "utm_data_quality"),
        match_status("a_campaign_id", "u.campaign_id").alias("data_match_status"),
        F.col("u.batch_id").alias("utm_batch_id"),
        F.col("a_date").alias("ads_date_start"),
    )


def hourly_purchase_analysis(hourly: DataFrame, ads: DataFrame, window: DateWindow) -> DataFrame:
    """The joined hours with the report's columns, newest and highest revenue first."""
    columns = [
        "date_start", "hour_start", "hour_window", "campaign_id", "campaign_name", "ad_id", "ad_name",
        "utm_source", "utm_medium", "utm_campaign", "channel", "sub_channel",
        "ad_impressions", "ad_clicks", "ad_spend", "ad_cpm", "ad_cpc", "ad_ctr",
        "utm_sessions", "utm_conversions", "utm_conversion_rate", "utm_revenue", "utm_orders",
        "utm_avg_order_value", "attributed_revenue", "attributed_orders", "attribution_rate",
        "roas", "conversion_rate_percent", "utm_data_quality", "data_match_status",
    ]
    return utm_with_ads(hourly, ads, window).select(*columns).orderBy(
        F.col("date_start").desc(), F.col("hour_start").desc(), F.col("utm_revenue").desc()
    )


def analysis_summaries(analysis: DataFrame) -> dict[str, DataFrame]:
    """By channel, top 10 campaigns and by hour, from the purchase analysis."""
    sums = lambda *cols: [F.round(F.sum(c), 2).alias(c) for c in cols]
    return {
        "channel": analysis.where(F.col("channel").isNotNull()).groupBy("channel").agg(
            *sums("utm_revenue", "utm_orders", "ad_spend", "utm_conversions")
        ),
        # The report groups by campaign name; where the model leaves it empty the id names the campaign.
        "campaign": analysis.groupBy(F.coalesce("campaign_name", "campaign_id").alias("campaign_name"), "channel")
        .agg(*sums("utm_revenue", "ad_spend", "utm_conversions"))
        .dropna(subset=["campaign_name", "channel"])
        .orderBy(F.col("utm_revenue").desc(), "campaign_name", "channel").limit(10),
        "hour": analysis.groupBy("hour_start").agg(*sums("utm_revenue", "utm_orders", "utm_conversions")),
    }


def coverage(hourly: DataFrame, ads: DataFrame, window: DateWindow | None = None, fan_out: bool = True) -> DataFrame:
    """UTM and ad coverage per hour.

    The plain query joins all UTM rows of an hour with all its ad rows and sums
    over the product. That sum is each side's own sum times the other side's
    row count, so both sides are folded to one row per hour first and no pair
    is formed. ``fan_out=False`` gives each side's own sums.
    """
    u = hourly.where(window.covers("date_start")) if window else hourly
    left = u.groupBy("date_start", "hour_start").agg(
        F.countDistinct("campaign_id").alias("utm_campaigns"),
        F.countDistinct("ad_id").alias("utm_ads"),
        F.sum("total_revenue").alias("_revenue"),
        F.count(F.lit(1)).alias("_u"),
    )
    right = ads.groupBy("date_start", window_hour("hourly_window").alias("hour_start")).agg(
        F.countDistinct("campaign_id").alias("ads_campaigns"),
        F.countDistinct("ad_id").alias("ads_ads"),
        F.sum("spend").alias("_spend"),
        F.count(F.lit(1)).alias("_a"),
    )
    joined = left.join(right, ["date_start", "hour_start"], "left")
    times_ads = F.coalesce("_a", F.lit(1)) if fan_out else F.lit(1)
    times_utm = F.col("_u") if fan_out else F.lit(1)
    return joined.select(
        "date_start", "hour_start", "utm_campaigns", "utm_ads",
        F.coalesce("ads_campaigns", F.lit(0)).alias("ads_campaigns"),
        F.coalesce("ads_ads", F.lit(0)).alias("ads_ads"),
        (F.col("_revenue") * times_ads).alias("utm_revenue"),
        (F.col("_spend") * times_utm).alias("ads_spend"),
        safe_div(F.col("_revenue") * times_ads, F.coalesce(F.col("_spend") * times_utm, F.lit(0)), 1, 4).alias("roas"),
    ).orderBy(F.col("date_start").desc(), F.col("hour_start").desc())


def orphan_mappings(mapping: DataFrame, sessions: DataFrame) -> DataFrame:
    """Order mappings whose session is not stored."""
    return mapping.join(sessions.select("session_token"), "session_token", "left_anti")


def since(as_of: date, days: int, column: str = "date_start") -> Column:
    """Column on or after ``as_of`` minus ``days``."""
    return F.col(column) >= F.date_sub(F.lit(as_of), days)
