"""Every report as a query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail.functions import channels, journey, text
from adtrail.functions.measures import half_up, to_number
from adtrail.functions.text import wall_clock
from adtrail.operators import adlevel, ads, granular, mapping, platforms, products, quality, reports, sessions, sku, touch, utm
from adtrail.operators.attribution import attribute, with_ad_id, with_channels, with_touch
from adtrail.operators.orders import fold_lines, priced_lines
from adtrail.plans import mapping_views, sql_functions, utm_views, warehouse
from adtrail.sources import sinks, testbed, versions
from adtrail.sources.staging import staging_path
from adtrail.sources.tables import DateWindow, newest_active, order_window, orders_with_skus, profile, utm_orders, wide_orders
from adtrail.streaming.hourly import hourly_metrics
from adtrail.streaming.live import live_last_click

AS_OF = date(2024, 1, 30)
MONTH = DateWindow(date(2024, 1, 1), date(2024, 1, 30))
NOW = datetime(2024, 1, 30, 12, 0, 0)
BATCH = "batch_1"
QUERIES: dict = {}


def plain(df: DataFrame) -> DataFrame:
    """Simple column types: decimals as double, integers as bigint, dates and times as text."""
    columns = []
    for field in df.schema:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(build):
    QUERIES[build.__name__] = lambda spark, sf_dir, build=build: plain(build(Inputs(spark, sf_dir)))
    return build


class Inputs:
    """The tables a query asks for, built when asked."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir

    def orders(self, **kw):
        return testbed.orders(self.spark, self.sf, **kw)

    def store(self, **kw):
        return testbed.store(self.spark, self.sf, **kw)

    def ads(self):
        return testbed.ads_hourly(self.spark, self.sf)

    def daily(self):
        return ads.daily_ads(self.ads())

    def lines(self):
        return priced_lines(testbed.line_items(self.spark, self.sf), testbed.variants(self.spark, self.sf))

    def events(self):
        return testbed.events(self.spark, self.sf)

    def raw(self, lines: bool = True, campaigns: bool = True, **kw):
        s = self.store(**kw)
        return attribute(
            s.orders, s.line_items if lines else None, s.variants if lines else None, s.ads if campaigns else None
        )

    def mapped(self):
        s = self.store()
        return mapping.order_ad_mapping(s.orders, s.line_items, s.variants, s.ads)

    def ad_level(self):
        return sinks.tag_ads(
            adlevel.ad_level_summary(self.raw(), self.daily()), BATCH, MONTH.start, MONTH.end
        )

    def utm_mapping(self):
        return utm.utm_order_mapping(self.orders(), None, BATCH)

    def utm_sessions(self):
        return utm.utm_sessions(self.orders())

    def hourly(self):
        return utm.hourly_utm_metrics(self.utm_mapping(), self.utm_sessions(), BATCH)

    def performance(self):
        return utm_views.utm_ad_hourly_performance(self.hourly(), self.ads(), AS_OF)

    def sku_rows(self, last_line: bool = False):
        return sku.sku_attribution(self.raw(lines=False), self.lines(), self.ads(), last_line)

    def fact(self):
        return sku.sku_campaign_fact(self.sku_rows(), testbed.variants(self.spark, self.sf))

    def log(self):
        return testbed.run_log(self.spark, self.sf)

    def platforms(self):
        return platforms.with_platform(self.raw(lines=False, campaigns=False))

    def touches(self):
        return testbed.touches(self.spark, self.sf), testbed.conversions(self.spark, self.sf)


# --- scans ---------------------------------------------------------------------

@query
def wide_order_scan(t):
    s = t.store()
    return wide_orders(s.orders, s.line_items, s.variants, MONTH).select(
        "order_id", "order_ts", "total_price_amount", "item_id", "product_title", "quantity",
        "original_unit_price_amount", "discounted_unit_price_amount", "sku", "unit_cost_amount",
        "variant_product_title", "vendor", "selling_price",
    )


@query
def slim_order_scan(t):
    s = t.store()
    return orders_with_skus(s.orders, s.line_items, s.variants, MONTH).select(
        "order_id", "order_date", "order_value", "customer_utm_content", "item_id", "sku", "quantity", "unit_cost_amount"
    )


@query
def utm_order_scan(t):
    return utm_orders(t.orders(), MONTH).select(
        "order_id", "order_name", "order_ts", "total_price_amount", "customer_utm_source", "customer_utm_medium", "customer_id"
    )


@query
def source_profile(t):
    orders = t.orders()
    if "order_date" not in orders.columns:
        orders = orders.withColumn("order_date", F.to_date(wall_clock("created_at_ist")))
    return profile({"orders": (orders, "order_date"), "ads": (t.ads(), "date_start")}, DateWindow(date(2024, 1, 10), date(2024, 1, 20)))


@query
def newest_parameters(t):
    log = t.log().withColumn("is_active", F.col("execution_status") == "SUCCESS")
    return newest_active(log.withColumn("created_at", F.col("execution_start_time"))).select(
        "pipeline_run_id", "batch_id", "created_at"
    )


# --- ad rollups ----------------------------------------------------------------

@query
def ads_daily_rollup(t):
    return t.daily()


@query
def ads_daily_named(t):
    return ads.daily_ads_named(t.ads())


# --- channels and touches --------------------------------------------------------

@query
def channel_classify(t):
    return t.orders().select(
        "order_id", channels.channel_of(*[f"customer_utm_{f}" for f in journey.UTM_FIELDS]).alias("channel")
    )


@query
def utm_channel_classify(t):
    return t.orders().select("order_id", channels.utm_channel_of("customer_utm_source", "customer_utm_medium").alias("channel"))


@query
def regex_channel_rules(t):
    result = channels.ruled_channel(*[f"customer_utm_{f}" for f in ("source", "medium", "campaign", "content")])
    return t.orders().withColumn("rule", result).select("order_id", "rule.*")


@query
def rule_table_channels(t):
    columns = ["utm_source_pattern", "utm_medium_pattern", "utm_campaign_pattern", "utm_content_pattern", *channels.RULE_OUTPUTS, "priority"]
    kinds = ", ".join([*[f"{c} string" for c in columns[:-1]], "priority int"])
    table = t.spark.createDataFrame(channels.CHANNEL_RULES, kinds).withColumns({"rule_id": F.monotonically_increasing_id(), "is_active": F.lit(True)})
    ruled = channels.ruled_by_table(t.orders(), table, [f"customer_utm_{f}" for f in ("source", "medium", "campaign", "content")])
    return ruled.select("order_id", "rule.*")


@query
def source_dictionary(t):
    return t.orders().select("order_id", channels.mapped_channel("customer_utm_source", "Other").alias("channel"))


@query
def referrer_channel(t):
    return t.orders(referrers=True).select(
        "order_id", channels.hinted_channel("customer_referrer_url", "customer_journey", "custom_attributes").alias("channel")
    )


@query
def attribution_cascade(t):
    return with_touch(t.orders()).select(
        "order_id", "attribution_source", "attribution_id", "attribution_type",
        "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "channel", "is_attributed",
    )


@query
def channel_settled(t):
    return with_channels(t.orders()).select("order_id", "first_channel", "channel", "is_paid_channel")


@query
def order_ad_ids(t):
    return with_ad_id(t.orders()).select("order_id", "ad_id")


@query
def id_and_hour_normaliser(t):
    k = F.col("k")
    kind = F.pmod("event_id", F.lit(5))
    raw_id = (
        F.when(kind == 0, testbed.ad_id(k)).when(kind == 1, F.concat(k.cast("string"), F.lit(".5e+3")))
        .when(kind == 2, "").when(kind == 3, F.concat(F.lit("Facebook_"), k.cast("string")))
    )
    hour = F.hour("ts")
    raw_hour = (
        F.when(kind == 0, text.hour_label(hour)).when(kind == 1, hour.cast("string"))
        .when(kind == 2, F.concat((hour + 24).cast("string"), F.lit(":00"))).when(kind == 3, "abc")
    )
    raw_ts = (
        F.when(kind == 0, F.date_format("ts", "dd/MM/yyyy HH:mm:ss")).when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+0530"))).when(kind == 3, "not a time")
    )
    raw_number = F.when(kind < 2, k.cast("string")).when(kind == 2, "x")
    return t.events().select(
        "event_id", text.normal_id(raw_id).alias("ad_id"), text.normal_hour_window(raw_hour).alias("hour_label"),
        text.parse_timestamp(raw_ts).alias("parsed_ts"), to_number(raw_number).alias("number"),
        text.is_blank(raw_id).alias("blank_id"), text.is_digits(raw_id).alias("digits"),
    )


# --- orders and attribution -------------------------------------------------------

@query
def order_fold(t):
    return fold_lines(t.lines())


@query
def attribution_match(t):
    return t.raw(lines=False).select(
        "order_id", *ads.AD_KEYS, "matched_impressions", "matched_clicks", "matched_spend", "matched_purchases", "matched_revenue", "channel"
    )


@query
def attribution_export(t):
    return sinks.raw_export(t.raw())


@query
def attribution_tagged(t):
    return sinks.tag_orders(t.raw(geography=True), BATCH)


@query
def channel_breakdown(t):
    return reports.channel_breakdown(t.raw(False, False))


@query
def source_breakdown(t):
    return reports.source_breakdown(t.raw(False, False))


@query
def grand_totals(t):
    return reports.grand_totals(t.raw(False, False))


@query
def campaign_performance(t):
    return reports.campaign_performance(t.raw(), t.daily())


@query
def campaign_summary(t):
    return reports.campaign_summary(t.raw(), t.daily())


@query
def ad_performance(t):
    return reports.ad_performance(t.raw(), t.daily())


@query
def batch_metrics(t):
    return reports.batch_metrics(t.raw(False, False), t.ad_level())


# --- granular and ad level ---------------------------------------------------------

@query
def granular_hourly(t):
    return granular.granular_report(granular.granular_insights(t.raw(), t.ads())).drop("hourly_window")


@query
def granular_order_ids(t):
    return granular.order_ids_by_hour(t.raw(lines=False))


@query
def order_time_backfill(t):
    rows = t.raw(lines=False).withColumn("order_ts", F.when(F.col("channel") != "Direct", F.col("order_ts")))
    filled = granular.backfill_times(rows, t.orders())
    return filled.select("order_id", "order_ts", text.hour_label(F.hour("order_ts")).alias("hour_label"))


@query
def granular_channel_summary(t):
    return granular.channel_summary(granular.granular_insights(t.raw(), t.ads()))


@query
def granular_unmatched_summary(t):
    return granular.channel_summary(granular.granular_insights(t.raw(), t.ads()), unmatched_only=True)


@query
def ad_level_summary(t):
    return t.ad_level()


@query
def ad_level_spend_once(t):
    return adlevel.ad_level_summary(t.raw(), t.daily()).select("ad_id", "campaign_name", "channel", "spend", "spend_once")


@query
def daily_platform_comparison(t):
    return adlevel.platform_comparison(t.raw(), t.daily())


@query
def range_join_kpis(t):
    return adlevel.range_kpis(t.raw(), t.ad_level())


@query
def range_join_kpis_once(t):
    return adlevel.range_kpis(t.raw(), t.ad_level(), dedupe_spend=True)


# --- views over attributed orders ---------------------------------------------------

@query
def daily_attribution_summary(t):
    return warehouse.daily_attribution_summary(t.raw(campaigns=False))


@query
def channel_performance(t):
    return warehouse.channel_performance(t.raw(campaigns=False))


@query
def campaign_performance_view(t):
    return warehouse.campaign_performance(t.raw())


@query
def attribution_source_analysis(t):
    return warehouse.attribution_source_analysis(t.raw(False, False))


@query
def sku_performance(t):
    return warehouse.sku_performance(t.raw())


@query
def monthly_attribution_trends(t):
    return warehouse.monthly_attribution_trends(t.raw(False, False))


@query
def attribution_quality_analysis(t):
    return warehouse.attribution_quality_analysis(t.raw(lines=False))


@query
def top_performing_campaigns(t):
    return warehouse.top_performing_campaigns(t.raw())


@query
def attribution_funnel(t):
    return warehouse.attribution_funnel(t.raw(lines=False), warehouse.campaign_totals(t.daily()))


@query
def attribution_funnel_once(t):
    return warehouse.attribution_funnel(t.raw(lines=False), warehouse.campaign_totals(t.daily()), fan_out=False)


@query
def geographic_attribution(t):
    return warehouse.geographic_analysis(t.raw(False, False, geography=True))


@query
def attribution_daily_summary(t):
    return warehouse.attribution_daily_summary(t.raw())


@query
def campaign_performance_summary(t):
    return warehouse.campaign_performance_summary(t.ad_level())


@query
def ad_performance_summary(t):
    return warehouse.ad_performance_summary(t.ad_level())


@query
def channel_performance_summary(t):
    return warehouse.channel_performance_summary(t.ad_level())


@query
def top_campaigns_by_roas(t):
    return warehouse.top_campaigns_by_roas(t.ad_level())


@query
def attribution_rate_by_channel(t):
    return warehouse.attribution_rate_by_channel(t.raw(False, False), AS_OF)


# --- SKU-to-ad mapping ---------------------------------------------------------------

@query
def order_ad_mapping(t):
    return t.mapped()


def _mapping_view(name, build):
    def view(t):
        return build(t.mapped())

    view.__name__ = name
    query(view)


for _name in (
    "sku_ad_performance", "ad_sku_performance", "daily_order_ad_performance", "campaign_sku_breakdown",
    "top_performing_skus", "top_performing_ads", "sku_ad_efficiency", "campaign_sku_matrix",
    "daily_sku_performance", "daily_ad_performance", "best_sku_ads", "underperforming_ads",
):
    _mapping_view(_name, getattr(mapping_views, _name))


@query
def daily_trend(t):
    return mapping_views.daily_trend(t.mapped(), AS_OF)


@query
def mapping_spend_once(t):
    return mapping.spend_once(t.mapped(), ["campaign_name"])


# --- UTM model -------------------------------------------------------------------------

@query
def utm_sessions(t):
    return t.utm_sessions()


@query
def utm_order_mapping(t):
    return t.utm_mapping()


@query
def utm_hourly_metrics(t):
    return t.hourly()


@query
def utm_period_slice(t):
    return utm.period_slice(t.hourly(), DateWindow(date(2024, 1, 10), date(2024, 1, 20)))


@query
def utm_period_by_model(t):
    """The period function of SQL under every model."""
    sql_functions.register_period_function(t.hourly(), *t.touches(), days=7, half_life_days=2.0)
    period = "DATE '2024-01-05', DATE '2024-01-20'"
    each = [f"SELECT '{m}' AS model, * FROM calculate_utm_attribution({period}, '{m}')" for m in sql_functions.CREDIT_MODELS]
    out = t.spark.sql(" UNION ALL ".join([f"SELECT 'last_click' AS model, * FROM calculate_utm_attribution({period})", *each]))
    return out.withColumns({c: half_up(F.col(c), 4) for c in ("revenue", "orders")})


@query
def sql_channel_rules(t):
    """The channel function of SQL on every order."""
    sql_functions.register_channel_function(t.spark)
    t.orders().createOrReplaceTempView("orders_with_utm")
    return t.spark.sql("""SELECT order_id, rule.* FROM (SELECT order_id,
        get_utm_channel(customer_utm_source, customer_utm_medium, customer_utm_campaign, customer_utm_content) AS rule FROM orders_with_utm)""")


@query
def utm_ads_hourly(t):
    return t.performance()


@query
def utm_ads_full_outer(t):
    return utm.utm_with_ads(t.hourly(), t.ads(), MONTH, keep_ads_only=True)


@query
def utm_daily_summary(t):
    return utm_views.utm_daily_summary(t.performance())


@query
def utm_purchase_analysis(t):
    return utm.hourly_purchase_analysis(t.hourly(), t.ads(), MONTH)


@query
def utm_analysis_by_channel(t):
    return utm.analysis_summaries(utm.hourly_purchase_analysis(t.hourly(), t.ads(), MONTH))["channel"]


@query
def utm_analysis_top_campaigns(t):
    return utm.analysis_summaries(utm.hourly_purchase_analysis(t.hourly(), t.ads(), MONTH))["campaign"]


@query
def utm_analysis_by_hour(t):
    return utm.analysis_summaries(utm.hourly_purchase_analysis(t.hourly(), t.ads(), MONTH))["hour"]


@query
def utm_recent_hours(t):
    return utm_views.recent_hours(t.hourly(), AS_OF)


@query
def utm_recent_hours_with_ads(t):
    return utm_views.recent_hours_with_ads(t.hourly(), t.ads(), AS_OF)


@query
def utm_channel_summary(t):
    return utm_views.channel_summary(t.hourly(), AS_OF)


@query
def utm_top_campaigns(t):
    return utm_views.top_campaigns(t.hourly(), AS_OF)


@query
def utm_hour_pattern(t):
    return utm_views.hour_pattern(t.hourly(), AS_OF)


@query
def utm_source_summary(t):
    return utm_views.source_summary(t.hourly(), AS_OF)


@query
def utm_attribution_by_campaign(t):
    return utm_views.attribution_by_campaign(t.hourly(), AS_OF)


@query
def utm_batch_quality(t):
    hourly = t.hourly().withColumn("created_at", F.col("date_start")).withColumn(
        "batch_id", F.concat(F.lit("batch_"), F.date_format("date_start", "yyyyMMdd"))
    )
    return utm_views.batch_quality(hourly, AS_OF)


@query
def coverage_comparison(t):
    return utm.coverage(t.hourly(), t.ads(), DateWindow(date(2024, 1, 23), AS_OF))


@query
def coverage_comparison_once(t):
    return utm.coverage(t.hourly(), t.ads(), DateWindow(date(2024, 1, 23), AS_OF), fan_out=False)


@query
def period_dashboard(t):
    return utm_views.period_dashboard(t.hourly(), AS_OF)


@query
def utm_campaign_roas(t):
    return utm_views.campaign_roas(t.performance(), AS_OF)


@query
def utm_source_performance(t):
    return utm_views.source_performance(t.performance(), AS_OF)


@query
def utm_conversion_pattern(t):
    return utm_views.conversion_pattern(t.performance(), AS_OF)


@query
def utm_hourly_check(t):
    return utm_views.hourly_check(t.hourly(), AS_OF)


@query
def orphan_mappings(t):
    kept = sinks.retained(t.utm_sessions(), "session_start_time", AS_OF, 10)
    return utm.orphan_mappings(t.utm_mapping(), kept).select("order_id", "session_token", "order_date")


# --- SKU detail ----------------------------------------------------------------------------

@query
def sku_detail(t):
    return t.sku_rows()


@query
def sku_detail_last_line(t):
    return t.sku_rows(last_line=True).select("order_id", "sku", "quantity", "unit_price", "sku_revenue", "sku_cogs", "sku_profit", "ad_spend", "sku_roas")


@query
def hierarchy_rollup(t):
    return sku.hierarchy(sku.ad_sku_performance(t.sku_rows()), ads.ad_totals(t.ads()))


@query
def hierarchy_report(t):
    return sku.hierarchy_report(sku.hierarchy(sku.ad_sku_performance(t.sku_rows()), ads.ad_totals(t.ads()))).select(
        "level", "campaign_name", "adset_name", "ad_name", "sku", "shown_campaign", "shown_adset", "shown_ad", "total_sales"
    )


@query
def sku_campaign_fact(t):
    return t.fact()


@query
def sku_campaign_performance(t):
    return sku.sku_campaign_performance(t.fact())


@query
def campaign_sku_fact_breakdown(t):
    return sku.campaign_sku_breakdown(t.fact())


@query
def product_category_performance(t):
    return sku.category_performance(t.fact())


@query
def sku_performance_detailed(t):
    return sku.sku_detail(t.fact())


@query
def campaign_performance_detailed(t):
    return sku.campaign_detail(t.ad_level())


# --- products --------------------------------------------------------------------------------

@query
def product_match(t):
    rows = products.tag_products(testbed.ad_export(t.spark, t.sf), testbed.product_book(t.spark), "book_order")
    return rows.withColumnsRenamed({"Ad name": "ad_name", "Matched Product": "matched_product", "Price": "price", "Margin": "margin"}).groupBy(
        "ad_name", "matched_product", "price", "margin"
    ).agg(F.count(F.lit(1)).alias("rows"), F.sum("Purchase Value").alias("purchase_value"))


@query
def product_match_by_substring(t):
    names = testbed.ad_export(t.spark, t.sf)
    terms = products.search_terms(testbed.product_book(t.spark), "book_order")
    return products.match_products(names, terms, "Ad name").withColumnRenamed("Ad name", "ad_name")


@query
def product_metrics(t):
    book = testbed.product_book(t.spark)
    tagged = products.tag_products(testbed.ad_export(t.spark, t.sf), book, "book_order")
    rows = tagged.drop("Price", "Margin").withColumnRenamed("Matched Product", "Product")
    return products.product_metrics(rows, book).withColumnsRenamed(
        {
            "Product": "product", "Total Ad Spent (INR)": "total_ad_spent", "Total Sales (Purchases)": "total_sales",
            "Total Revenue (INR)": "total_revenue", "ROAS": "roas", "Price": "price", "Margin": "margin",
            "Expected Revenue (INR)": "expected_revenue", "Revenue Validation": "revenue_validation",
        }
    )


# --- multi-touch -----------------------------------------------------------------------------

@query
def touch_first(t):
    return touch.first_click(*t.touches(), days=7).drop("age_days")


@query
def touch_last(t):
    return touch.last_click(*t.touches(), days=7).drop("age_days")


@query
def live_orders(t):
    """Live attribution over the whole tables, as the stream gives it in the end."""
    out = live_last_click(*t.touches(), days=7)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("order_time", "touch_time")})


def _rounded(df):
    return df.withColumns({c: half_up(F.col(c), 4) for c in ("credited_revenue", "credited_orders")})


@query
def touch_linear(t):
    return _rounded(touch.linear(*t.touches(), days=7))


@query
def touch_decay(t):
    return _rounded(touch.time_decay(*t.touches(), days=7, half_life_days=2.0))


@query
def touch_windows(t):
    return touch.last_click_windows(*t.touches(), by=["campaign_id"])


@query
def touch_credit_by_campaign(t):
    lines = [
        _rounded(touch.credit_by(*t.touches(), by=["campaign_id"], model=m, days=7, half_life_days=2.0)).withColumn("model", F.lit(m))
        for m in touch.MODELS
    ]
    return reduce(DataFrame.unionByName, lines)


# --- platforms ---------------------------------------------------------------------------------

@query
def platform_roles(t):
    return t.platforms().select(
        "order_id", "platform_group", "meta_platform", "google_campaign", "google_ad_group", "google_keyword",
        "meta_campaign", "meta_ad", "meta_adset", "platform_id",
    )


def _platform_view(name, build):
    def view(t):
        return build(t.platforms())

    view.__name__ = name
    query(view)


for _name, _build in {
    "google_campaign_performance": platforms.google_campaigns,
    "google_keyword_performance": platforms.google_keywords,
    "google_ad_group_performance": platforms.google_ad_groups,
    "meta_campaign_performance": platforms.meta_campaigns,
    "meta_adset_performance": platforms.meta_adsets,
    "meta_ad_performance": platforms.meta_ads,
    "platform_comparison": platforms.platform_comparison,
    "source_effectiveness_by_platform": platforms.source_effectiveness,
    "top_google_keywords": platforms.top_keywords,
    "top_meta_ads": platforms.top_meta_ads,
    "meta_platform_totals": platforms.meta_platform_totals,
}.items():
    _platform_view(_name, _build)


# --- quality and monitoring -------------------------------------------------------------------

def _daily_batches(rows):
    return rows.withColumn("batch_id", F.concat(F.lit("batch_"), F.date_format("order_date", "yyyyMMdd")))


@query
def quality_score(t):
    return quality.batch_quality(_daily_batches(t.raw(campaigns=False)))


@query
def quality_validation(t):
    rows = _daily_batches(t.raw(campaigns=False))
    present = quality.validate_batch(rows, "batch_20240115", NOW)
    absent = quality.validate_batch(rows, "batch_20990101", NOW)
    return present.unionByName(absent).withColumn(
        "has_error", F.get_json_object("validation_details", "$.error").isNotNull()
    ).withColumn(
        "accuracy_issues", F.get_json_object("validation_details", "$.accuracy_issues").cast("double")
    ).drop("validation_details")


@query
def pipeline_health(t):
    return quality.pipeline_health(t.log(), NOW, 72)


@query
def quality_alerts(t):
    return quality.quality_alerts(t.log(), NOW, 240)


@query
def run_summary(t):
    return quality.run_summary(t.log())


@query
def pipeline_monitoring(t):
    return quality.monitoring(t.log())


@query
def run_alerts(t):
    return quality.run_alerts(t.log())


@query
def run_states(t):
    log = t.log()
    payload = ["pipeline_run_id", "event_time", "pipeline_name", "execution_status", "total_orders_processed", "attributed_orders_count"]
    starts = log.withColumn("event_time", F.col("execution_start_time")).withColumns(
        {"execution_status": F.lit("RUNNING"), "total_orders_processed": F.lit(0).cast("bigint"), "attributed_orders_count": F.lit(0).cast("bigint")}
    )
    ends = log.where(F.col("execution_end_time").isNotNull()).withColumn("event_time", F.col("execution_end_time") + F.expr("INTERVAL 1 MINUTE"))
    return quality.run_states(starts.select(*payload).unionByName(ends.select(*payload)))


@query
def latest_upsert(t):
    events = testbed.with_ad_keys(t.events())
    bought = F.col("event_type") == "purchase"
    early = hourly_metrics(events.where(~bought))
    late = hourly_metrics(events.where(bought | (F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))))
    return sinks.merge_latest(early, late, ["date_start", "hour_start", "ad_id"]).drop("window_start")


@query
def incremental_last_events(t):
    """The last event of each user and day, loaded in two runs and one backfill of a table that is read by ``ts``."""
    events = testbed.events(t.spark, t.sf).select(
        F.to_date("ts").alias("day"), "user_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").cast("string").alias("event_id"), "event_type"
    )
    path, key = staging_path(t.spark, "last-events"), ["day", "user_id"]
    versions.load_new(events.where("ts < '2024-01-15' AND event_type <> 'error'"), path, key, "day", "ts")
    versions.load_new(events, path, key, "day", "ts")
    versions.backfill(events, path, key, "day", "2024-01-01", "2024-01-15", "ts")
    return versions.read_version(t.spark, path, events.schema).drop("ts")


@query
def rule_seed_insert(t):
    columns = ["utm_source_pattern", "utm_medium_pattern", "utm_campaign_pattern", "channel", "priority"]
    seed = t.spark.createDataFrame(
        [(r[0], r[1], r[2], r[4], r[8]) for r in channels.CHANNEL_RULES],
        "utm_source_pattern string, utm_medium_pattern string, utm_campaign_pattern string, channel string, priority int",
    )
    # Rules proposed from the orders' own sources; those stored already are ignored.
    seen = t.orders().groupBy(F.col("customer_utm_source").alias("s"), F.col("customer_utm_medium").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    proposed = seen.where(F.col("s").isNotNull()).select(
        F.when(F.col("s") == "blog", "referral").otherwise(F.col("s")).alias("utm_source_pattern"),
        F.when(F.col("s") != "blog", F.col("m")).alias("utm_medium_pattern"),
        F.lit(None).cast("string").alias("utm_campaign_pattern"), F.lit("Custom").alias("channel"), F.lit(3).alias("priority"),
    )
    return sinks.insert_or_ignore(seed, proposed).select(*columns)


@query
def constraint_violations(t):
    lines = testbed.line_items(t.spark, t.sf).withColumns(
        {"order_value": F.col("discounted_unit_price_amount"), "order_date": F.lit(AS_OF)}
    )
    checks = {"order_value_positive": "order_value > 0", **quality.ORDER_CHECKS}
    found = quality.violations(lines, "line_items", ["item_id"], checks)
    return found.unionByName(quality.violations(t.ad_level(), "ad_level", ["campaign_id", "adset_id", "ad_id", "analysis_date_start", "analysis_date_end", "batch_id"], quality.AD_LEVEL_CHECKS))


@query
def constraint_report(t):
    """All rules of sessions, mapped orders, UTM hours, runs and channel rules, each table read once."""
    tables = [
        ("event_sessions", sessions.sessionize(t.events(), gap_minutes=240), ["user_id"], quality.SESSION_CHECKS, ["user_id"]),
        ("utm_order_mapping", t.utm_mapping(), ["order_id"], quality.MAPPING_CHECKS, ["campaign_id", "utm_medium"]),
        ("hourly_utm_metrics", t.hourly(), ["date_start", "hour_start", "campaign_id"], quality.HOURLY_CHECKS, ["campaign_id", "ad_id"]),
        ("runs", t.log(), ["batch_id"], quality.RUN_CHECKS, ["execution_end_time", "error_message"]),
        ("channel_rules", rule_seed_insert(t), ["utm_source_pattern"], quality.RULE_CHECKS, ["utm_medium_pattern"]),
    ]
    return reduce(DataFrame.unionByName, [quality.constraint_report(df, name, *rest) for name, df, *rest in tables])


@query
def duplicate_items(t):
    return quality.duplicate_keys(testbed.line_items(t.spark, t.sf), ["item_id"])


@query
def rejected_orders(t):
    orders = t.orders()
    _, bad = quality.quarantine(orders, quality.order_errors(orders))
    return bad.select("order_id", F.array_join("reject_reasons", "; ").alias("reject_reasons"))


@query
def retention_counts(t):
    raw = t.raw(False, False)
    return sinks.retention_counts(
        {"orders": (raw, "order_date", 0), "ads": (t.ads(), "date_start", 0), "runs": (t.log(), "analysis_date_start", 5)}, AS_OF, 10
    )


@query
def audit_sample(t):
    return quality.audit_sample(order_window(t.orders()))


@query
def unreferenced_variants(t):
    return quality.missing_references(
        testbed.line_items(t.spark, t.sf), testbed.variants(t.spark, t.sf).where(F.col("sku").isNotNull()), "variant_id"
    ).groupBy("variant_id").agg(F.count(F.lit(1)).alias("rows"))


# --- sessions and hours ---------------------------------------------------------------------------

@query
def event_sessions(t):
    return sessions.sessionize(t.events(), gap_minutes=240)


@query
def engagement_by_hour(t):
    return sessions.engagement_by_hour(sessions.sessionize(t.events(), gap_minutes=240))


@query
def hourly_window(t):
    return hourly_metrics(testbed.with_ad_keys(t.events()))
