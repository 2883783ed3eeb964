"""End-to-end runs: attribution, SKU mapping, UTM."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtrail.functions.text import wall_clock
from adtrail.operators import ads as ad_ops
from adtrail.operators import granular, mapping, quality, reports, utm
from adtrail.operators.adlevel import ad_level_summary
from adtrail.operators.attribution import attribute
from adtrail.plans import mapping_views, utm_views, warehouse
from adtrail.sources import sinks
from adtrail.sources.tables import DateWindow, ads_window


@dataclass(frozen=True)
class Store:
    """The four source tables."""

    orders: DataFrame
    line_items: DataFrame
    variants: DataFrame
    ads: DataFrame


def attribution_run(store: Store, window: DateWindow, out: str, batch_id: str) -> dict[str, DataFrame]:
    """Attribute the window's orders, store them, and derive every report from what was stored.

    Orders without an id, value or readable time are stored apart, with their
    reasons. The attributed orders are written once, by day, and read back, and
    so are the hourly and ad-level tables: reports share that one computation,
    a lost executor never redoes it, and a repeated run replaces its batch.
    """
    spark = store.orders.sparkSession

    def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        path = f"{out}/{name}/batch_id={batch_id}"
        if by:
            df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(by).parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    good, bad = quality.quarantine(store.orders, quality.unusable_order(store.orders))
    bad = bad.withColumn("order_date", F.to_date(wall_clock("created_at_ist")))
    rejected = stored(bad.where(F.col("order_date").isNull() | window.covers("order_date")), "rejected_orders")
    attributed = stored(attribute(good, store.line_items, store.variants, store.ads, window), "attribution_raw", "order_date")
    tagged_orders = stored(sinks.tag_orders(attributed, batch_id).drop("batch_id"), "attribution_orders", "order_date")
    ads = ads_window(store.ads, window)
    daily = ad_ops.daily_ads(ads)
    hours = granular.granular_insights(attributed, ads, order_ids=True)
    hours = stored(sinks.granular_export(hours), "granular", "date_start")
    ad_level = ad_level_summary(attributed, daily)
    tagged = stored(sinks.tag_ads(ad_level, batch_id, window.start, window.end).drop("batch_id"), "ad_level").withColumn("batch_id", F.lit(batch_id))
    register(ORDER_VIEWS, attributed)
    funnel = lambda rows: warehouse.attribution_funnel(rows, warehouse.campaign_totals(daily))
    register({"v_attribution_funnel_analysis": funnel}, attributed)
    register(AD_LEVEL_VIEWS, tagged)
    return {
        "rejected": rejected,
        "attributed": attributed,
        "orders": tagged_orders,
        "granular": hours,
        "ad_level": tagged,
        "channel_breakdown": reports.channel_breakdown(attributed),
        "source_breakdown": reports.source_breakdown(attributed),
        "campaign_performance": reports.campaign_performance(attributed, daily),
        "grand_totals": reports.grand_totals(attributed),
        "batch_metrics": reports.batch_metrics(attributed, tagged),
    }


def mapping_run(store: Store, window: DateWindow, out: str) -> DataFrame:
    """Map sold SKUs to ads, store them by day (days met are replaced), and register the ten views over the result."""
    rows = mapping.order_ad_mapping(store.orders, store.line_items, store.variants, store.ads, window)
    sinks.write_partitioned(rows, f"{out}/order_ad_mapping", "order_date")
    stored = store.orders.sparkSession.read.schema(rows.schema).parquet(f"{out}/order_ad_mapping")
    register(MAPPING_VIEWS, stored)
    return stored


def utm_run(store: Store, window: DateWindow, out: str, batch_id: str) -> dict[str, DataFrame]:
    """Sessions, order mapping and hourly metrics, stored by day; then the purchase analysis over what was stored."""
    spark = store.orders.sparkSession

    def stored(df: DataFrame, name: str, time: str) -> DataFrame:
        sinks.write_partitioned(df.withColumn("day", F.to_date(time)), f"{out}/{name}", "day")
        rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("day", T.DateType())])).parquet(f"{out}/{name}")
        return rows.where(window.covers("day")).drop("day")

    sessions = stored(utm.utm_sessions(store.orders, window), "utm_sessions", "session_start_time")
    mapped = stored(utm.utm_order_mapping(store.orders, window, batch_id), "utm_order_mapping", "order_date")
    hourly = utm.hourly_utm_metrics(mapped, sessions, batch_id)
    path = f"{out}/utm_hourly_metrics"
    sinks.upsert_partitions(spark, hourly, path, sinks.HOURLY_KEY)
    metrics = spark.read.schema(hourly.schema).parquet(path)
    performance = utm_views.utm_ad_hourly_performance(utm.newest_batch(metrics), store.ads, window.end, (window.end - window.start).days)
    register({"v_utm_ad_hourly_performance": lambda rows: rows, **UTM_VIEWS}, performance)
    analysis = utm.hourly_purchase_analysis(utm.newest_batch(metrics), store.ads, window)
    return {"sessions": sessions, "mapping": mapped, "hourly": metrics, "analysis": analysis, **utm.analysis_summaries(analysis)}


ORDER_VIEWS = {
    "v_daily_attribution_summary": warehouse.daily_attribution_summary,
    "v_channel_performance": warehouse.channel_performance,
    "v_campaign_performance": warehouse.campaign_performance,
    "v_attribution_source_analysis": warehouse.attribution_source_analysis,
    "v_sku_performance": warehouse.sku_performance,
    "v_monthly_attribution_trends": warehouse.monthly_attribution_trends,
    "v_attribution_quality_analysis": warehouse.attribution_quality_analysis,
    "v_top_performing_campaigns": warehouse.top_performing_campaigns,
    "v_geographic_attribution_analysis": warehouse.geographic_analysis,
    "v_attribution_daily_summary": warehouse.attribution_daily_summary,
}
AD_LEVEL_VIEWS = {
    "v_campaign_performance_summary": warehouse.campaign_performance_summary,
    "v_ad_performance_summary": warehouse.ad_performance_summary,
    "v_channel_performance_summary": warehouse.channel_performance_summary,
}
MAPPING_VIEWS = {
    "v_sku_ad_performance": mapping_views.sku_ad_performance,
    "v_ad_sku_performance": mapping_views.ad_sku_performance,
    "v_daily_order_ad_performance": mapping_views.daily_order_ad_performance,
    "v_campaign_sku_breakdown": mapping_views.campaign_sku_breakdown,
    "v_top_performing_skus": mapping_views.top_performing_skus,
    "v_top_performing_ads": mapping_views.top_performing_ads,
    "v_sku_ad_efficiency": mapping_views.sku_ad_efficiency,
    "v_campaign_sku_matrix": mapping_views.campaign_sku_matrix,
    "v_daily_sku_performance": mapping_views.daily_sku_performance,
    "v_daily_ad_performance": mapping_views.daily_ad_performance,
}
UTM_VIEWS = {"v_utm_daily_summary": utm_views.utm_daily_summary}


MONITORING_VIEWS = {"v_pipeline_monitoring": quality.monitoring}  # over the run log


def register(views: dict, base: DataFrame) -> None:
    """Make views available to spark.sql under their names."""
    for name, build in views.items():
        build(base).createOrReplaceTempView(name)


def write_views(views: dict, base: DataFrame, out: str) -> None:
    """Store view results as Parquet, the lasting form of a view refresh."""
    for name, build in views.items():
        build(base).write.mode("overwrite").parquet(f"{out}/{name}")


def load_store(spark: SparkSession, folder: str) -> Store:
    from adtrail.sources.tables import read_table

    names = ["shopify_orders", "shopify_order_line_items", "shopify_product_variants", "ads_insights_hourly"]
    return Store(*[read_table(spark, n, f"{folder}/{n}") for n in names])
