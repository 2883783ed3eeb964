"""Google and Meta read the UTM fields differently; reports per platform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.functions.channels import platform_of
from adtrail.functions.measures import mean, ratio, share

# Which hierarchy level each platform's content and term name, and the order in
# which its ids are tried.
ROLES = {
    "Google": {"utm_campaign": "campaign", "utm_content": "ad_group", "utm_term": "keyword"},
    "Meta": {"utm_campaign": "campaign", "utm_content": "ad", "utm_term": "adset"},
}
ID_PRIORITY = {
    "Google": ["ad_group", "campaign", "keyword"],
    "Meta": ["ad", "campaign", "adset"],
}


def with_platform(attributed: DataFrame) -> DataFrame:
    """Add platform, Facebook/Instagram split, hierarchy roles and the platform id."""
    source = F.lower("utm_source")
    rows = attributed.withColumn("platform_group", platform_of(source, F.lower("utm_medium")))
    google, meta = F.col("platform_group") == "Google", F.col("platform_group") == "Meta"
    columns = {}
    for name, is_platform in (("Google", google), ("Meta", meta)):
        for utm, role in ROLES[name].items():
            columns[f"{name.lower()}_{role}"] = F.when(is_platform, F.col(utm))
    instagram = source.contains("instagram") | (source == "ig")
    columns["meta_platform"] = F.when(meta, F.when(instagram, "Instagram").otherwise("Facebook"))
    rows = rows.withColumns(columns)
    picks = [
        F.when(is_platform, F.coalesce(*[F.nullif(F.col(f"{name.lower()}_{role}"), F.lit("")) for role in ID_PRIORITY[name]]))
        for name, is_platform in (("Google", google), ("Meta", meta))
    ]
    return rows.withColumn("platform_id", F.coalesce(*picks))


def _measures():
    return [
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("order_value").alias("total_revenue"),
        mean("order_value").alias("avg_order_value"),
        F.count_if("is_attributed").alias("attributed_orders"),
        share(F.col("is_attributed")).alias("attribution_rate"),
    ]


def _report(rows: DataFrame, platform: str | None, by: list[str], *extra) -> DataFrame:
    chosen = rows.where(F.col("platform_group") == platform) if platform else rows
    return chosen.groupBy(*by).agg(*_measures(), *extra).orderBy(F.col("total_revenue").desc(), *by)


def google_campaigns(rows: DataFrame) -> DataFrame:
    return _report(
        rows, "Google", ["google_campaign"],
        F.countDistinct("google_ad_group").alias("unique_ad_groups"),
        F.countDistinct("google_keyword").alias("unique_keywords"),
    )


def google_keywords(rows: DataFrame) -> DataFrame:
    return _report(rows, "Google", ["google_campaign", "google_ad_group", "google_keyword"])


def google_ad_groups(rows: DataFrame) -> DataFrame:
    return _report(
        rows, "Google", ["google_campaign", "google_ad_group"],
        F.countDistinct("google_keyword").alias("unique_keywords"),
    )


def meta_campaigns(rows: DataFrame) -> DataFrame:
    return _report(
        rows, "Meta", ["meta_campaign", "meta_platform"],
        F.countDistinct("meta_adset").alias("unique_adsets"),
        F.countDistinct("meta_ad").alias("unique_ads"),
    )


def meta_adsets(rows: DataFrame) -> DataFrame:
    return _report(
        rows, "Meta", ["meta_campaign", "meta_adset", "meta_platform"], F.countDistinct("meta_ad").alias("unique_ads")
    )


def meta_ads(rows: DataFrame) -> DataFrame:
    return _report(rows, "Meta", ["meta_campaign", "meta_adset", "meta_ad", "meta_platform"])


def platform_comparison(rows: DataFrame) -> DataFrame:
    return _report(rows, None, ["platform_group"])


def source_effectiveness(rows: DataFrame) -> DataFrame:
    return _report(rows, None, ["platform_group", "attribution_source"]).orderBy(
        "platform_group", F.col("total_revenue").desc(), "attribution_source"
    )


def top_keywords(rows: DataFrame, k: int = 10) -> DataFrame:
    """Best Google keywords by revenue; the mean order value is over keyword rows."""
    return (
        google_keywords(rows).groupBy("google_campaign", "google_keyword")
        .agg(
            F.sum("total_orders").alias("orders"),
            F.sum("total_revenue").alias("revenue"),
            mean("avg_order_value").alias("aov"),
        )
        .orderBy(F.col("revenue").desc(), "google_campaign", "google_keyword").limit(k)
    )


def top_meta_ads(rows: DataFrame, k: int = 10) -> DataFrame:
    return (
        meta_ads(rows).groupBy("meta_campaign", "meta_ad", "meta_platform")
        .agg(F.sum("total_orders").alias("orders"), F.sum("total_revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "meta_campaign", "meta_ad", "meta_platform").limit(k)
    )


def meta_platform_totals(rows: DataFrame) -> DataFrame:
    return (
        meta_campaigns(rows).groupBy("meta_platform")
        .agg(
            F.sum("total_orders").alias("orders"),
            F.sum("total_revenue").alias("revenue"),
            ratio(F.sum("total_revenue"), F.sum("total_orders")).alias("aov"),
        )
        .orderBy(F.col("revenue").desc(), "meta_platform")
    )
