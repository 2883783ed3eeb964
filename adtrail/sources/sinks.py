"""Writers: exports, tagged appends, upsert, insert-or-ignore, retention."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.sources.tables import select_existing

RAW_EXPORT = [
    "order_id", "order_name", "order_date", "price", "cogs", "sku",
    "campaign_name", "adset_name", "ad_name", "channel", "attribution_source",
]
GRANULAR_EXPORT = [
    "campaign_name", "adset_name", "ad_name", "date_start", "hour_label", "channel",
    "spend", "cpm", "cpc", "ctr", "action_onsite_web_purchase", "value_onsite_web_purchase",
    "shopify_orders", "shopify_revenue", "shopify_cogs", "total_sku_quantity",
    "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term",
    "order_ids", "attribution_source",
]
ORDER_TABLE = [
    "order_id", "order_name", "order_date", "order_value", "order_currency",
    "total_cogs", "line_items_count", "skus", "unique_skus_count",
    "total_sku_quantity", "channel", "attribution_source", "attribution_id",
    "attribution_type", "utm_source", "utm_medium", "utm_campaign",
    "utm_content", "utm_term", "campaign_id", "campaign_name",
    "adset_id", "adset_name", "ad_id", "ad_name", "is_attributed",
    "is_paid_channel", "has_customer_journey", "has_custom_attributes",
    "ship_city", "ship_province", "ship_country", "batch_id",
]
AD_LEVEL_TABLE = [
    "campaign_id", "campaign_name", "adset_id", "adset_name", "ad_id", "ad_name",
    "channel", "attributed", "orders", "attributed_orders", "total_sales",
    "total_cogs", "net_profit", "impressions", "clicks", "spend", "roas",
    "ctr", "conversion_rate", "avg_order_value", "profit_margin",
    "all_skus", "total_unique_skus", "total_sku_quantity",
    "analysis_date_start", "analysis_date_end", "batch_id",
]
HOURLY_KEY = [
    "date_start", "hour_start", "campaign_id", "ad_id",
    "utm_source", "utm_medium", "utm_campaign", "batch_id",
]
RULE_KEY = ["utm_source_pattern", "utm_medium_pattern", "utm_campaign_pattern", "priority"]


def raw_export(attributed: DataFrame) -> DataFrame:
    renamed = attributed.withColumnsRenamed({"order_value": "price", "total_cogs": "cogs", "skus": "sku"})
    return select_existing(renamed, RAW_EXPORT)


def granular_export(granular: DataFrame) -> DataFrame:
    return select_existing(granular, GRANULAR_EXPORT)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, by: str, mode: str = "overwrite") -> None:
    """One folder per value of ``by``; adaptive execution sizes the files, so a large value has many writers.

    ``mode`` overwrite replaces the folders of the values that ``df`` holds and
    leaves the others, so a run that is repeated stores its rows once.
    """
    df.hint("rebalance", by).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def tag_orders(attributed: DataFrame, batch_id: str) -> DataFrame:
    """Order-level rows as stored, tagged with the run's batch."""
    return select_existing(attributed.withColumn("batch_id", F.lit(batch_id)), ORDER_TABLE)


def tag_ads(ad_level: DataFrame, batch_id: str, start: date, end: date) -> DataFrame:
    """Ad-level rows as stored, tagged with batch and analysis range."""
    tagged = (
        ad_level.withColumn("batch_id", F.lit(batch_id))
        .withColumn("analysis_date_start", F.lit(start))
        .withColumn("analysis_date_end", F.lit(end))
    )
    return select_existing(tagged, AD_LEVEL_TABLE)


def latest_per_key(versions: DataFrame, key: list[str], version: Column) -> DataFrame:
    """The row of each key with the highest ``version`` (null keys count as equal).

    A max over structs folds versions before the shuffle, so a key written a
    million times costs one row per task, not one sorted group.
    """
    payload = [c for c in versions.columns if c not in key]
    return (
        versions.groupBy(*key)
        .agg(F.max(F.struct(version.alias("_version"), F.struct(*payload).alias("_row"))).alias("_top"))
        .select(*key, "_top._row.*")
        .select(*versions.columns)
    )


def merge_latest(stored: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Stored rows with incoming ones put over them on equal keys."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(
        incoming.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(both, key, F.col("_new")).drop("_new")


def upsert_partitions(spark: SparkSession, incoming: DataFrame, path: str, key: list[str], by: str = "date_start") -> None:
    """Upsert into a folder table: only the ``by`` partitions met are rewritten.

    Plain Parquet has no MERGE. New content is written to a staging folder next
    to the table first and then moved in by a dynamic partition overwrite, so
    the job never reads the files it replaces; running it again gives the same.
    """
    staging = f"{path.rstrip('/')}__staging"
    try:
        stored = spark.read.parquet(path)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        merged = latest_per_key(incoming.withColumn("_new", F.lit(1)), key, F.col("_new")).drop("_new")
    else:
        touched = incoming.select(by).distinct()
        merged = merge_latest(stored.join(touched, by, "left_semi"), incoming, key)
    merged.write.mode("overwrite").partitionBy(by).parquet(staging)
    (
        spark.read.schema(merged.schema).parquet(staging)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    )


def insert_or_ignore(stored: DataFrame, incoming: DataFrame, key: list[str] = RULE_KEY) -> DataFrame:
    """Incoming rows whose key is not stored yet (null equals null)."""
    same = None
    for c in key:
        match = stored[c].eqNullSafe(incoming[c])
        same = match if same is None else same & match
    return incoming.join(stored, same, "left_anti")


def retained(df: DataFrame, created: str, as_of: date, days: int = 90) -> DataFrame:
    return df.where(F.col(created) >= F.lit(as_of - timedelta(days=days)))


def retention_counts(tables: dict[str, tuple[DataFrame, str, int]], as_of: date, days: int = 90) -> DataFrame:
    """Rows kept and dropped per table; the third item adds days (logs stay 30 longer)."""
    lines = []
    for name, (df, created, extra) in tables.items():
        old = F.col(created) < F.lit(as_of - timedelta(days=days + extra))
        lines.append(
            df.agg(F.count_if(old).alias("rows_deleted"), F.count_if(~old).alias("rows_kept"))
            .select(F.lit(name).alias("table_name"), "*")
        )
    return reduce(DataFrame.unionByName, lines)


def drop_expired_partitions(spark: SparkSession, path: str, by: str, as_of: date, days: int = 90) -> list[date]:
    """Delete whole day folders older than the retention; returns the days removed."""
    cutoff = as_of - timedelta(days=days)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(conf)
    removed = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{by}=") and name[len(by) + 1:][:4].isdigit():
            day = date.fromisoformat(name[len(by) + 1:])
            if day < cutoff:
                files.delete(status.getPath(), True)
                removed.append(day)
    return sorted(removed)
