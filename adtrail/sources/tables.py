"""Reading the source tables, date windows and table profiles."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail import schemas
from adtrail.functions.text import wall_clock


@dataclass(frozen=True)
class DateWindow:
    """An inclusive range of days."""

    start: date
    end: date

    def covers(self, column: str) -> Column:
        return F.col(column).between(F.lit(self.start), F.lit(self.end))


def resolve_window(start=None, end=None, days: int = 30, as_of: date | None = None) -> DateWindow:
    """The given range if both ends are known, else ``days`` back from ``as_of`` (today)."""
    if start and end:
        parse = lambda d: date.fromisoformat(d) if isinstance(d, str) else d
        return DateWindow(parse(start), parse(end))
    last = as_of or date.today()
    return DateWindow(last - timedelta(days=days), last)


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A table of the model from files, with its declared schema."""
    return spark.read.format(fmt).schema(schemas.TABLES[name]).options(**options).load(path)


def read_jdbc(
    spark: SparkSession, name: str, url: str, partition_column: str | None = None,
    lower=None, upper=None, partitions: int = 64, **options,
) -> DataFrame:
    """A table from a database; connection options come from the caller only.

    With ``partition_column`` the read is split into ranges, so no single task
    pulls the whole table. Filters, projections and aggregates are pushed down.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    reader = reader.option("pushDownAggregate", "true")
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower)).option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def read_product_book(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PRODUCT_BOOK).option("header", True).option("quote", '"').csv(path)


def read_ad_export(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.AD_EXPORT).option("header", True).option("quote", '"').csv(path)


def order_window(orders: DataFrame, window: DateWindow | None = None) -> DataFrame:
    """Orders of the window that were not cancelled, with the IST wall clock as ``order_ts``.

    ``order_date`` is a stored column where tables are partitioned by it, so the
    window prunes folders; it is derived only where missing.
    """
    if "order_date" not in orders.columns:
        orders = orders.withColumn("order_date", F.to_date(wall_clock("created_at_ist")))
    kept = orders.where(F.col("cancelled_at_ist").isNull())
    if window:
        kept = kept.where(window.covers("order_date"))
    return kept.withColumn("order_ts", wall_clock("created_at_ist"))


def ads_window(ads: DataFrame, window: DateWindow | None = None) -> DataFrame:
    return ads.where(window.covers("date_start")) if window else ads


def wide_orders(orders: DataFrame, line_items: DataFrame, variants: DataFrame, window: DateWindow | None = None) -> DataFrame:
    """Orders with their line items and variants, one row per line item (left joins)."""
    variants = variants.withColumnRenamed("product_title", "variant_product_title")
    lines = line_items.withColumnRenamed("title", "product_title").join(variants, "variant_id", "left")
    return order_window(orders, window).join(lines, "order_id", "left")


def orders_with_skus(orders, line_items, variants, window: DateWindow | None = None) -> DataFrame:
    """The narrow order + SKU scan used by the SKU-to-ad mapping."""
    lines = line_items.select(
        "order_id", "item_id", F.col("title").alias("product_title"), "quantity",
        "original_unit_price_amount", "discounted_unit_price_amount", "variant_id",
    ).join(variants.select("variant_id", "sku", "variant_title", "unit_cost_amount", "vendor"), "variant_id", "left")
    slim = order_window(orders, window).select(
        "order_id", "order_name", "order_date", F.col("total_price_amount").alias("order_value"),
        F.col("total_price_currency").alias("order_currency"),
        *[f"customer_utm_{f}" for f in ("source", "medium", "campaign", "content", "term")],
        "customer_journey", "custom_attributes",
    )
    return slim.join(lines, "order_id", "left")


def utm_orders(orders: DataFrame, window: DateWindow | None = None) -> DataFrame:
    """Orders that carry a UTM source or medium of their own."""
    return order_window(orders, window).where(
        F.col("customer_utm_source").isNotNull() | F.col("customer_utm_medium").isNotNull()
    )


def newest_active(parameters: DataFrame) -> DataFrame:
    """The parameter row in force: active, created last."""
    return parameters.where("is_active").orderBy(F.col("created_at").desc()).limit(1)


def profile(tables: dict[str, tuple[DataFrame, str]], window: DateWindow) -> DataFrame:
    """Rows, first and last day and rows in the window, one line per table.

    ``tables`` maps a name to (frame, date column).
    """
    lines = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(day).alias("min_date"),
            F.max(day).alias("max_date"),
            F.count_if(window.covers(day)).alias("rows_in_window"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, (df, day) in tables.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def missing_tables(spark: SparkSession, required=tuple(schemas.TABLES)) -> list[str]:
    """Names among ``required`` that the catalog does not hold."""
    return [name for name in required if not spark.catalog.tableExists(name)]


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of the wanted columns that the frame has, in the wanted order."""
    return df.select(*[c for c in columns if c in df.columns])
