"""Line items folded to one row per order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.functions.measures import safe_div, total, unit_price
from adtrail.functions.text import non_empty


def priced_lines(line_items: DataFrame, variants: DataFrame) -> DataFrame:
    """Line items with SKU, unit price, unit cost, revenue, cogs and profit.

    Missing quantities, prices and costs count as 0, an empty SKU as missing.
    """
    product = variants.select("variant_id", "sku", "variant_title", "unit_cost_amount")
    price = unit_price("discounted_unit_price_amount", "original_unit_price_amount")
    return (
        line_items.join(product, "variant_id", "left")
        .select(
            "order_id", "item_id", non_empty("sku").alias("sku"),
            F.col("title").alias("product_title"), "variant_title",
            F.coalesce("quantity", F.lit(0)).alias("quantity"),
            price.alias("unit_price"),
            F.coalesce("unit_cost_amount", F.lit(0).cast("decimal(10,2)")).alias("unit_cost"),
        )
        .withColumns(line_money())
    )


def line_money() -> dict[str, Column]:
    revenue = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")
    cogs = (F.col("quantity") * F.col("unit_cost")).cast("decimal(18,2)")
    return {
        "line_item_revenue": revenue,
        "line_item_cogs": cogs,
        "line_item_profit": revenue - cogs,
    }


def with_margin(df: DataFrame, profit: str, revenue: str, out: str) -> DataFrame:
    return df.withColumn(out, safe_div(profit, revenue, 100))


def fold_lines(lines: DataFrame) -> DataFrame:
    """Per order: cogs, line count, SKU list, SKU count, quantity of SKU-bearing lines.

    Sums and the SKU set are folded on the map side; the set is bounded by the
    product catalogue, however many lines an order has.
    """
    with_sku = F.col("sku").isNotNull()
    return (
        lines.groupBy("order_id")
        .agg(
            total("line_item_cogs").alias("total_cogs"),
            F.count(F.lit(1)).alias("line_items_count"),
            F.collect_set("sku").alias("_skus"),
            F.coalesce(F.sum(F.when(with_sku, F.col("quantity"))), F.lit(0)).alias("total_sku_quantity"),
        )
        .select(
            "order_id", "total_cogs", "line_items_count",
            non_empty(F.array_join(F.sort_array("_skus"), ", ")).alias("skus"),
            F.size("_skus").cast("bigint").alias("unique_skus_count"),
            "total_sku_quantity",
        )
    )


def with_line_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders with folded lines; an order without items counts one empty line."""
    return orders.join(fold_lines(lines), "order_id", "left").withColumns(
        {
            "total_cogs": F.coalesce("total_cogs", F.lit(0).cast("decimal(18,2)")),
            "line_items_count": F.coalesce("line_items_count", F.lit(1)),
            "unique_skus_count": F.coalesce("unique_skus_count", F.lit(0)),
            "total_sku_quantity": F.coalesce("total_sku_quantity", F.lit(0)),
        }
    )
