"""Products recognised in ad names, and product metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.functions.measures import price_check, safe_div
from adtrail.functions.text import SPACES

NO_PRODUCT = "Brand Awareness"


def search_terms(book: DataFrame, order: str) -> DataFrame:
    """(term, product, product_order) of a product book; ``order`` ranks the products.

    Terms are the trimmed, lower-case parts of the comma list; empty ones are
    skipped. A term of two products belongs to the one listed first.
    """
    parts = F.explode(F.split("Search", ","))
    return (
        book.where(F.col("Search").isNotNull())
        .select(F.col(order).alias("product_order"), F.col("Product").alias("product"), parts.alias("part"))
        .withColumn("term", F.lower(F.btrim("part", F.lit(SPACES))))
        .where(F.col("term") != "")
        .groupBy("term")
        .agg(F.min(F.struct("product_order", "product")).alias("p"))
        .select("term", F.col("p.product_order").alias("product_order"), F.col("p.product").alias("product"))
    )


def match_products(names: DataFrame, terms: DataFrame, name: str) -> DataFrame:
    """(name, product) for every distinct ad name: first listed product with a term inside it.

    Every name is cut into its substrings of the lengths terms have; a term is
    inside the name exactly when it equals one of them. Work grows with name
    length times the number of term lengths, not with names times terms, and
    the lengths are read inside the plan.
    """
    lengths = terms.agg(F.collect_set(F.length("term"))).scalar()  # no more than the longest term has characters
    distinct = names.select(name).distinct().withColumn("_lengths", lengths)
    low = F.lower(F.coalesce(name, F.lit("")))

    def cut(size):
        starts = F.sequence(F.lit(1), F.length(low) - (size - 1))
        pieces = F.transform(starts, lambda start: F.substring(low, start, size))
        return F.when(F.length(low) >= size, pieces).otherwise(F.array().cast("array<string>"))

    cuts = F.flatten(F.transform("_lengths", cut))
    pieces = distinct.select(name, F.explode(F.array_distinct(cuts)).alias("term"))
    best = (
        pieces.join(terms, "term")
        .groupBy(name)
        .agg(F.min(F.struct("product_order", "product")).alias("p"))
        .select(F.col(name).alias("_name"), F.col("p.product").alias("product"))
    )
    return distinct.join(best, F.col(name) == F.col("_name"), "left").select(
        name, F.coalesce("product", F.lit(NO_PRODUCT)).alias("product")
    )


def tag_products(ads: DataFrame, book: DataFrame, order: str, name: str = "Ad name") -> DataFrame:
    """Ad rows with the matched product, its price and margin."""
    matched = match_products(ads, search_terms(book, order), name)
    prices = book.groupBy("Product").agg(
        F.min(F.struct(order, "Price", "Margin")).alias("_p")
    ).select("Product", F.col("_p.Price").alias("Price"), F.col("_p.Margin").alias("Margin"))
    tags = matched.join(prices, matched["product"] == prices["Product"], "left").select(
        F.col(name).alias("_name"), matched["product"].alias("Matched Product"), "Price", "Margin"
    )
    return ads.join(tags, ads[name].eqNullSafe(F.col("_name")), "left").drop("_name")


def product_metrics(ads: DataFrame, book: DataFrame) -> DataFrame:
    """Spend, purchases, revenue, ROAS and the price check per product."""
    stats = ads.where(F.col("Product").isNotNull()).groupBy("Product").agg(
        F.sum("Amount spent (INR)").alias("Total Ad Spent (INR)"),
        F.sum("Purchases").alias("Total Sales (Purchases)"),
        F.sum("Purchase Value").alias("Total Revenue (INR)"),
    )
    prices = book.select("Product", "Price", "Margin")
    return (
        stats.withColumn("ROAS", safe_div("Total Revenue (INR)", "Total Ad Spent (INR)"))
        .join(prices, "Product", "left")
        .withColumn("Expected Revenue (INR)", F.col("Price") * F.col("Total Sales (Purchases)"))
        .withColumn(
            "Revenue Validation",
            price_check("Total Revenue (INR)", "Price", "Total Sales (Purchases)"),
        )
    )
