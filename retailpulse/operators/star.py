"""Star-schema reports over orders, order items and products.

Items are summed per product (or order) before they meet a dimension, so a
best-selling product or a giant order shrinks to one row ahead of the join.
Join strategies are left to Catalyst, which knows the sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpulse.functions.labels import stock_health, stock_row_color


def product_totals(items: DataFrame, *by: str | Column) -> DataFrame:
    return items.groupBy("product_id", *by).agg(
        F.sum("quantity").alias("units_sold"),
        F.sum(F.col("quantity") * F.col("unit_price")).cast("decimal(38,2)").alias("line_revenue"),
    )


def enrich_items(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with their order's header and their product's attributes."""
    return items.join(orders, "order_id").join(products, "product_id")


def top_sellers(items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with most units; ties go to the lower id."""
    best = (
        items.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
        .join(products.select("product_id", "name"), "product_id")
        .orderBy(F.desc("units_sold"), "product_id")
        .limit(n)
    )
    return best.select("product_id", "name", "units_sold")


def revenue_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    return (
        product_totals(items)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("units_sold").alias("units_sold"), F.sum("line_revenue").alias("line_revenue"))
    )


def category_share(items: DataFrame, products: DataFrame, unit: str = "hour") -> DataFrame:
    """Line revenue per time bin and category with its share of the bin."""
    binned = product_totals(items, F.date_trunc(unit, "order_timestamp").alias("bin"))
    cells = (
        binned.join(products.select("product_id", "category"), "product_id")
        .groupBy("bin", "category")
        .agg(F.sum("line_revenue").alias("line_revenue"))
    )
    totals = cells.groupBy("bin").agg(F.sum("line_revenue").alias("bin_revenue"))
    share = F.try_divide(F.col("line_revenue").cast("double"), F.col("bin_revenue").cast("double"))
    return cells.join(totals, "bin").withColumn("share", share)


def product_detail(products: DataFrame, items: DataFrame) -> DataFrame:
    stock, threshold = F.col("stock_quantity"), F.col("reorder_threshold")
    return products.join(product_totals(items), "product_id", "left").select(
        "product_id", "name", "category", "price", "units_sold", "line_revenue", "stock_quantity",
        stock_health(stock, threshold).alias("stock_icon"),
        stock_row_color(stock, threshold).alias("row_color"),
    )
