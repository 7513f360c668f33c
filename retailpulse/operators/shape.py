"""Shaping of order events: headers, lines, documents, simple filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpulse.functions.clock import Clock, before, moment
from retailpulse.functions.labels import popularity_tier

HEADER = ("order_id", "customer_id", "order_timestamp", "total_amount", "item_count")

# Width of the catalog's text columns.
WIDTHS = {"name": 490, "category": 78, "image_url": 495, "description": 2000}


def order_headers(orders: DataFrame, *keep: str) -> DataFrame:
    return orders.select(*HEADER, F.coalesce("status", F.lit("CREATED")).alias("status"), *keep)


def order_lines(orders: DataFrame, *keep: str) -> DataFrame:
    """One row per item; orders without items give none."""
    item = orders.select("order_id", *keep, F.explode("items").alias("item"))
    return item.select(
        "order_id", *keep, "item.product_id", "item.quantity", "item.unit_price"
    )


def with_line_total(lines: DataFrame) -> DataFrame:
    total = (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)")
    return lines.withColumn("line_total", total)


def trailing(df: DataFrame, column: str, as_of: Clock, n_minutes: int | Column) -> DataFrame:
    """Rows of the last ``n`` minutes: inclusive start, no upper bound."""
    return df.filter(F.col(column) >= before(as_of, n_minutes))


def fit_widths(catalog: DataFrame) -> DataFrame:
    """Cut text columns to their stored width; a missing text becomes ''."""
    cut = {
        name: F.coalesce(F.substring(name, 1, width), F.lit(""))
        for name, width in WIDTHS.items()
        if name in catalog.columns
    }
    return catalog.withColumns(cut)


def slice_sales(
    sales: DataFrame,
    start: Clock | None = None,
    end: Clock | None = None,
    categories: list[str] | None = None,
    tier: str | None = None,
) -> DataFrame:
    """Dashboard slicers: date range [start, end), category, popularity tier."""
    if start is not None:
        sales = sales.filter(F.col("order_timestamp") >= moment(start))
    if end is not None:
        sales = sales.filter(F.col("order_timestamp") < moment(end))
    if categories is not None:
        sales = sales.filter(F.col("category").isin(categories))
    if tier is not None:
        sales = sales.filter(popularity_tier(F.col("popularity_weight")) == tier)
    return sales


def order_totals(lines: DataFrame) -> DataFrame:
    """Amount, units and number of lines per order (map-side combined)."""
    return with_line_total(lines).groupBy("order_id").agg(
        F.sum("line_total").cast("decimal(12,2)").alias("total_amount"),
        F.sum("quantity").cast("int").alias("item_count"),
        F.count("*").alias("n_lines"),
    )


def nest_orders(lines: DataFrame, item_columns: list[str]) -> DataFrame:
    """One document per order, with its totals and an ``items`` array; one scan, one shuffle.

    A document holds all lines of its order, so its size is that of the order.
    """
    item = F.struct(*item_columns, "line_total")
    return with_line_total(lines).groupBy("order_id").agg(
        F.sum("line_total").cast("decimal(12,2)").alias("total_amount"),
        F.sum("quantity").cast("int").alias("item_count"),
        F.sort_array(F.collect_list(item)).alias("items"),
    )


def resolve_alerts(alerts: DataFrame) -> DataFrame:
    """All alerts marked resolved; ``changed`` tells which rows were open."""
    return alerts.withColumn("changed", ~F.col("resolved")).withColumn("resolved", F.lit(True))
