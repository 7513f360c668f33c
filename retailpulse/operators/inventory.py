"""Stock: decrements, the movement log, low-stock alerts, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpulse.functions.clock import Clock, moment
from retailpulse.functions.labels import is_low_stock, low_stock_severity, stock_bin, stock_health
from retailpulse.operators.metrics import units_by_product
from retailpulse.operators.series import running_sum
from retailpulse.operators.shape import trailing


def apply_sales(products: DataFrame, items: DataFrame) -> DataFrame:
    """Products with the sold units taken off, never below zero."""
    sold = F.coalesce("qty", F.lit(0))
    stock = F.greatest(F.lit(0), F.col("stock_quantity") - sold).cast("int")
    return (
        products.join(units_by_product(items), "product_id", "left")
        .withColumn("stock_quantity", stock)
        .select(*products.columns)
    )


def restock_movements(catalog: DataFrame, sold: DataFrame, levels: DataFrame) -> DataFrame:
    """(product_id, quantity): what to count as sold besides ``sold`` so that the stock becomes that of ``levels``.

    ``sold`` (product_id, quantity) holds all movements so far, ``levels`` (product_id,
    stock_quantity) the new stock, the largest if a product occurs twice. Products
    that the catalog lacks are left out.
    """
    wanted = levels.groupBy("product_id").agg(F.max("stock_quantity").alias("wanted"))
    moved = sold.groupBy("product_id").agg(F.sum("quantity").alias("moved"))
    known = catalog.select("product_id", "stock_quantity").join(wanted, "product_id").join(moved, "product_id", "left")
    quantity = F.col("stock_quantity") - F.col("wanted") - F.coalesce("moved", F.lit(0))
    return known.select("product_id", quantity.cast("bigint").alias("quantity"))


def stock_after_movements(products: DataFrame, sales: DataFrame, restocks: DataFrame) -> DataFrame:
    """Products with the stock left after sales and restocks in order of event time, never below zero.

    ``sales`` (product_id, quantity, order_timestamp), ``restocks`` (product_id,
    stock_quantity, restocked_at): a product has the level of its last restock, of
    several at once the largest, less the units sold later than it.
    """
    last = restocks.filter(F.col("restocked_at").isNotNull()).groupBy("product_id").agg(F.max(F.struct("restocked_at", "stock_quantity")).alias("last"))
    after = sales.filter(F.col("order_timestamp").isNotNull()).join(last, "product_id", "left").filter(
        F.col("last").isNull() | (F.col("order_timestamp") > F.col("last.restocked_at"))
    )
    level = F.coalesce("last.stock_quantity", "stock_quantity").cast(products.schema["stock_quantity"].dataType)
    levels = products.join(last, "product_id", "left").withColumn("stock_quantity", level).select(*products.columns)
    return apply_sales(levels, after)


def sale_movements(products: DataFrame, items: DataFrame, at: Clock | None = None) -> DataFrame:
    """Inventory log rows of one batch of sold items."""
    stock = F.greatest(F.lit(0), F.col("stock_quantity") - F.col("qty")).cast("int")
    log = units_by_product(items).join(
        products.select("product_id", "stock_quantity"), "product_id"
    ).select(
        "product_id",
        F.lit("SALE").alias("change_type"),
        (-F.col("qty")).alias("quantity_change"),
        stock.alias("stock_after"),
    )
    return log if at is None else log.withColumn("event_timestamp", moment(at))


def unknown_products(products: DataFrame, items: DataFrame) -> DataFrame:
    """Sold products the catalog does not know, with the units concerned."""
    return units_by_product(items).join(products.select("product_id"), "product_id", "left_anti")


def low_stock(products: DataFrame) -> DataFrame:
    return products.filter(is_low_stock(F.col("stock_quantity"), F.col("reorder_threshold")))


def low_stock_alerts(products: DataFrame, as_of: Clock) -> DataFrame:
    """Candidate LOW_STOCK alerts over the whole catalog."""
    stock, threshold = F.col("stock_quantity"), F.col("reorder_threshold")
    return low_stock(products).select(
        F.lit("LOW_STOCK").alias("alert_type"),
        low_stock_severity(stock, threshold).alias("severity"),
        F.lit("PRODUCT").alias("entity_type"),
        F.col("product_id").cast("string").alias("entity_id"),
        F.concat(
            F.lit("Low stock: "), "name", F.lit(" ("), stock, F.lit(" <= "), threshold, F.lit(")")
        ).alias("message"),
        stock.cast("decimal(14,4)").alias("detected_value"),
        F.lit(0).cast("decimal(14,4)").alias("expected_low"),
        threshold.cast("decimal(14,4)").alias("expected_high"),
        moment(as_of).alias("detected_at"),
        F.lit(False).alias("resolved"),
    )


def running_stock(products: DataFrame, sales: DataFrame, time: str, tie: str) -> DataFrame:
    """Stock left after each sale, in order of time and ``tie``."""
    sold = running_sum(sales, ["product_id"], time, tie, "quantity", "units_so_far")
    start = products.select("product_id", F.col("stock_quantity").alias("opening_stock"))
    left = F.greatest(F.lit(0), F.col("opening_stock") - F.col("units_so_far"))
    return sold.join(start, "product_id").withColumn("stock_after", left)


def reorder_suggestions(products: DataFrame) -> DataFrame:
    suggested = F.col("reorder_threshold") * 3 - F.col("stock_quantity")
    return low_stock(products).select(
        "product_id", "name", "stock_quantity", "reorder_threshold",
        suggested.alias("suggested_order_qty"),
    )


def stock_matrix(products: DataFrame) -> DataFrame:
    """Stock and threshold per category and product with subtotals."""
    levels = products.rollup("category", "product_id").agg(
        F.sum("stock_quantity").alias("stock_quantity"),
        F.sum("reorder_threshold").alias("reorder_threshold"),
        F.grouping_id().alias("level"),
    )
    # An icon needs one selected product; subtotals have none.
    icon = F.when(
        F.col("level") == 0, stock_health(F.col("stock_quantity"), F.col("reorder_threshold"))
    )
    return levels.withColumn("stock_icon", icon)


def stock_histogram(products: DataFrame) -> DataFrame:
    return products.groupBy(
        stock_bin(F.col("stock_quantity"), F.col("reorder_threshold")).alias("stock_bin")
    ).agg(F.count("*").alias("products"))


def depletion_velocity(product_metrics: DataFrame, as_of: Clock, n_minutes: int | Column = 60) -> DataFrame:
    """Units per product over the last hour, fastest first."""
    return (
        trailing(product_metrics, "window_start", as_of, n_minutes)
        .groupBy("product_id")
        .agg(F.sum("units_sold").alias("units_sold"))
        .orderBy(F.desc("units_sold"), "product_id")
    )
