"""The same aggregates as stateful streaming queries.

Unlike the batch-wise ingest these keep their state in the query and drop
orders older than the watermark. Use `update` mode for live figures and
`append` mode for final ones. Sums combine map-side before the shuffle, so a
best-selling product or a busy minute is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.operators.metrics import ingestion_lag_estimate, minute_sales, product_minute_sales
from retailpulse.operators.shape import order_lines


def deduplicated(orders: DataFrame) -> DataFrame:
    """Drops repeated order ids for as long as the watermark remembers them."""
    return orders.dropDuplicatesWithinWatermark(["order_id"])


def minute_sales_stream(orders: DataFrame, window: str = "1 minute") -> DataFrame:
    return minute_sales(orders, window)


def product_minute_stream(orders: DataFrame, window: str = "1 minute") -> DataFrame:
    return product_minute_sales(order_lines(orders, "order_timestamp"), window)


def stock_stream(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Stock per sold product, carried as the running sum of its units.

    Taking sales off one by one and stopping at zero leaves the same stock as
    taking off their sum, so the state is a plain aggregate.
    """
    sold = order_lines(orders).groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
    left = F.greatest(F.lit(0), F.col("stock_quantity") - F.col("units_sold"))
    return sold.join(products.select("product_id", "stock_quantity"), "product_id").select(
        "product_id", "units_sold", left.alias("stock_after")
    )


def lag_stream(orders: DataFrame, window: str = "1 minute") -> DataFrame:
    """Arrival lag per event-time minute; its percentile is an estimate."""
    return ingestion_lag_estimate(
        orders, "order_timestamp", "arrived_at", F.window("order_timestamp", window).alias("w")
    )
