"""Minute aggregates of orders and items, and series statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailpulse.functions.clock import Clock, before
from retailpulse.functions.numbers import exact_mean, round_half_up


def average_order_value(revenue: str = "revenue", orders: str = "order_count"):
    return F.try_divide(F.col(revenue), F.col(orders)).cast("decimal(10,2)")


def minute_sales(orders: DataFrame, window: str = "1 minute", by: Sequence[str] = ()) -> DataFrame:
    """Revenue, orders, units and average order value per event-time minute (and ``by``)."""
    sums = orders.groupBy(*by, F.window("order_timestamp", window).alias("w")).agg(
        F.sum("total_amount").cast("decimal(14,2)").alias("revenue"),
        F.count("*").alias("order_count"),
        F.sum("item_count").alias("item_count"),
    )
    return sums.select(
        *by,
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "revenue",
        "order_count",
        "item_count",
        average_order_value().alias("avg_order_value"),
    )


def recent_minute_sales(orders: DataFrame, as_of: Clock, n_minutes: int | Column) -> DataFrame:
    """Minute sales of the last ``n`` minutes straight from the orders.

    A minute that starts inside the range has all its orders inside it, so the
    orders are filtered by time first and only recent files are read.
    """
    start = before(as_of, n_minutes)
    recent = orders.filter(F.col("order_timestamp") >= start)
    return minute_sales(recent).filter(F.col("window_start") >= start)


def product_minute_sales(items: DataFrame, window: str = "1 minute") -> DataFrame:
    """Units and revenue per event-time minute and product.

    ``items`` are exploded order lines that carry the order's timestamp.
    """
    sums = items.groupBy(F.window("order_timestamp", window).alias("w"), "product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum(F.col("unit_price") * F.col("quantity")).cast("decimal(12,2)").alias("revenue"),
    )
    return sums.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "product_id",
        "units_sold",
        "revenue",
    )


def units_by_product(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(F.sum("quantity").alias("qty"))


def throughput(orders: DataFrame, time_column: str = "order_timestamp") -> DataFrame:
    """Orders per minute over the span of the table, at least one minute."""
    span = orders.agg(
        F.count("*").alias("orders"),
        F.min(time_column).alias("first_at"),
        F.max(time_column).alias("last_at"),
    )
    elapsed = (F.unix_micros("last_at") - F.unix_micros("first_at")) / F.lit(60e6)
    return span.select(
        "orders",
        round_half_up(F.col("orders") / F.greatest(elapsed, F.lit(1.0)), 2).alias("rate_per_minute"),
    )


def series_stats(metrics: DataFrame, *by: str | Column) -> DataFrame:
    """Mean, population deviation and median of the minute revenue per group."""
    revenue = F.col("revenue").cast("double")
    return metrics.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        exact_mean(F.col("revenue")).alias("mean_revenue"),
        F.stddev_pop(revenue).alias("std_revenue"),
        F.median(revenue).alias("median_revenue"),
    )


def _lag_ms(event_time: str, arrival: str) -> Column:
    return F.unix_millis(arrival) - F.unix_millis(event_time)


def ingestion_lag(events: DataFrame, event_time: str, arrival: str, *by: str | Column) -> DataFrame:
    """Arrival minus event time in milliseconds: mean, maximum, 95th percentile.

    The percentile is the smallest lag that at least 95 % of the group's lags do not
    exceed, from the exact counts of its distinct lags. Rows whose lag is null count as
    events alone.
    """
    counts = events.groupBy(*by, _lag_ms(event_time, arrival).alias("_lag")).agg(F.count("*").alias("_n"))
    names = [f"`{c}`" for c in counts.columns[:-2]]
    known = F.when(F.col("_lag").isNotNull(), F.col("_n"))
    group = Window.partitionBy(*names)
    ordered = group.orderBy("_lag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumns({"_upto": F.sum(known).over(ordered), "_all": F.sum(known).over(group)})
    total = F.sum(F.col("_lag").cast("decimal(20,0)") * known.cast("decimal(18,0)"))
    return ranked.groupBy(*names).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_events"),
        F.try_divide(total.cast("double"), F.sum(known).cast("double")).alias("avg_lag_ms"),
        F.max("_lag").alias("max_lag_ms"),
        F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * 95, F.col("_lag"))).alias("p95_lag_ms"),
    )


def ingestion_lag_estimate(events: DataFrame, event_time: str, arrival: str, *by: str | Column) -> DataFrame:
    """``ingestion_lag`` in one aggregation of bounded state, for streams: the percentile's rank is off by at most 1/10,000."""
    lag = _lag_ms(event_time, arrival)
    return events.groupBy(*by).agg(
        F.count("*").alias("n_events"),
        F.avg(lag).alias("avg_lag_ms"),
        F.max(lag).alias("max_lag_ms"),
        F.percentile_approx(lag, 0.95).alias("p95_lag_ms"),
    )
