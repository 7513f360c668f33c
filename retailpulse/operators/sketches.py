"""Figures that do not add up, from sketches that do: distinct counts and quantiles per minute, merged for any span.

A minute keeps a HyperLogLog sketch of its order ids and a KLL sketch of its arrival
lags, a few kilobytes whatever the number of orders. Merged sketches of minutes are
sketches of the hour or day, so no order is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the registers of a distinct count: one standard error is 1.04 / sqrt(4096) = 1.6 %.
LG_REGISTERS = 12
DISTINCT_ERROR = 1.04 / 2 ** (LG_REGISTERS / 2)
#: Size of a quantile sketch: the rank of an answer is off by at most 1.65 % (99 times in 100).
QUANTILE_K = 200
RANK_ERROR = 0.0165

WINDOW = ["window_start", "window_end"]


def order_sketches(orders: DataFrame, event_time: str, arrival: str, window: str | Column = "1 minute") -> DataFrame:
    """(window_start, window_end, orders, lags): sketches per event-time window.

    Rows without an order id count for the lags alone, rows without an arrival for the
    orders alone, rows without an event time for nothing.
    """
    span = F.window(event_time, window) if isinstance(window, str) else window
    lag = F.unix_millis(arrival) - F.unix_millis(event_time)
    return orders.groupBy(span.alias("w")).agg(
        F.hll_sketch_agg("order_id", LG_REGISTERS).alias("orders"), F.kll_sketch_agg_bigint(lag, QUANTILE_K).alias("lags")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "orders", "lags")


def merged(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """The sketches of each group of ``by``; merging is order-free, so groups may be merged again."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("orders").alias("orders"), F.kll_merge_agg_bigint("lags").alias("lags"))


def order_count() -> Column:
    """Distinct orders of a sketch, within about 1.6 % (one standard error)."""
    return F.hll_sketch_estimate("orders")


def lag_quantiles(*shares: float) -> list[Column]:
    """Columns p50_lag_ms, p95_lag_ms, ...: values whose rank is within ``RANK_ERROR`` of the share; null without a lag."""
    some = F.kll_sketch_get_n_bigint("lags") > 0
    return [F.when(some, F.kll_sketch_get_quantile_bigint("lags", F.lit(s))).alias(f"p{round(s * 100)}_lag_ms") for s in shares]


def lag_summary(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """Orders and lag quantiles per group of ``by``, from minutes."""
    found = merged(sketches, *by)
    groups = [c for c in found.columns if c not in ("orders", "lags")]
    return found.select(
        *groups, order_count().alias("order_count"), F.kll_sketch_get_n_bigint("lags").alias("n_events"), *lag_quantiles(0.5, 0.95, 0.99)
    )
