"""Ordered computations over time series without one-task partitions.

A plain window over one key (or none) sorts that key's whole history in one
task. These helpers cut the time axis into blocks first, so a hot key or a
single global series is spread over many tasks and only small block totals are
ordered per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from retailpulse.functions.clock import epoch_seconds
from retailpulse.functions.numbers import exact_mean

DAY = 86_400
# Rows of one instant are cut by ranges of this many ids.
TIE_RANGE = 1_000_000


def trailing_window(
    df: DataFrame,
    keys: list[str],
    time: str,
    span_seconds: int,
    include_current: bool,
    aggregates: dict[str, Column],
    block_seconds: int = DAY,
) -> DataFrame:
    """Aggregates over the ``span_seconds`` up to each row.

    Every row is also copied, as history only, into the later blocks its span
    reaches; each block is then an independent partition of the window.
    """
    at = epoch_seconds(time)
    own = F.floor(at / block_seconds)
    reach = F.floor((at + span_seconds) / block_seconds)
    spread = df.withColumns({"_t": at, "_own": own}).withColumn(
        "_block", F.explode(F.sequence(own, reach))
    )
    frame = W.partitionBy(*keys, "_block").orderBy("_t").rangeBetween(
        -span_seconds, 0 if include_current else -1
    )
    named = {name: aggregate.over(frame) for name, aggregate in aggregates.items()}
    return spread.withColumns(named).filter("_block = _own").drop("_t", "_own", "_block")


def _blocks(df: DataFrame, time: str, tie: str) -> DataFrame:
    """Rows with the block (`_minute`, `_at`, `_slice`) they belong to.

    A block is one instant of one key, cut further by ranges of ``tie``; blocks are
    consecutive in the order of ``time`` then ``tie``. Whatever the size of the data,
    no busy key and no pile of rows with one timestamp lands in a single task, as
    long as ``tie`` is a number that tells the rows apart.
    """
    part = F.floor(F.col(tie) / TIE_RANGE)
    return df.withColumns({"_minute": F.date_trunc("minute", time), "_at": F.col(time), "_slice": part})


def running_sum(
    df: DataFrame, keys: list[str], time: str, tie: str, value: str, out: str
) -> DataFrame:
    """Sum of ``value`` up to each row, ordered by ``time`` then ``tie``.

    Rows are summed inside their block. What came before it is added from the block
    totals of the same minute and the minute totals, of which a key has at most half
    a million a year.
    """
    block = [*keys, "_minute", "_at", "_slice"]
    rows = _blocks(df, time, tie)
    zero = F.lit(0)
    totals = rows.groupBy(*block).agg(F.sum(value).alias("_sum"))
    in_minute = W.partitionBy(*keys, "_minute").orderBy("_at", "_slice").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(*block, F.coalesce(F.sum("_sum").over(in_minute), zero).alias("_within"))
    minutes = df.groupBy(*keys, F.date_trunc("minute", time).alias("_minute")).agg(F.sum(value).alias("_sum"))
    earlier = W.partitionBy(*keys).orderBy("_minute").rowsBetween(W.unboundedPreceding, -1)
    minutes = minutes.select(*keys, "_minute", F.coalesce(F.sum("_sum").over(earlier), zero).alias("_before"))
    inside = W.partitionBy(*block).orderBy(tie).rowsBetween(W.unboundedPreceding, 0)
    return (
        rows.withColumn("_inside", F.sum(value).over(inside))
        .join(totals.join(minutes, [*keys, "_minute"]), block)
        .withColumn(out, F.col("_before") + F.col("_within") + F.col("_inside"))
        .drop("_minute", "_at", "_slice", "_inside", "_within", "_before")
    )


def previous_value(
    df: DataFrame, keys: list[str], time: str, tie: str, value: str, out: str
) -> DataFrame:
    """``value`` of the preceding row of the same key, by ``time`` then ``tie``.

    The first row of a block takes the last value of the block before in its minute,
    the first block of a minute that of the key's minute before.
    """
    block = [*keys, "_minute", "_at", "_slice"]
    rows = _blocks(df, time, tie)
    last = F.max_by(F.struct(F.col(value).alias("v")), F.struct(time, tie))
    closing = rows.groupBy(*block).agg(last.alias("_closing"))
    in_minute = W.partitionBy(*keys, "_minute").orderBy("_at", "_slice")
    closing = closing.select(*block, F.lag("_closing").over(in_minute).alias("_within"))
    minutes = df.groupBy(*keys, F.date_trunc("minute", time).alias("_minute")).agg(last.alias("_closing"))
    minutes = minutes.select(*keys, "_minute", F.lag("_closing").over(W.partitionBy(*keys).orderBy("_minute")).alias("_before"))
    inside = W.partitionBy(*block).orderBy(tie)
    carried = F.coalesce("_within", "_before")["v"]
    return (
        rows.withColumns({"_prev": F.lag(value).over(inside), "_n": F.row_number().over(inside)})
        .join(closing.join(minutes, [*keys, "_minute"]), block)
        .withColumn(out, F.when(F.col("_n") == 1, carried).otherwise(F.col("_prev")))
        .drop("_minute", "_at", "_slice", "_prev", "_n", "_within", "_before")
    )


def trailing_zscore(metrics: DataFrame, keys: list[str], n_minutes: int = 30) -> DataFrame:
    """The spike test replayed at the end of every minute of a series."""
    revenue = F.col("revenue").cast("double")
    stats = trailing_window(
        metrics,
        keys,
        "window_start",
        (n_minutes - 1) * 60,
        False,
        {
            "n_history": F.count("*"),
            "sum_revenue": F.sum("revenue"),
            "std_revenue": F.stddev_pop(revenue),
        },
    )
    mean = F.try_divide(F.col("sum_revenue").cast("double"), F.col("n_history").cast("double"))
    stats = stats.withColumn("mean_revenue", mean).drop("sum_revenue")
    z = F.when(
        (F.col("n_history") >= 4) & (F.col("std_revenue") > 0),
        (revenue - F.col("mean_revenue")) / F.col("std_revenue"),
    )
    return stats.withColumn("z", z)


def rolling_sales(metrics: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Revenue and orders of the last 5 minutes and hour along the series."""
    keys = keys or []
    wanted = {"5m": 240, "1h": 3540}
    for label, span in wanted.items():
        metrics = trailing_window(
            metrics,
            keys,
            "window_start",
            span,
            True,
            {
                f"revenue_{label}": F.sum("revenue"),
                f"orders_{label}": F.sum("order_count"),
            },
        )
    return metrics


def window_over_window(metrics: DataFrame, n_minutes: int, keys: list[str] | None = None) -> DataFrame:
    """Revenue of each aligned ``n``-minute bin next to the bin before it.

    Each bin contributes its revenue to itself and, as prior revenue, to its
    successor, which replaces a lag over a gap-filled calendar. Bins in which
    both are absent are not listed.
    """
    keys = keys or []
    width = n_minutes * 60
    start = F.floor(epoch_seconds("window_start") / width) * width
    bins = metrics.groupBy(*keys, start.alias("_bin")).agg(F.sum("revenue").alias("revenue"))
    role = F.explode(F.array(F.lit(0), F.lit(1))).alias("_role")
    both = (
        bins.select(*keys, "_bin", "revenue", role)
        .groupBy(*keys, F.timestamp_seconds(F.col("_bin") + F.col("_role") * width).alias("bin_start"))
        .agg(
            F.coalesce(F.sum(F.when(F.col("_role") == 0, F.col("revenue"))), F.lit(0)).alias("revenue"),
            F.coalesce(F.sum(F.when(F.col("_role") == 1, F.col("revenue"))), F.lit(0)).alias("prior_revenue"),
        )
    )
    drop = (F.col("prior_revenue") - F.col("revenue")).cast("double") / F.col("prior_revenue").cast("double") * 100
    return both.withColumn(
        "drop_pct",
        F.when(F.col("prior_revenue") <= 0, F.lit(0.0)).otherwise(F.greatest(drop, F.lit(0.0))),
    )


def latest_row(df: DataFrame, time: str, columns: list[str], *by: str) -> DataFrame:
    """The row with the greatest ``time``, per group or overall."""
    newest = F.max_by(F.struct(*columns), time).alias("_row")
    return df.groupBy(*by).agg(newest).select(*by, "_row.*")


def with_reference_lines(points: DataFrame, value: str = "revenue") -> DataFrame:
    """Average, minimum and maximum of the shown range beside every point."""
    def over_all(aggregate: Column) -> Column:
        return points.agg(aggregate).scalar()

    return points.withColumns(
        {
            f"avg_{value}": over_all(exact_mean(F.col(value))),
            f"min_{value}": over_all(F.min(value)),
            f"max_{value}": over_all(F.max(value)),
        }
    )
