"""KPI rules kept as data: metric values, breach test, violation alerts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpulse.functions.clock import Clock, before, moment
from retailpulse.functions.labels import breaches
from retailpulse.operators.inventory import low_stock

WINDOWED = ("revenue_per_5min", "orders_per_5min", "avg_order_value", "revenue_drop_pct")


def _window_of(rules: DataFrame, metric: str) -> Column:
    picked = rules.filter((F.col("metric_name") == metric) & F.col("enabled"))
    return picked.agg(F.max("window_minutes")).scalar()


def lookback_minutes(rules: DataFrame) -> Column:
    """How far back the metrics of ``rules`` look: two of the longest windows."""
    return rules.filter("enabled").agg(F.max("window_minutes")).scalar() * 2


def _sum_where(condition: Column, column: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0)).cast("double")


def metric_values(
    sales: DataFrame, products: DataFrame, rules: DataFrame, as_of: Clock, names: Iterable[str] | None = None
) -> DataFrame:
    """(metric_name, value) of every known metric, or those in ``names``, from one scan of the minutes.

    The windows come from the rules, so editing a rule changes its window. The
    scan is limited to twice the longest window.
    """
    window = {metric: _window_of(rules, metric) for metric in WINDOWED}
    start = F.col("window_start")
    since = {metric: start >= before(as_of, window[metric]) for metric in WINDOWED}
    drop_since = before(as_of, window["revenue_drop_pct"])
    prior = (start >= before(as_of, window["revenue_drop_pct"] * 2)) & (start < drop_since)
    longest = F.greatest(*window.values())

    in_mean = since["avg_order_value"]
    mean = F.try_divide(
        F.sum(F.when(in_mean, F.col("avg_order_value"))).cast("double"),
        F.count(F.when(in_mean, F.lit(1))).cast("double"),
    )
    sums = sales.filter(start >= before(as_of, longest * 2)).agg(
        _sum_where(since["revenue_per_5min"], "revenue").alias("revenue"),
        _sum_where(since["orders_per_5min"], "order_count").alias("orders"),
        F.coalesce(mean, F.lit(0.0)).alias("mean_value"),
        _sum_where(since["revenue_drop_pct"], "revenue").alias("current"),
        _sum_where(prior, "revenue").alias("prior"),
    )
    drop = F.when(F.col("prior") <= 0, F.lit(0.0)).otherwise(
        F.greatest((F.col("prior") - F.col("current")) / F.col("prior") * 100.0, F.lit(0.0))
    )
    values = {
        "revenue_per_5min": lambda: F.col("revenue"),
        "orders_per_5min": lambda: F.col("orders"),
        "low_stock_count": lambda: low_stock(products).agg(F.count("*").cast("double")).scalar(),
        "avg_order_value": lambda: F.col("mean_value"),
        "revenue_drop_pct": lambda: drop,
    }
    wanted = values if names is None else set(names)
    pairs = [
        F.struct(F.lit(name).alias("metric_name"), value().alias("value"))
        for name, value in values.items() if name in wanted
    ]
    return sums.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")


def judge(values: DataFrame, rules: DataFrame) -> DataFrame:
    """Meet every enabled rule with its metric and pick a severity.

    Metrics without a rule and rules without a metric drop out. A missing
    threshold is skipped; critical is tested before warning.
    """
    met = values.join(rules.filter("enabled"), "metric_name")
    value, operator = F.col("value"), F.col("comparison_operator")

    def hit(name: str) -> Column:
        threshold = F.col(name).cast("double")
        return threshold.isNotNull() & breaches(value, threshold, operator)

    critical, warning = hit("critical_threshold"), hit("warning_threshold")
    return met.withColumns(
        {
            "severity": F.when(critical, "CRITICAL").when(warning, "WARNING"),
            "threshold_used": F.when(critical, F.col("critical_threshold").cast("double"))
            .when(warning, F.col("warning_threshold").cast("double")),
        }
    )


def violation_alerts(judged: DataFrame, as_of: Clock) -> DataFrame:
    """Candidate KPI_VIOLATION alerts of the breached rules."""
    message = F.format_string(
        "KPI %s %s %s: observed %.2f. %s",
        "metric_name",
        "comparison_operator",
        F.col("threshold_used").cast("string"),
        "value",
        F.coalesce("description", F.lit("")),
    )
    return judged.filter(F.col("severity").isNotNull()).select(
        F.lit("KPI_VIOLATION").alias("alert_type"),
        "severity",
        F.lit("KPI").alias("entity_type"),
        F.col("metric_name").alias("entity_id"),
        F.trim(message).alias("message"),
        F.col("value").cast("decimal(14,4)").alias("detected_value"),
        F.lit(None).cast("decimal(14,4)").alias("expected_low"),
        F.col("threshold_used").cast("decimal(14,4)").alias("expected_high"),
        moment(as_of).alias("detected_at"),
        F.lit(False).alias("resolved"),
    )


def minute_metric_values(metrics: DataFrame) -> DataFrame:
    """Long (window_start, metric_name, value) rows of a whole minute series."""
    values = {
        "revenue_per_5min": F.col("revenue").cast("double"),
        "orders_per_5min": F.col("order_count").cast("double"),
        "avg_order_value": F.col("avg_order_value").cast("double"),
        "item_count": F.col("item_count").cast("double"),
    }
    pairs = [F.struct(F.lit(name).alias("metric_name"), value.alias("value")) for name, value in values.items()]
    return metrics.select("window_start", F.explode(F.array(*pairs)).alias("m")).select(
        "window_start", "m.*"
    )
