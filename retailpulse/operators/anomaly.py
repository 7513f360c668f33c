"""Revenue-spike detection: trailing z-score and isolation forest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from retailpulse.config import AnomalyParams
from retailpulse.functions.clock import Clock, moment
from retailpulse.functions.numbers import exact_mean
from retailpulse.operators.forest import forest_scores
from retailpulse.operators.shape import trailing

DEFAULT = AnomalyParams()


def zscore_by_frame(metrics: DataFrame, frame: list[str], params: AnomalyParams = DEFAULT) -> DataFrame:
    """Latest minute of each frame against the frame's other minutes.

    A frame is a bounded stretch of one series (30 minutes, 24 hours), so it
    has at most one row per minute of that stretch.
    """
    revenue = F.col("revenue").cast("double")
    newest = F.max("window_start").over(W.partitionBy(*frame))
    earlier = F.col("window_start") < F.col("_newest")
    stats = (
        metrics.withColumn("_newest", newest)
        .groupBy(*frame)
        .agg(
            F.count("*").alias("n_rows"),
            F.max("_newest").alias("window_start"),
            F.max(F.when(F.col("window_start") == F.col("_newest"), revenue)).alias("revenue"),
            exact_mean(F.when(earlier, F.col("revenue"))).alias("mean_revenue"),
            F.stddev_pop(F.when(earlier, revenue)).alias("std_revenue"),
        )
    )
    usable = (F.col("n_rows") >= params.zscore_min_rows) & (F.col("std_revenue") > 0)
    z = F.when(usable, (F.col("revenue") - F.col("mean_revenue")) / F.col("std_revenue"))
    return stats.withColumn("z", z).withColumn(
        "severity",
        F.when(F.col("z") >= params.z_critical, "CRITICAL").when(F.col("z") >= params.z_high, "HIGH"),
    )


def _bounds(mean: str, std: str, width: float) -> dict:
    return {
        "expected_low": F.greatest(F.lit(0.0), F.col(mean) - F.lit(width) * F.col(std)),
        "expected_high": F.col(mean) + F.lit(width) * F.col(std),
    }


def zscore_spikes(judged: DataFrame) -> DataFrame:
    """Spikes of a z-score frame with bounds and the method's wording."""
    method = F.format_string("z-score z=%.2f", "z")
    return judged.filter(F.col("severity").isNotNull()).withColumns(
        {**_bounds("mean_revenue", "std_revenue", 3.0), "method": method}
    )


def forest_by_frame(metrics: DataFrame, frame: list[str], params: AnomalyParams = DEFAULT) -> DataFrame:
    """Isolation-forest verdict on the latest minute of each frame, and how many minutes it finds odd."""
    scored = forest_scores(metrics, frame, ["revenue", "order_count"], "window_start", params)
    revenue = F.col("revenue").cast("double")
    latest = F.max_by(F.struct("window_start", revenue.alias("revenue"), "decision"), "window_start")
    stats = scored.groupBy(*frame).agg(
        F.count("*").alias("n_rows"),
        latest.alias("_latest"),
        F.avg(revenue).alias("mean_revenue"),
        F.stddev_pop(revenue).alias("std_revenue"),
        F.median(revenue).alias("median_revenue"),
        F.count_if(F.col("decision") < 0).alias("n_outliers"),
    ).select(*frame, "n_rows", "_latest.*", "mean_revenue", "std_revenue", "median_revenue", "n_outliers")
    spike = (
        (F.col("n_rows") >= params.forest_min_rows)
        & (F.col("decision") < 0)
        & (F.col("revenue") > F.col("median_revenue"))
    )
    severity = F.when(spike & (F.col("decision") < params.critical_score), "CRITICAL").when(spike, "HIGH")
    return stats.withColumn("severity", severity)


def forest_spikes(judged: DataFrame) -> DataFrame:
    method = F.format_string("isolation_forest score=%.3f", "decision")
    return judged.filter(F.col("severity").isNotNull()).withColumns(
        {**_bounds("mean_revenue", "std_revenue", 2.0), "method": method}
    )


def method_by_frame(metrics: DataFrame, frame: list[str], params: AnomalyParams = DEFAULT) -> DataFrame:
    """Which detector each frame gets: too young for the forest means z-score."""
    rows = metrics.groupBy(*frame).agg(F.count("*").alias("n_rows"))
    return rows.withColumn("method", method_for(F.col("n_rows"), params))


def method_for(n_rows: Column, params: AnomalyParams = DEFAULT) -> Column:
    return (
        F.when(n_rows >= params.forest_min_rows, "isolation_forest")
        .when(n_rows >= params.zscore_min_rows, "zscore")
        .otherwise("none")
    )


def detect(
    metrics: DataFrame, as_of: Clock, frame: list[str] | None = None, params: AnomalyParams = DEFAULT
) -> DataFrame:
    """Spikes at ``as_of`` by the configured method.

    The forest method looks at 24 hours and leaves frames with too few rows to
    the z-score on the same frame.
    """
    frame = frame or []
    if params.method not in ("zscore", "isolation_forest"):
        raise ValueError(f"unknown detection method: {params.method}")
    zscore_only = params.method == "zscore"
    span = params.zscore_minutes if zscore_only else params.forest_minutes
    shown = trailing(metrics, "window_start", as_of, span)
    if not frame:
        shown, frame = shown.withColumn("series", F.lit("all")), ["series"]
    columns = [*frame, "window_start", "revenue", "severity", "expected_low", "expected_high", "method"]
    by_zscore = zscore_spikes(zscore_by_frame(shown, frame, params)).select(*columns, "n_rows")
    if zscore_only:
        return by_zscore.drop("n_rows")
    cold = by_zscore.filter(F.col("n_rows") < params.forest_min_rows).drop("n_rows")
    return cold.unionByName(forest_spikes(forest_by_frame(shown, frame, params)).select(*columns))


def spike_alerts(spikes: DataFrame, as_of: Clock) -> DataFrame:
    """Candidate REVENUE_SPIKE alert rows."""
    at = F.col("window_start").cast("string")
    message = F.format_string(
        "Revenue spike via %s: $%.2f at %s (expected $%.2f-$%.2f)",
        "method", "revenue", at, "expected_low", "expected_high",
    )
    return spikes.select(
        F.lit("REVENUE_SPIKE").alias("alert_type"),
        "severity",
        F.lit("WINDOW").alias("entity_type"),
        at.alias("entity_id"),
        message.alias("message"),
        F.col("revenue").cast("decimal(14,4)").alias("detected_value"),
        F.col("expected_low").cast("decimal(14,4)").alias("expected_low"),
        F.col("expected_high").cast("decimal(14,4)").alias("expected_high"),
        moment(as_of).alias("detected_at"),
        F.lit(False).alias("resolved"),
    )
