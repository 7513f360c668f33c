"""Alert rows: one schema, cooldown against history, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpulse.functions.clock import Clock, before, moment
from retailpulse.functions.labels import severity_color
from retailpulse.operators.series import previous_value
from retailpulse.schemas import ALERT

# Which columns identify "the same alert" for each producer.
LOW_STOCK_KEY = ["alert_type", "entity_id"]
KPI_KEY = ["alert_type", "entity_id", "severity"]
SPIKE_KEY = ["alert_type", "entity_id"]

ALERT_TYPES = ["KPI_VIOLATION", "LOW_STOCK", "REVENUE_SPIKE"]


def suppress_recent(
    candidates: DataFrame, history: DataFrame, keys: list[str], as_of: Clock, minutes: int
) -> DataFrame:
    """Candidates without an alert of the same key inside the cooldown."""
    recent = history.filter(F.col("detected_at") > before(as_of, minutes)).select(*keys).distinct()
    return candidates.join(recent, keys, "left_anti")


def unify(*producers: DataFrame) -> DataFrame:
    """Alert frames of several producers in the one alert schema."""
    columns = [
        [F.col(f.name).cast(f.dataType).alias(f.name) for f in ALERT.fields] for _ in producers
    ]
    return reduce(DataFrame.unionByName, [df.select(*c) for df, c in zip(producers, columns)])


def with_alert_id(alerts: DataFrame, *named: Column) -> DataFrame:
    """Alerts with ``alert_id``: a hash of what names their origin and of their content.

    The same alert of the same origin gets the same id again, so ids survive a repeated run.
    """
    content = [F.col(f.name).cast(f.dataType) for f in ALERT.fields if f.name != "resolved"]
    return alerts.withColumn("alert_id", F.xxhash64(*named, *content))


def open_alerts(alerts: DataFrame, at: Clock, chosen: Column | None = None) -> DataFrame:
    """(alert_id, resolved_at, part) that resolve the open alerts, or those ``chosen``; part is the alert's day."""
    rows = unresolved(alerts) if chosen is None else unresolved(alerts).filter(chosen)
    return rows.select("alert_id", moment(at).alias("resolved_at"), F.date_format("detected_at", "yyyy-MM-dd").alias("part"))


def fold_resolutions(alerts: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Alerts as they stand: ``resolved`` if raised so or resolved since, and ``resolved_at``, the first time.

    An alert resolved twice is resolved once; resolutions of unknown alerts change nothing.
    """
    first = resolutions.groupBy("alert_id").agg(F.min("resolved_at").alias("resolved_at"))
    others = [c for c in alerts.columns if c != "resolved_at"]
    return alerts.select(*others).join(first, "alert_id", "left").select(
        *[c if c != "resolved" else (F.col("resolved") | F.col("resolved_at").isNotNull()).alias(c) for c in others], "resolved_at"
    )


def unresolved(alerts: DataFrame, severity: str | None = None, kind: str | None = None) -> DataFrame:
    alerts = alerts.filter(~F.col("resolved"))
    if severity is not None:
        alerts = alerts.filter(F.col("severity") == severity)
    if kind is not None:
        alerts = alerts.filter(F.col("alert_type") == kind)
    return alerts


def alert_feed(alerts: DataFrame, limit: int = 15) -> DataFrame:
    """The newest open alerts with their row colour."""
    newest = unresolved(alerts).orderBy(F.desc("detected_at"), F.desc("alert_id")).limit(limit)
    return newest.select(
        "alert_id", "detected_at", "severity", "alert_type", "entity_id", "message",
        severity_color(F.col("severity")).alias("color"),
    )


def alert_log(alerts: DataFrame, kind: str | None = None) -> DataFrame:
    if kind is not None:
        alerts = alerts.filter(F.col("alert_type") == kind)
    return alerts.withColumn("color", severity_color(F.col("severity"))).orderBy(F.desc("detected_at"))


def alerts_by_hour(alerts: DataFrame) -> DataFrame:
    """Alerts per hour, one column per alert type."""
    return (
        alerts.groupBy(F.date_trunc("hour", "detected_at").alias("hour"))
        .pivot("alert_type", ALERT_TYPES)
        .count()
        .na.fill(0)
    )


def severity_distribution(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severity").agg(F.count("*").alias("alerts"))


def value_change(alerts: DataFrame) -> DataFrame:
    """Change of the detected value against the entity's previous alert."""
    seen = previous_value(
        alerts, ["alert_type", "entity_id"], "detected_at", "alert_id", "detected_value", "previous_value"
    )
    return seen.withColumn("change", F.col("detected_value") - F.col("previous_value"))


def violations_by_rule_and_hour(rules: DataFrame, alerts: DataFrame) -> DataFrame:
    """Violations per rule and hour of day; rules without any are kept.

    Counted before the join, so only one row per rule and hour is shuffled.
    """
    hits = (
        alerts.filter(F.col("alert_type") == "KPI_VIOLATION")
        .groupBy(F.col("entity_id").alias("metric_name"), F.hour("detected_at").alias("hour"))
        .count()
    )
    return (
        rules.select("metric_name")
        .join(hits, "metric_name", "left")
        .groupBy("metric_name")
        .pivot("hour", list(range(24)))
        .sum("count")
        .na.fill(0)
    )


def spike_overlay(metrics: DataFrame, alerts: DataFrame) -> DataFrame:
    """Minute revenue with the number of spike alerts raised for the minute."""
    spikes = (
        alerts.filter(F.col("alert_type") == "REVENUE_SPIKE")
        .groupBy(F.col("entity_id").alias("_minute"))
        .agg(F.count("*").alias("spike_alerts"), F.max("detected_value").alias("spike_value"))
    )
    points = metrics.select("window_start", "revenue", F.col("window_start").cast("string").alias("_minute"))
    return points.join(spikes, "_minute", "left").drop("_minute").na.fill(0, ["spike_alerts"])
