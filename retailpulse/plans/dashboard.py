"""The dashboard's pages as queries over the retail tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpulse.functions.clock import Clock
from retailpulse.functions.labels import stock_health
from retailpulse.operators.inventory import stock_matrix
from retailpulse.operators.kpi import judge, metric_values
from retailpulse.operators.series import with_reference_lines
from retailpulse.operators.shape import trailing
from retailpulse.plans.measures import evaluate

CARDS = [
    "total_revenue_today",
    "orders_today",
    "average_order_value_today",
    "active_alerts",
    "revenue_trend_arrow",
    "revenue_trend_color",
    "critical_alerts",
]


def kpi_cards(model: dict[str, DataFrame], as_of: Clock) -> DataFrame:
    """Page 1, card row; the alert card turns red with any critical alert."""
    cards = evaluate(model, CARDS, as_of)
    red = F.coalesce(F.col("critical_alerts"), F.lit(0)) > 0
    return cards.withColumn("alert_card_red", red)


def revenue_per_minute(metrics: DataFrame, as_of: Clock, n_minutes: int | Column = 120) -> DataFrame:
    """Page 1, line chart of the last two hours with its reference lines."""
    return with_reference_lines(trailing(metrics, "window_start", as_of, n_minutes))


def breaching_rules(sales: DataFrame, products: DataFrame, rules: DataFrame, as_of: Clock) -> DataFrame:
    """Page 1, strip of rules in breach right now."""
    judged = judge(metric_values(sales, products, rules, as_of), rules)
    return judged.filter(F.col("severity").isNotNull()).select(
        "metric_name", "value", "comparison_operator", "threshold_used", "severity"
    )


def low_stock_matrix(products: DataFrame) -> DataFrame:
    """Page 3, category -> product matrix with subtotals."""
    return stock_matrix(products)


def stock_icons(products: DataFrame) -> DataFrame:
    icon = stock_health(F.col("stock_quantity"), F.col("reorder_threshold"))
    return products.select("product_id", "stock_quantity", "reorder_threshold", icon.alias("stock_icon"))
