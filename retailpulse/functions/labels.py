"""Named states: stock health, severities, colours, breach tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from retailpulse.functions.numbers import blank_as_zero, round_half_up

# Fixed values shown by the dashboard.
ICON_OUT = "🔴 OUT"
ICON_CRIT = "🔴 CRIT"
ICON_LOW = "🟠 LOW"
ICON_OK = "🟡 OK"
ICON_HEALTHY = "🟢 HEALTHY"
SEVERITY_COLORS = {"CRITICAL": "#C0392B", "HIGH": "#E67E22", "WARNING": "#F1C40F"}
SEVERITY_COLOR_DEFAULT = "#BDC3C7"
ROW_COLORS = {"out": "#FADBD8", "half": "#FDEBD0", "low": "#FCF3CF", "else": "#FFFFFF"}
TREND_UP, TREND_DOWN, TREND_FLAT = "▲", "▼", "▶"
COLOR_GOOD, COLOR_BAD = "#27AE60", "#C0392B"


def is_low_stock(stock: Column, threshold: Column) -> Column:
    return stock <= threshold


def stock_health(stock: Column, threshold: Column) -> Column:
    """BLANK stock or threshold counts as 0, as in a BI comparison."""
    ratio = blank_as_zero(F.try_divide(stock.cast("double"), threshold.cast("double")))
    return (
        F.when(blank_as_zero(stock) == 0, ICON_OUT)
        .when(ratio <= 0.5, ICON_CRIT)
        .when(ratio <= 1, ICON_LOW)
        .when(ratio <= 2, ICON_OK)
        .otherwise(ICON_HEALTHY)
    )


def stock_row_color(stock: Column, threshold: Column) -> Column:
    stock, threshold = blank_as_zero(stock), blank_as_zero(threshold)
    return (
        F.when(stock == 0, ROW_COLORS["out"])
        .when(stock <= threshold / 2, ROW_COLORS["half"])
        .when(stock <= threshold, ROW_COLORS["low"])
        .otherwise(ROW_COLORS["else"])
    )


def low_stock_severity(stock: Column, threshold: Column) -> Column:
    return (
        F.when(stock == 0, "CRITICAL")
        .when(stock <= threshold / 2, "HIGH")
        .otherwise("WARNING")
    )


def severity_color(severity: Column) -> Column:
    picked = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, color in SEVERITY_COLORS.items():
        picked = picked.when(severity == name, color)
    return picked.otherwise(SEVERITY_COLOR_DEFAULT)


def trend_arrow(difference: Column) -> Column:
    return (
        F.when(difference > 0, TREND_UP)
        .when(difference < 0, TREND_DOWN)
        .otherwise(TREND_FLAT)
    )


def trend_color(difference: Column) -> Column:
    return F.when(difference >= 0, COLOR_GOOD).otherwise(COLOR_BAD)


def breaches(value: Column, threshold: Column, operator: Column) -> Column:
    """The five comparison operators; anything else never breaches."""
    return (
        F.when(operator == "<", value < threshold)
        .when(operator == "<=", value <= threshold)
        .when(operator == ">", value > threshold)
        .when(operator == ">=", value >= threshold)
        .when(operator == "==", value == threshold)
        .otherwise(F.lit(False))
    )


def popularity_tier(weight: Column) -> Column:
    return F.when(weight < 2, "low").when(weight < 3.5, "mid").otherwise("high")


def stock_bin(stock: Column, threshold: Column) -> Column:
    """Histogram bin by stock as a share of the reorder threshold."""
    ratio = F.try_divide(stock.cast("double"), threshold.cast("double"))
    return (
        F.when(stock == 0, "0")
        .when(ratio <= 0.10, "<=10%")
        .when(ratio <= 0.25, "<=25%")
        .when(ratio <= 0.5, "<=50%")
        .when(ratio <= 1, "<=100%")
        .when(ratio <= 2, "<=200%")
        .otherwise(">200%")
    )


def synthesized_stock(rating_count: Column) -> dict[str, Column]:
    """Stock, reorder point and popularity weight derived from a rating count."""
    rated = F.greatest(F.coalesce(rating_count, F.lit(0)), F.lit(1)).cast("double")
    stock = F.least((F.lit(80.0) + F.sqrt(rated) * F.lit(12.0)).cast("int"), F.lit(600))
    reorder = F.greatest((stock.cast("double") * F.lit(0.2)).cast("int"), F.lit(10))
    weight = F.lit(1.0) + F.least(F.log10(rated + F.lit(1.0)), F.lit(3.5))
    return {
        "stock_quantity": stock,
        "reorder_threshold": reorder,
        "popularity_weight": round_half_up(weight, 2).cast("decimal(5,2)"),
    }
