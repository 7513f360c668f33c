"""Registered queries: the thirty measures and the dashboard visuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailpulse.functions.clock import before
from retailpulse.functions.labels import severity_color, stock_row_color
from retailpulse.functions.numbers import round_half_up
from retailpulse.operators import alerts as al
from retailpulse.operators import calendar, inventory, kpi, metrics, star
from retailpulse.plans import dashboard
from retailpulse.plans import series_queries as sq
from retailpulse.plans import tables_queries as tq
from retailpulse.plans.day_sums import day_sums, evaluate_from_days
from retailpulse.plans.measures import evaluate
from retailpulse.plans.registry import query
from retailpulse.plans.relationships import Slicer

_DAY = "(SELECT date_trunc('day', as_of) FROM fx_now)"
_NOW = "(SELECT as_of FROM fx_now)"
_TODAY = f"order_timestamp >= {_DAY} AND order_timestamp < {_DAY} + INTERVAL 1 DAY"
_YESTERDAY = f"order_timestamp >= {_DAY} - INTERVAL 1 DAY AND order_timestamp < {_DAY}"


def _last(column: str, minutes: int) -> str:
    return f"{column} >= {_NOW} - INTERVAL {minutes} MINUTE"


def _sum(table: str, value: str, where: str = "true") -> str:
    return f"(SELECT CAST(sum({value}) AS DOUBLE) FROM {table} WHERE {where})"


def _count(table: str, where: str, value: str = "*") -> str:
    return f"(SELECT CAST(nullif(count({value}), 0) AS DOUBLE) FROM {table} WHERE {where})"


_REVENUE_TODAY = _sum("fx_orders", "total_amount", _TODAY)
_REVENUE_YESTERDAY = _sum("fx_orders", "total_amount", _YESTERDAY)
_LAST_5 = _sum("fx_sales", "revenue", _last("window_start", 5))
_PRIOR_5 = _sum("fx_sales", "revenue", f"{_last('window_start', 10)} AND window_start < {_NOW} - INTERVAL 5 MINUTE")
_TREND = f"(coalesce({_LAST_5}, 0) - coalesce({_PRIOR_5}, 0))"
_ORDERS_TODAY = _count("fx_orders", _TODAY, "DISTINCT order_id")
_UNITS_TODAY = _sum("fx_order_items i JOIN fx_orders o ON i.order_id = o.order_id", "quantity",
                    _TODAY.replace("order_timestamp", "o.order_timestamp"))
_STOCK = _sum("fx_stock", "stock_quantity")


def _frac(top: str, bottom: str) -> str:
    return f"floor(CAST({top} AS DOUBLE) / nullif({bottom}, 0) * 1000000 + 0.5) / 1000000"


# name -> (measure, SQL expression); ratios are compared to six digits.
SCALARS = {
    "m1_total_revenue": ("total_revenue", _sum("fx_orders", "total_amount")),
    "m2_total_revenue_today": ("total_revenue_today", _REVENUE_TODAY),
    "m3_total_revenue_yesterday": ("total_revenue_yesterday", _REVENUE_YESTERDAY),
    "m4_revenue_vs_yesterday": (
        "revenue_vs_yesterday_pct", _frac(f"({_REVENUE_TODAY} - {_REVENUE_YESTERDAY})", _REVENUE_YESTERDAY)),
    "m5_revenue_last_5_min": ("revenue_last_5_min", _LAST_5),
    "m6_revenue_last_1_hour": ("revenue_last_1_hour", _sum("fx_sales", "revenue", _last("window_start", 60))),
    "m7_revenue_prior_5_min": ("revenue_prior_5_min", _PRIOR_5),
    "m8_revenue_trend_arrow": (
        "revenue_trend_arrow", f"CASE WHEN {_TREND} > 0 THEN '▲' WHEN {_TREND} < 0 THEN '▼' ELSE '▶' END"),
    "m9_average_order_value": (
        "average_order_value", _frac(_sum("fx_orders", "total_amount"), "(SELECT count(*) FROM fx_orders)")),
    "m10_order_count": ("order_count", _count("fx_orders", "true", "DISTINCT order_id")),
    "m11_orders_today": ("orders_today", _ORDERS_TODAY),
    "m12_average_order_value_today": ("average_order_value_today", _frac(_REVENUE_TODAY, _ORDERS_TODAY)),
    "m13_orders_last_5_min": (
        "orders_last_5_min", _sum("fx_sales", "order_count", _last("window_start", 5))),
    "m14_units_sold": ("units_sold", _sum("fx_order_items", "quantity")),
    "m15_units_sold_today": ("units_sold_today", _UNITS_TODAY),
    "m16_line_revenue": ("line_revenue", _sum("fx_order_items", "quantity * unit_price")),
    "m17_total_stock": ("total_stock", _STOCK),
    "m18_low_stock_count": (
        "low_stock_count", _count("fx_stock", "stock_quantity <= reorder_threshold", "DISTINCT product_id")),
    "m19_out_of_stock_count": (
        "out_of_stock_count", _count("fx_stock", "stock_quantity = 0", "DISTINCT product_id")),
    "m20_stock_coverage_days": ("stock_coverage_days", _frac(_STOCK, _UNITS_TODAY)),
    "m22_active_alerts": ("active_alerts", _count("fx_alerts", "NOT resolved")),
    "m23_critical_alerts": ("critical_alerts", _count("fx_alerts", "severity = 'CRITICAL' AND NOT resolved")),
    "m24_anomaly_count_last_hour": (
        "anomaly_count_last_hour",
        _count("fx_alerts", f"alert_type = 'REVENUE_SPIKE' AND {_last('detected_at', 60)}")),
    "m25_low_stock_alerts_active": (
        "low_stock_alerts_active", _count("fx_alerts", "alert_type = 'LOW_STOCK' AND NOT resolved")),
    "m26_kpi_violations_last_hour": (
        "kpi_violations_last_hour",
        _count("fx_alerts", f"alert_type = 'KPI_VIOLATION' AND {_last('detected_at', 60)}")),
    "m27_alerts_last_15_min": ("alerts_last_15_min", _count("fx_alerts", _last("detected_at", 15))),
    "m30_revenue_trend_color": (
        "revenue_trend_color", f"CASE WHEN {_TREND} >= 0 THEN '#27AE60' ELSE '#C0392B' END"),
}
RATIOS = {"revenue_vs_yesterday_pct", "average_order_value", "average_order_value_today", "stock_coverage_days"}


def _plain_numbers(row):
    """Counts as doubles, so that BLANK looks the same in both engines."""
    counts = [f.name for f in row.schema.fields if f.dataType.simpleString() == "bigint"]
    ratios = [f.name for f in row.schema.fields if f.name in RATIOS]
    return row.withColumns(
        {n: F.col(n).cast("double") for n in counts} | {n: round_half_up(F.col(n), 6) for n in ratios}
    )


def _scalar(measure: str):
    def run(t):
        return _plain_numbers(evaluate(tq.model(t), [measure], t.now))

    return run


for _key, (_measure, _sql) in SCALARS.items():
    query(_key, f"SELECT {_sql} AS {_measure}")(_scalar(_measure))


_ICONS = """
SELECT CAST(product_id AS BIGINT) AS product_id, CAST(stock_quantity AS BIGINT) AS stock_quantity,
       CAST(reorder_threshold AS BIGINT) AS reorder_threshold,
       CASE WHEN stock_quantity = 0 THEN '🔴 OUT'
            WHEN stock_quantity / CAST(reorder_threshold AS DOUBLE) <= 0.5 THEN '🔴 CRIT'
            WHEN stock_quantity <= reorder_threshold THEN '🟠 LOW'
            WHEN stock_quantity <= 2 * reorder_threshold THEN '🟡 OK' ELSE '🟢 HEALTHY' END AS stock_icon
FROM fx_stock"""


@query("m21_stock_health_icon", _ICONS)
def _(t):
    return dashboard.stock_icons(t.stock)


@query("m28_severity_color", """
SELECT alert_id, severity, CASE severity WHEN 'CRITICAL' THEN '#C0392B' WHEN 'HIGH' THEN '#E67E22'
                                WHEN 'WARNING' THEN '#F1C40F' ELSE '#BDC3C7' END AS color
FROM fx_alerts""")
def _(t):
    return t.alerts.select("alert_id", "severity", severity_color(F.col("severity")).alias("color"))


@query("m29_stock_row_color", """
SELECT CAST(product_id AS BIGINT) AS product_id,
       CASE WHEN stock_quantity = 0 THEN '#FADBD8' WHEN stock_quantity <= reorder_threshold / 2.0 THEN '#FDEBD0'
            WHEN stock_quantity <= reorder_threshold THEN '#FCF3CF' ELSE '#FFFFFF' END AS row_color
FROM fx_stock""")
def _(t):
    color = stock_row_color(F.col("stock_quantity"), F.col("reorder_threshold"))
    return t.stock.select("product_id", color.alias("row_color"))


@query("m_all_in_one_row", "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in SCALARS.values()))
def _(t):
    return _plain_numbers(evaluate(tq.model(t), [name for name, _ in SCALARS.values()], t.now))


@query("m_all_from_day_sums", "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in SCALARS.values()))
def _(t):
    """Closed days from their sums, the last two days from the orders."""
    model = tq.model(t)
    closed = F.date_trunc("day", t.now) - F.expr("INTERVAL 1 DAY")
    before = model["orders"].filter(F.col("order_timestamp") < closed)
    known = model["orders"].select("order_id", "order_timestamp")
    items = model["order_items"].drop("order_timestamp").join(known, "order_id", "left")
    items = items.filter(F.coalesce(F.col("order_timestamp") < closed, F.lit(True))).drop("order_timestamp")
    sums = day_sums(before, items)
    return _plain_numbers(evaluate_from_days(model, sums, closed, [name for name, _ in SCALARS.values()], t.now))


@query("m_by_day", """
SELECT date_trunc('day', order_timestamp) AS day, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       count(DISTINCT order_id) AS order_count,
       floor(CAST(sum(total_amount) AS DOUBLE) / count(DISTINCT order_id) * 1000000 + 0.5) / 1000000 AS average_order_value
FROM fx_heads GROUP BY 1""")
def _(t):
    orders = t.heads.withColumn("day", F.date_trunc("day", "order_timestamp"))
    model = {"orders": orders}
    rows = evaluate(model, ["total_revenue", "order_count", "average_order_value"], t.today, by=["day"])
    return rows.withColumn("average_order_value", round_half_up(F.col("average_order_value"), 6))


@query("m_by_category", """
SELECT p.category, units_sold, CAST(line_revenue AS DOUBLE) AS line_revenue, CAST(total_stock AS BIGINT) AS total_stock,
       low_stock_count
FROM (SELECT category, sum(stock_quantity) AS total_stock,
             nullif(count(*) FILTER (stock_quantity <= reorder_threshold), 0) AS low_stock_count
      FROM fx_stock GROUP BY category) p
FULL OUTER JOIN (SELECT category, CAST(sum(quantity) AS BIGINT) AS units_sold, sum(quantity * unit_price) AS line_revenue
                 FROM fx_lines l JOIN fx_products p ON l.product_id = p.product_id GROUP BY category) s
  ON p.category = s.category""")
def _(t):
    model = {"order_items": t.lines, "products": t.stock}
    return evaluate(model, ["units_sold", "line_revenue", "total_stock", "low_stock_count"], t.now, by=["category"])


# --- slicers of the dashboard: date, category, popularity tier ---------------------

_SLICED = """
SELECT l.*, c.category, c.name, o.order_timestamp FROM fx_lines l JOIN fx_catalog c ON l.product_id = c.product_id JOIN fx_heads o ON l.order_id = o.order_id
WHERE {where}"""
_LAST_YEAR = "order_timestamp >= (SELECT as_of FROM fx_today) - INTERVAL 525600 MINUTE AND order_timestamp < (SELECT as_of FROM fx_today)"


def _star(t):
    return {"orders": t.heads, "order_items": t.lines, "products": tq.catalog(t)}


def _last_year(t):
    return Slicer("orders", (F.col("order_timestamp") >= before(t.today, 525_600)) & (F.col("order_timestamp") < t.today))


def _category(*names):
    return Slicer("products", F.col("category").isin(*names))


def _mid_tier():
    return Slicer("products", (F.col("popularity_weight") >= 2) & (F.col("popularity_weight") < 3.5))


@query("v5_top_products_sliced", f"""
SELECT product_id, name, CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(quantity * unit_price) AS DOUBLE) AS line_revenue
FROM ({_SLICED.format(where=_LAST_YEAR + " AND category IN ('ECONOMY', 'SMALL')")}) GROUP BY 1, 2 ORDER BY units_sold DESC, product_id LIMIT 10""")
def _(t):
    found = evaluate(_star(t), ["units_sold", "line_revenue"], t.today, ["product_id", "name"], [_last_year(t), _category("ECONOMY", "SMALL")])
    return found.orderBy(F.desc("units_sold"), "product_id").limit(10)


@query("v6_categories_sliced", f"""
SELECT category, CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(quantity * unit_price) AS DOUBLE) AS line_revenue
FROM ({_SLICED.format(where=_LAST_YEAR + " AND weight >= 2 AND weight < 3.5")}) GROUP BY 1""")
def _(t):
    return evaluate(_star(t), ["units_sold", "line_revenue"], t.today, ["category"], [_last_year(t), _mid_tier()])


@query("v7_products_sliced", f"""
SELECT c.product_id, c.name, c.category, units_sold, line_revenue, CAST(c.stock_quantity AS BIGINT) AS total_stock
FROM (SELECT * FROM fx_catalog JOIN fx_products USING (product_id, name, category) WHERE category IN ('PROMO', 'LARGE') AND weight >= 2 AND weight < 3.5) c
LEFT JOIN (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(quantity * unit_price) AS DOUBLE) AS line_revenue
           FROM ({_SLICED.format(where=_LAST_YEAR)}) GROUP BY 1) s ON c.product_id = s.product_id""")
def _(t):
    slicers = [_last_year(t), _category("PROMO", "LARGE"), _mid_tier()]
    return evaluate(_star(t), ["units_sold", "line_revenue", "total_stock"], t.today, ["product_id", "name", "category"], slicers)


@query("m_by_category_and_year", """
SELECT category, CASE WHEN order_timestamp >= (SELECT date_trunc('year', as_of) - INTERVAL 1 YEAR FROM fx_today) THEN year(order_timestamp) END AS year,
       CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(quantity * unit_price) AS DOUBLE) AS line_revenue
FROM fx_lines l JOIN fx_products p ON l.product_id = p.product_id JOIN fx_heads o ON l.order_id = o.order_id GROUP BY 1, 2""")
def _(t):
    """Three tables away: lines to orders to dates, and lines to products; days that the calendar lacks have no year."""
    dates = calendar.date_dimension(t.spark, t.today).select("date", "year")
    return evaluate({**_star(t), "dates": dates}, ["units_sold", "line_revenue"], t.today, ["category", "year"])


# --- dashboard pages --------------------------------------------------------------

@query("v1_kpi_cards", f"""
SELECT {_REVENUE_TODAY} AS total_revenue_today, {_ORDERS_TODAY} AS orders_today,
       {_frac(_REVENUE_TODAY, _ORDERS_TODAY)} AS average_order_value_today,
       {SCALARS['m22_active_alerts'][1]} AS active_alerts,
       {SCALARS['m8_revenue_trend_arrow'][1]} AS revenue_trend_arrow,
       {SCALARS['m30_revenue_trend_color'][1]} AS revenue_trend_color,
       {SCALARS['m23_critical_alerts'][1]} AS critical_alerts,
       coalesce({SCALARS['m23_critical_alerts'][1]}, 0) > 0 AS alert_card_red""")
def _(t):
    return _plain_numbers(dashboard.kpi_cards(tq.model(t), t.now))


@query("v2_revenue_per_minute", """
SELECT window_start, window_end, CAST(revenue AS DOUBLE) AS revenue, order_count, item_count,
       CAST(avg_order_value AS DOUBLE) AS avg_order_value,
       floor(CAST(sum(revenue) OVER () AS DOUBLE) / count(*) OVER () * 10000 + 0.5) / 10000 AS avg_revenue,
       CAST(min(revenue) OVER () AS DOUBLE) AS min_revenue, CAST(max(revenue) OVER () AS DOUBLE) AS max_revenue
FROM fx_sales WHERE window_start >= (SELECT as_of FROM fx_now) - INTERVAL 120 MINUTE""")
def _(t):
    points = dashboard.revenue_per_minute(metrics.recent_minute_sales(t.orders, t.now, 120), t.now)
    return points.withColumn("avg_revenue", round_half_up(F.col("avg_revenue"), 4))


@query("v3_alert_feed", sq._FEED)
def _(t):
    return al.alert_feed(t.alerts)


@query("v4_breaching_rules", f"""
WITH {sq._VIOLATIONS.strip()}
SELECT metric_name, floor(value * 10000 + 0.5) / 10000 AS value, op AS comparison_operator, used AS threshold_used, severity
FROM violations""")
def _(t):
    recent = metrics.recent_minute_sales(t.orders, t.now, kpi.lookback_minutes(t.rules))
    strip = dashboard.breaching_rules(recent, t.stock, t.rules, t.now)
    return strip.withColumn("value", round_half_up(F.col("value"), 4))


@query("v5_top_products", sq._TOP)
def _(t):
    return star.top_sellers(t.lines, t.products)


@query("v6_category_treemap", tq._BY_CATEGORY)
def _(t):
    return star.revenue_by_category(t.lines, t.products)


@query("v6_category_share", tq._SHARE)
def _(t):
    return tq._shares(t)


@query("v7_product_detail", tq._PRODUCT_DETAIL)
def _(t):
    return star.product_detail(t.stock, t.lines)


@query("v8_low_stock_matrix", tq._MATRIX)
def _(t):
    matrix = dashboard.low_stock_matrix(t.stock)
    return matrix.withColumn("product_id", F.col("product_id").cast("string"))


@query("v9_reorder_table", sq._REORDER)
def _(t):
    return inventory.reorder_suggestions(t.stock)


@query("v10_stock_histogram", tq._HISTOGRAM)
def _(t):
    return inventory.stock_histogram(t.stock)


@query("v11_depletion_velocity", sq._VELOCITY)
def _(t):
    return sq.velocity(t)


@query("v12_alert_hours", tq._ALERT_HOURS)
def _(t):
    return al.alerts_by_hour(t.alerts)


@query("v13_anomaly_overlay", """
SELECT window_start, CAST(revenue AS DOUBLE) AS revenue, coalesce(n, 0) AS spike_alerts, CAST(v AS DOUBLE) AS spike_value
FROM fx_sales LEFT JOIN (SELECT entity_id, count(*) AS n, max(detected_value) AS v
                         FROM fx_alerts WHERE alert_type = 'REVENUE_SPIKE' GROUP BY entity_id)
  ON CAST(window_start AS STRING) = entity_id""")
def _(t):
    return al.spike_overlay(t.sales_metrics, t.alerts)


@query("v14_violation_heatmap", tq._HEATMAP)
def _(t):
    return tq._heatmap(t)


@query("v15_alert_log", f"{sq._LOG} WHERE alert_type = 'REVENUE_SPIKE'")
def _(t):
    return al.alert_log(t.alerts, "REVENUE_SPIKE")
