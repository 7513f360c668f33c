"""Registered queries: sources, projections, joins, merges, aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailpulse.functions.clock import before
from retailpulse.functions.labels import synthesized_stock
from retailpulse.functions.numbers import round_half_up
from retailpulse.operators import alerts as al
from retailpulse.operators import basket, calendar, inventory, kpi, merge, metrics, shape, star
from retailpulse.plans.measures import evaluate, lookback_minutes, star_model
from retailpulse.plans.registry import query
from retailpulse.sources import events as ev
from retailpulse.sources import tables
from retailpulse.sources.catalog import categories, flatten_documents, hydrate
from retailpulse.sources.testbed import Testbed


def order_documents(t: Testbed):
    """Orders with an items array: missing for views, empty for signups."""
    item = F.struct(
        F.get_json_object("props", "$.k").cast("int").alias("product_id"),
        (1 + F.col("event_id") % 5).cast("int").alias("quantity"),
        F.col("value").cast("decimal(10,2)").alias("unit_price"),
    )
    items = (
        F.when(F.col("event_type") == "view", F.lit(None))
        .when(F.col("event_type") == "signup", F.slice(F.array(item), 1, 0))
        .otherwise(F.array(item))
    )
    return t.events.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("order_id"),
        F.concat(F.lit("CUST-"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("customer_id"),
        F.col("ts").alias("order_timestamp"),
        F.col("value").cast("decimal(12,2)").alias("total_amount"),
        (1 + F.col("event_id") % 5).cast("int").alias("item_count"),
        F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.upper("event_type")).alias("status"),
        items.alias("items"),
    )


def product_documents(t: Testbed):
    """Parts as nested catalog documents with long texts and missing fields."""
    rated = t.rated_products
    return rated.select(
        F.col("product_id").alias("id"),
        F.repeat(F.concat("name", F.lit(" ")), 60).alias("title"),
        F.col("price").cast("double").alias("price"),
        "category",
        F.repeat(F.concat("category", F.lit("/")), 400).alias("description"),
        F.when(F.col("stock_quantity") > 100, F.concat(F.lit("img-"), "product_id")).alias("image"),
        F.when(
            F.col("rating_count") > 0,
            F.struct((F.col("rating_count") % 5).cast("double").alias("rate"), F.col("rating_count").alias("count")),
        ).alias("rating"),
    )


def catalog(t: Testbed):
    """A stored catalog: popularity weights, and two origins."""
    weight = synthesized_stock(F.col("rating_count"))["popularity_weight"]
    origin = F.when(F.col("stock_quantity") > 100, "catalog_api").otherwise("seed")
    return t.rated_products.withColumns({"popularity_weight": weight, "source": origin})


# --- sources -------------------------------------------------------------

@query("s2_decode_payload", """
SELECT order_id, customer_id, date_trunc('millisecond', order_timestamp) AS order_timestamp,
       CAST(total_amount AS DOUBLE) AS total_amount, CAST(item_count AS BIGINT) AS item_count, status,
       CAST(CASE event_type WHEN 'view' THEN -1 WHEN 'signup' THEN 0 ELSE 1 END AS BIGINT) AS n_items
FROM fx_orders""")
def _(t):
    messages = ev.encode(order_documents(t)).select(
        F.col("value").alias("json"), F.lit(None).cast("timestamp").alias("arrived_at")
    )
    decoded = ev.accepted(ev.decode(messages))
    size = F.when(F.col("items").isNull(), -1).otherwise(F.size("items"))
    return decoded.select(
        "order_id", "customer_id", "order_timestamp", "total_amount", "item_count", "status", size.alias("n_items")
    )


@query("s6_bi_tables", """
SELECT status, count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM fx_heads GROUP BY status""")
def _(t):
    t.heads.createOrReplaceTempView("bi_orders")
    return t.spark.sql(
        "SELECT status, count(*) AS orders, sum(total_amount) AS revenue FROM bi_orders GROUP BY status"
    )


@query("s7_catalog_scan", """
SELECT CAST(c.product_id AS BIGINT) AS product_id, c.name, c.category, CAST(c.price AS DOUBLE) AS price,
       weight AS popularity_weight
FROM fx_catalog c JOIN fx_products p ON c.product_id = p.product_id WHERE p.stock_quantity > 100""")
def _(t):
    return tables.catalog_scan(catalog(t))


@query("s8_categories", "SELECT DISTINCT p_type AS category FROM part")
def _(t):
    return categories(t.products)


@query("s9_enabled_rules", """
SELECT metric_name, CAST(warning_threshold AS DOUBLE) AS warning_threshold,
       CAST(critical_threshold AS DOUBLE) AS critical_threshold, comparison_operator,
       CAST(window_minutes AS BIGINT) AS window_minutes, n AS violations, last_at AS last_violation
FROM fx_rules LEFT JOIN (SELECT entity_id, count(*) AS n, max(detected_at) AS last_at
                         FROM fx_alerts WHERE alert_type = 'KPI_VIOLATION' GROUP BY entity_id)
  ON metric_name = entity_id""")
def _(t):
    seen = t.alerts.filter(F.col("alert_type") == "KPI_VIOLATION").groupBy(
        F.col("entity_id").alias("metric_name")
    ).agg(F.count("*").alias("violations"), F.max("detected_at").alias("last_violation"))
    return tables.enabled_rules(t.rules).join(seen, "metric_name", "left").select(
        "metric_name", "warning_threshold", "critical_threshold", "comparison_operator",
        "window_minutes", "violations", "last_violation",
    )


@query("s9_disabled_rules", """
SELECT metric_name, CAST(warning_threshold AS DOUBLE) AS warning_threshold, n AS violations
FROM fx_rules JOIN (SELECT entity_id, count(*) AS n FROM fx_alerts WHERE alert_type = 'KPI_VIOLATION' GROUP BY entity_id) ON metric_name = entity_id
WHERE window_minutes >= 5 AND comparison_operator = '<'""")
def _(t):
    """Rules switched off, or neither on nor off, are not scanned."""
    switched = F.when(F.col("window_minutes") < 5, F.lit(None)).otherwise(F.col("comparison_operator") == "<")
    scanned = tables.enabled_rules(t.rules.withColumn("enabled", switched))
    seen = t.alerts.filter(F.col("alert_type") == "KPI_VIOLATION").groupBy(F.col("entity_id").alias("metric_name")).agg(F.count("*").alias("violations"))
    return scanned.join(seen, "metric_name").select("metric_name", "warning_threshold", "violations")


@query("s11_row_counts", """
SELECT 'products' AS table_name, count(*) AS row_count FROM fx_products
UNION ALL SELECT 'orders', count(*) FROM fx_orders
UNION ALL SELECT 'order_items', count(*) FROM fx_order_items
UNION ALL SELECT 'sales_metrics', count(*) FROM fx_sales
UNION ALL SELECT 'alerts', count(*) FROM fx_alerts""")
def _(t):
    return tables.row_counts({
        "products": t.products, "orders": t.orders, "order_items": t.order_items,
        "sales_metrics": t.sales_metrics, "alerts": t.alerts,
    })


# --- projections and filters ----------------------------------------------

@query("p1_order_headers", """
SELECT order_id, customer_id, order_timestamp, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(item_count AS BIGINT) AS item_count, coalesce(status, 'CREATED') AS status
FROM fx_orders""")
def _(t):
    return shape.order_headers(t.orders)


@query("p2_line_items", """
SELECT order_id, CAST(k AS BIGINT) AS product_id, CAST(item_count AS BIGINT) AS quantity,
       CAST(CAST(total_amount AS DECIMAL(10,2)) AS DOUBLE) AS unit_price
FROM fx_orders WHERE event_type NOT IN ('view', 'signup')""")
def _(t):
    return shape.order_lines(order_documents(t))


@query("p3_line_totals", """
SELECT order_id, CAST(product_id AS BIGINT) AS product_id, CAST(quantity AS BIGINT) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(CAST(quantity * unit_price AS DECIMAL(12,2)) AS DOUBLE) AS line_total
FROM fx_lines""")
def _(t):
    return shape.with_line_total(t.lines)


@query("p4_catalog_listing", """
SELECT CAST(product_id AS BIGINT) AS product_id, name, category, CAST(price AS DOUBLE) AS price,
       weight AS popularity_weight
FROM fx_catalog""")
def _(t):
    return tables.catalog_scan(catalog(t), source=None)


@query("p5_trailing_window", """
SELECT window_start, CAST(revenue AS DOUBLE) AS revenue, order_count
FROM fx_sales WHERE window_start >= (SELECT as_of FROM fx_now) - INTERVAL 1440 MINUTE""")
def _(t):
    return metrics.recent_minute_sales(t.orders, t.now, 1440).select(
        "window_start", "revenue", "order_count"
    )


@query("p6_low_stock", """
SELECT CAST(product_id AS BIGINT) AS product_id, CAST(stock_quantity AS BIGINT) AS stock_quantity,
       CAST(reorder_threshold AS BIGINT) AS reorder_threshold
FROM fx_stock WHERE stock_quantity <= reorder_threshold""")
def _(t):
    return inventory.low_stock(t.stock).select("product_id", "stock_quantity", "reorder_threshold")


@query("p7_alert_filters", """
SELECT alert_type, severity, count(*) AS open_alerts FROM fx_alerts WHERE NOT resolved GROUP BY 1, 2""")
def _(t):
    return al.unresolved(t.alerts).groupBy("alert_type", "severity").agg(F.count("*").alias("open_alerts"))


@query("p8_text_widths", """
SELECT CAST(product_id AS BIGINT) AS product_id, left(repeat(name || ' ', 60), 490) AS name, category,
       CASE WHEN stock_quantity > 100 THEN 'img-' || CAST(product_id AS STRING) ELSE '' END AS image_url,
       md5(left(repeat(category || '/', 400), 2000)) AS description_md5
FROM fx_products""")
def _(t):
    fitted = shape.fit_widths(flatten_documents(product_documents(t)))
    return fitted.select("product_id", "name", "category", "image_url", F.md5("description").alias("description_md5"))


@query("p9_slicers", """
SELECT c.category, CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(quantity * unit_price) AS DOUBLE) AS line_revenue
FROM fx_lines l JOIN fx_heads h ON l.order_id = h.order_id JOIN fx_catalog c ON l.product_id = c.product_id
WHERE order_timestamp >= (SELECT as_of FROM fx_today) - INTERVAL 525600 MINUTE
  AND order_timestamp < (SELECT as_of FROM fx_today)
  AND c.category IN ('ECONOMY', 'SMALL') AND weight >= 2 AND weight < 3.5
GROUP BY c.category""")
def _(t):
    sales = star.enrich_items(t.heads, t.lines, catalog(t))
    shown = shape.slice_sales(sales, before(t.today, 525_600), t.today, ["ECONOMY", "SMALL"], "mid")
    return shown.groupBy("category").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum(F.col("quantity") * F.col("unit_price")).alias("line_revenue"),
    )


@query("p10_resolve_alerts", """
SELECT alert_type, true AS resolved, count(*) AS alerts, count(*) FILTER (NOT resolved) AS affected
FROM fx_alerts GROUP BY alert_type""")
def _(t):
    return shape.resolve_alerts(t.alerts).groupBy("alert_type", "resolved").agg(
        F.count("*").alias("alerts"), F.count_if("changed").alias("affected")
    )


@query("p10_alert_states", """
SELECT alert_type, severity, resolved, resolved_at IS NOT NULL AS resolved_later, count(*) AS alerts,
       max(date_diff('second', detected_at, resolved_at)) AS longest_seconds
FROM fx_alert_states GROUP BY 1, 2, 3, 4""")
def _(t):
    lasted = F.unix_seconds("resolved_at") - F.unix_seconds("detected_at")
    return t.alert_states.groupBy("alert_type", "severity", "resolved", F.col("resolved_at").isNotNull().alias("resolved_later")).agg(
        F.count("*").alias("alerts"), F.max(lasted).alias("longest_seconds")
    )


@query("p10_resolved_feed", """
SELECT alert_id, detected_at, severity, alert_type, entity_id, message,
       CASE severity WHEN 'CRITICAL' THEN '#C0392B' WHEN 'HIGH' THEN '#E67E22' WHEN 'WARNING' THEN '#F1C40F' ELSE '#BDC3C7' END AS color
FROM fx_alert_states WHERE NOT resolved ORDER BY detected_at DESC, alert_id DESC LIMIT 15""")
def _(t):
    return al.alert_feed(t.alert_states)


@query("p10_resolved_measures", """
SELECT nullif(count(*) FILTER (NOT resolved), 0) AS active_alerts,
       nullif(count(*) FILTER (NOT resolved AND severity = 'CRITICAL'), 0) AS critical_alerts,
       nullif(count(*) FILTER (NOT resolved AND alert_type = 'LOW_STOCK'), 0) AS low_stock_alerts_active,
       nullif(count(*) FILTER (detected_at >= (SELECT as_of FROM fx_now) - INTERVAL 15 MINUTE), 0) AS alerts_last_15_min
FROM fx_alert_states""")
def _(t):
    measures = ["active_alerts", "critical_alerts", "low_stock_alerts_active", "alerts_last_15_min"]
    return evaluate({"alerts": t.alert_states}, measures, t.now)


# --- joins and merges ------------------------------------------------------

_J1 = """
SELECT 'LOW_STOCK' AS alert_type, CAST(product_id AS STRING) AS entity_id,
       CASE WHEN stock_quantity = 0 THEN 'CRITICAL' WHEN stock_quantity <= reorder_threshold / 2.0 THEN 'HIGH'
            ELSE 'WARNING' END AS severity
FROM fx_stock p WHERE stock_quantity <= reorder_threshold
  AND NOT EXISTS (SELECT 1 FROM fx_alerts a WHERE a.alert_type = 'LOW_STOCK'
                  AND a.entity_id = CAST(p.product_id AS STRING)
                  AND a.detected_at > (SELECT as_of FROM fx_now) - INTERVAL {minutes} MINUTE)"""


def _held_back(t, minutes):
    fresh = al.suppress_recent(
        inventory.low_stock_alerts(t.stock, t.now), t.alerts, al.LOW_STOCK_KEY, t.now, minutes
    )
    return fresh.select("alert_type", "entity_id", "severity")


@query("j1_cooldown_anti_join", _J1.format(minutes=10))
def _(t):
    return _held_back(t, 10)


@query("j1_cooldown_anti_join_week", _J1.format(minutes=10080))
def _(t):
    return _held_back(t, 10_080)


@query("j2_star_join", """
SELECT status, category, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units_sold,
       CAST(sum(quantity * unit_price) AS DOUBLE) AS line_revenue
FROM fx_lines l JOIN fx_heads h ON l.order_id = h.order_id JOIN fx_products p ON l.product_id = p.product_id
GROUP BY status, category""")
def _(t):
    sales = star.enrich_items(t.heads, t.lines, t.products)
    return sales.groupBy("status", "category").agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("units_sold"),
        F.sum(F.col("quantity") * F.col("unit_price")).alias("line_revenue"),
    )


@query("j3_date_dimension_join", """
SELECT year(order_timestamp) AS year, strftime(order_timestamp, '%b %Y') AS month,
       year(order_timestamp) * 100 + month(order_timestamp) AS month_num,
       count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM fx_heads, fx_today
WHERE order_timestamp >= make_date(year(as_of) - 1, 1, 1) AND CAST(order_timestamp AS DATE) <= CAST(as_of AS DATE) + 30
GROUP BY 1, 2, 3""")
def _(t):
    days = calendar.date_dimension(t.spark, t.today)
    return calendar.by_calendar(t.heads, days, "year", "month", "month_num")


@query("j4_additive_merge", """
SELECT window_start, window_end, CAST(revenue AS DOUBLE) AS revenue, order_count, item_count,
       CAST(avg_order_value AS DOUBLE) AS avg_order_value
FROM fx_sales""")
def _(t):
    stored = metrics.minute_sales(t.orders.filter(F.col("status").isNotNull()))
    arriving = metrics.minute_sales(t.orders.filter(F.col("status").isNull()))
    return merge.merge_minute_sales(stored, arriving)


@query("j4_additive_merge_products", """
SELECT window_start, window_end, CAST(product_id AS BIGINT) AS product_id, units_sold, CAST(revenue AS DOUBLE) AS revenue
FROM fx_psm""")
def _(t):
    late = F.col("event_type") == "purchase"
    return merge.merge_product_minutes(
        metrics.product_minute_sales(t.order_items.filter(~late)),
        metrics.product_minute_sales(t.order_items.filter(late)),
    )


@query("j5_catalog_merge", """
WITH stored AS (SELECT product_id, name, category, price,
                       CASE WHEN category = 'LARGE' THEN NULL ELSE stock_quantity END AS stock_quantity,
                       reorder_threshold FROM fx_products WHERE category <> 'SMALL'),
     incoming AS (SELECT product_id, upper(name) AS name, category, CAST(price * 2 AS DECIMAL(10,2)) AS price,
                         rating_count AS stock_quantity, 10 AS reorder_threshold
                  FROM fx_rated WHERE category <> 'ECONOMY')
SELECT CAST(coalesce(s.product_id, i.product_id) AS BIGINT) AS product_id, coalesce(i.name, s.name) AS name,
       coalesce(i.category, s.category) AS category, CAST(coalesce(i.price, s.price) AS DOUBLE) AS price,
       CAST(coalesce(s.stock_quantity, i.stock_quantity) AS BIGINT) AS stock_quantity,
       CAST(coalesce(s.reorder_threshold, i.reorder_threshold) AS BIGINT) AS reorder_threshold
FROM stored s FULL OUTER JOIN incoming i ON s.product_id = i.product_id""")
def _(t):
    stock = F.when(F.col("category") != "LARGE", F.col("stock_quantity"))
    stored = t.products.filter(F.col("category") != "SMALL").withColumn("stock_quantity", stock)
    incoming = t.rated_products.filter(F.col("category") != "ECONOMY").select(
        "product_id", F.upper("name").alias("name"), "category",
        (F.col("price") * 2).cast("decimal(10,2)").alias("price"),
        F.col("rating_count").alias("stock_quantity"),
        F.lit(10).alias("reorder_threshold"),
    )
    return merge.merge_catalog(stored, incoming)


@query("j6_stock_decrement", """
SELECT CAST(product_id AS BIGINT) AS product_id, CAST(stock_quantity AS BIGINT) AS stock_quantity FROM fx_stock""")
def _(t):
    return t.stock.select("product_id", "stock_quantity")


@query("j6_sale_movements", """
SELECT CAST(s.product_id AS BIGINT) AS product_id, 'SALE' AS change_type, -qty AS quantity_change,
       CAST(stock_quantity AS BIGINT) AS stock_after
FROM fx_sold s JOIN fx_stock p ON s.product_id = p.product_id""")
def _(t):
    return inventory.sale_movements(t.products, t.purchases)


@query("j7_anomaly_overlay", """
SELECT window_start, CAST(revenue AS DOUBLE) AS revenue, coalesce(n, 0) AS spike_alerts, CAST(v AS DOUBLE) AS spike_value
FROM fx_sales LEFT JOIN (SELECT entity_id, count(*) AS n, max(detected_value) AS v
                         FROM fx_alerts WHERE alert_type = 'REVENUE_SPIKE' GROUP BY entity_id)
  ON CAST(window_start AS STRING) = entity_id""")
def _(t):
    return al.spike_overlay(t.sales_metrics, t.alerts)


@query("j8_rules_and_metrics", """
SELECT metric_name, floor(value * 10000 + 0.5) / 10000 AS value, comparison_operator,
       CAST(window_minutes AS BIGINT) AS window_minutes
FROM fx_metric_values JOIN fx_rules USING (metric_name)""")
def _(t):
    recent = metrics.recent_minute_sales(t.orders, t.now, kpi.lookback_minutes(t.rules))
    judged = kpi.judge(kpi.metric_values(recent, t.stock, t.rules, t.now), t.rules)
    return judged.select(
        "metric_name", round_half_up(F.col("value"), 4).alias("value"), "comparison_operator", "window_minutes"
    )


@query("j9_rules_with_violations", """
SELECT r.metric_name, count(a.alert_id) AS violations
FROM (SELECT metric_name FROM fx_rules UNION ALL SELECT 'never_violated') r
LEFT JOIN fx_alerts a ON r.metric_name = a.entity_id AND a.alert_type = 'KPI_VIOLATION'
GROUP BY r.metric_name""")
def _(t):
    one = t.rules.filter(F.col("metric_name") == "revenue_per_5min")
    more = one.withColumn("metric_name", F.lit("never_violated"))
    heat = al.violations_by_rule_and_hour(t.rules.unionByName(more), t.alerts)
    total = sum((F.col(str(hour)) for hour in range(24)), F.lit(0))
    return heat.select("metric_name", total.cast("bigint").alias("violations"))


_PRODUCT_DETAIL = """
SELECT CAST(p.product_id AS BIGINT) AS product_id, name, category, CAST(price AS DOUBLE) AS price, units_sold,
       CAST(line_revenue AS DOUBLE) AS line_revenue, CAST(stock_quantity AS BIGINT) AS stock_quantity,
       CASE WHEN stock_quantity = 0 THEN '🔴 OUT'
            WHEN stock_quantity / CAST(reorder_threshold AS DOUBLE) <= 0.5 THEN '🔴 CRIT'
            WHEN stock_quantity <= reorder_threshold THEN '🟠 LOW'
            WHEN stock_quantity <= 2 * reorder_threshold THEN '🟡 OK' ELSE '🟢 HEALTHY' END AS stock_icon,
       CASE WHEN stock_quantity = 0 THEN '#FADBD8' WHEN stock_quantity <= reorder_threshold / 2.0 THEN '#FDEBD0'
            WHEN stock_quantity <= reorder_threshold THEN '#FCF3CF' ELSE '#FFFFFF' END AS row_color
FROM fx_stock p LEFT JOIN (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold,
                                  sum(quantity * unit_price) AS line_revenue FROM fx_lines GROUP BY product_id) s
  ON p.product_id = s.product_id"""


@query("j10_product_detail_join", _PRODUCT_DETAIL)
def _(t):
    return star.product_detail(t.stock, t.lines)


# --- aggregates --------------------------------------------------------------

@query("a1_minute_sales", """
SELECT window_start, window_end, CAST(revenue AS DOUBLE) AS revenue, order_count, item_count,
       CAST(avg_order_value AS DOUBLE) AS avg_order_value
FROM fx_sales""")
def _(t):
    return metrics.minute_sales(t.orders)


@query("a2_product_minute_sales", """
SELECT window_start, window_end, CAST(product_id AS BIGINT) AS product_id, units_sold, CAST(revenue AS DOUBLE) AS revenue
FROM fx_psm""")
def _(t):
    return metrics.product_minute_sales(t.order_items)


@query("a3_batch_decrement", "SELECT CAST(product_id AS BIGINT) AS product_id, qty FROM fx_sold")
def _(t):
    return metrics.units_by_product(t.purchases)


@query("a4_basket_sizes", """
SELECT CAST(least(n_items, 8) AS BIGINT) AS bucket, count(*) AS weight FROM fx_carts GROUP BY 1""")
def _(t):
    return basket.basket_sizes(t.carts, F.col("n_items"))


@query("a5_line_quantities", """
SELECT CAST(least(coalesce(quantity, 1), 8) AS BIGINT) AS bucket, count(*) AS weight FROM fx_lines GROUP BY 1""")
def _(t):
    return basket.line_quantities(t.lines)


@query("a6_distribution_or_default", """
WITH mined AS (SELECT CAST(least(n_items, 8) AS BIGINT) AS bucket, count(*) AS weight FROM fx_carts GROUP BY 1)
SELECT * FROM mined
UNION ALL
SELECT * FROM (VALUES (1, 30), (2, 35), (3, 20), (4, 10), (5, 5)) AS d(bucket, weight)
WHERE NOT EXISTS (SELECT 1 FROM mined)""")
def _(t):
    return basket.or_default(basket.basket_sizes(t.carts, F.col("n_items")), basket.DEFAULT_SIZES)


def model(t: Testbed):
    """Base tables of the measures, minute-grained.

    The minute metrics reach back as far as the measure that looks furthest.
    """
    recent = metrics.recent_minute_sales(t.orders, t.now, lookback_minutes("sales_metrics"))
    return star_model(t.orders, t.order_items, t.stock, recent, t.alerts)


@query("a7_distinct_counts", """
SELECT (SELECT count(DISTINCT order_id) FROM fx_orders) AS order_count,
       (SELECT nullif(count(DISTINCT product_id), 0) FROM fx_stock WHERE stock_quantity <= reorder_threshold) AS low_stock_count,
       (SELECT nullif(count(DISTINCT product_id), 0) FROM fx_stock WHERE stock_quantity = 0) AS out_of_stock_count""")
def _(t):
    return evaluate(model(t), ["order_count", "low_stock_count", "out_of_stock_count"], t.now)


@query("a8_conditional_aggregates", """
SELECT status, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(total_amount) FILTER (order_timestamp >= d AND order_timestamp < d + INTERVAL 1 DAY) AS DOUBLE) AS total_revenue_today,
       CAST(sum(total_amount) FILTER (order_timestamp >= d - INTERVAL 1 DAY AND order_timestamp < d) AS DOUBLE) AS total_revenue_yesterday,
       count(DISTINCT order_id) AS order_count
FROM fx_orders, (SELECT date_trunc('day', as_of) AS d FROM fx_now) GROUP BY status""")
def _(t):
    names = ["total_revenue", "total_revenue_today", "total_revenue_yesterday", "order_count"]
    return evaluate(model(t), names, t.now, by=["status"])


_MATRIX = """
SELECT category, CAST(product_id AS STRING) AS product_id, CAST(sum(stock_quantity) AS BIGINT) AS stock_quantity,
       CAST(sum(reorder_threshold) AS BIGINT) AS reorder_threshold,
       CAST(grouping(category) * 2 + grouping(product_id) AS BIGINT) AS level,
       CASE WHEN grouping(category) * 2 + grouping(product_id) = 0 THEN
         CASE WHEN sum(stock_quantity) = 0 THEN '🔴 OUT'
              WHEN sum(stock_quantity) / CAST(sum(reorder_threshold) AS DOUBLE) <= 0.5 THEN '🔴 CRIT'
              WHEN sum(stock_quantity) <= sum(reorder_threshold) THEN '🟠 LOW'
              WHEN sum(stock_quantity) <= 2 * sum(reorder_threshold) THEN '🟡 OK' ELSE '🟢 HEALTHY' END END AS stock_icon
FROM fx_stock GROUP BY ROLLUP (category, product_id)"""


@query("a9_stock_matrix", _MATRIX)
def _(t):
    return inventory.stock_matrix(t.stock).withColumn("product_id", F.col("product_id").cast("string"))


_BY_CATEGORY = """
SELECT category, CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(quantity * unit_price) AS DOUBLE) AS line_revenue
FROM fx_lines l JOIN fx_products p ON l.product_id = p.product_id GROUP BY category"""


@query("a10_revenue_by_category", _BY_CATEGORY)
def _(t):
    return star.revenue_by_category(t.lines, t.products)


_SHARE = """
SELECT bin, category, CAST(r AS DOUBLE) AS line_revenue, CAST(sum(r) OVER (PARTITION BY bin) AS DOUBLE) AS bin_revenue,
       floor(CAST(r AS DOUBLE) / CAST(sum(r) OVER (PARTITION BY bin) AS DOUBLE) * 1000000 + 0.5) / 1000000 AS share
FROM (SELECT date_trunc('hour', order_timestamp) AS bin, category, sum(quantity * unit_price) AS r
      FROM fx_order_items i JOIN fx_products p ON i.product_id = p.product_id GROUP BY 1, 2)"""


def _shares(t):
    shares = star.category_share(t.order_items, t.products)
    return shares.withColumn("share", round_half_up(F.col("share"), 6)).select(
        "bin", "category", "line_revenue", "bin_revenue", "share"
    )


@query("a11_category_share", _SHARE)
def _(t):
    return _shares(t)


_ALERT_HOURS = """
SELECT date_trunc('hour', detected_at) AS hour, count(*) FILTER (alert_type = 'KPI_VIOLATION') AS "KPI_VIOLATION",
       count(*) FILTER (alert_type = 'LOW_STOCK') AS "LOW_STOCK",
       count(*) FILTER (alert_type = 'REVENUE_SPIKE') AS "REVENUE_SPIKE"
FROM fx_alerts GROUP BY 1"""


@query("a12_alerts_by_hour", _ALERT_HOURS)
def _(t):
    return al.alerts_by_hour(t.alerts)


_HEATMAP = (
    "SELECT r.metric_name, "
    + ", ".join(f"count(*) FILTER (hour(detected_at) = {h}) AS \"h{h}\"" for h in range(24))
    + " FROM fx_rules r LEFT JOIN fx_alerts a ON r.metric_name = a.entity_id"
    + " AND a.alert_type = 'KPI_VIOLATION' GROUP BY r.metric_name"
)


def _heatmap(t):
    heat = al.violations_by_rule_and_hour(t.rules, t.alerts)
    return heat.select("metric_name", *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


@query("a13_violation_heatmap", _HEATMAP)
def _(t):
    return _heatmap(t)


@query("a14_severity_distribution", "SELECT severity, count(*) AS alerts FROM fx_alerts GROUP BY severity")
def _(t):
    return al.severity_distribution(t.alerts)


@query("a15_order_assembly", """
SELECT order_id, CAST(sum(CAST(quantity * unit_price AS DECIMAL(12,2))) AS DOUBLE) AS total_amount,
       CAST(sum(quantity) AS BIGINT) AS item_count, count(*) AS n_items,
       CAST(sum(CAST(quantity * unit_price AS DECIMAL(12,2))) AS DOUBLE) AS items_amount
FROM fx_lines GROUP BY order_id""")
def _(t):
    orders = shape.nest_orders(t.lines, ["product_id", "quantity", "unit_price"])
    amount = F.aggregate(
        "items", F.lit(0).cast("decimal(22,2)"), lambda a, x: (a + x.line_total).cast("decimal(22,2)")
    )
    return orders.select(
        "order_id", "total_amount", "item_count", F.size("items").alias("n_items"), amount.alias("items_amount")
    )


@query("a16_series_statistics", """
SELECT date_trunc('day', window_start) AS day, count(*) AS n_rows,
       floor(CAST(sum(revenue) AS DOUBLE) / count(*) * 10000 + 0.5) / 10000 AS mean_revenue,
       floor(stddev_pop(CAST(revenue AS DOUBLE)) * 10000 + 0.5) / 10000 AS std_revenue,
       floor(median(CAST(revenue AS DOUBLE)) * 10000 + 0.5) / 10000 AS median_revenue
FROM fx_sales GROUP BY 1""")
def _(t):
    stats = metrics.series_stats(t.sales_metrics, F.date_trunc("day", "window_start").alias("day"))
    rounded = {n: round_half_up(F.col(n), 4) for n in ("mean_revenue", "std_revenue", "median_revenue")}
    return stats.withColumns(rounded)


_HISTOGRAM = """
SELECT CASE WHEN stock_quantity = 0 THEN '0' WHEN r <= 0.10 THEN '<=10%' WHEN r <= 0.25 THEN '<=25%'
            WHEN r <= 0.5 THEN '<=50%' WHEN r <= 1 THEN '<=100%' WHEN r <= 2 THEN '<=200%' ELSE '>200%' END AS stock_bin,
       count(*) AS products
FROM (SELECT stock_quantity, stock_quantity / CAST(reorder_threshold AS DOUBLE) AS r FROM fx_stock) GROUP BY 1"""


@query("a17_stock_histogram", _HISTOGRAM)
def _(t):
    return inventory.stock_histogram(t.stock)


@query("a18_throughput", """
SELECT count(*) AS orders,
       floor(count(*) / greatest(CAST(epoch_us(max(order_timestamp)) - epoch_us(min(order_timestamp)) AS DOUBLE) / 60e6, 1) * 100 + 0.5) / 100 AS rate_per_minute
FROM fx_orders""")
def _(t):
    return metrics.throughput(t.orders)


# --- catalog ------------------------------------------------------------------

@query("c1_stock_synthesis", """
SELECT CAST(product_id AS BIGINT) AS product_id, CAST(stock AS BIGINT) AS stock_quantity,
       CAST(greatest(CAST(floor(stock * CAST(0.2 AS DOUBLE)) AS INT), 10) AS BIGINT) AS reorder_threshold, weight AS popularity_weight
FROM fx_catalog""")
def _(t):
    return t.rated_products.select("product_id", "rating_count").withColumns(
        synthesized_stock(F.col("rating_count"))
    ).drop("rating_count")


@query("c2_flatten_documents", """
SELECT CAST(product_id AS BIGINT) AS product_id, category, CAST(price AS DOUBLE) AS price,
       CAST(rating_count % 5 AS DOUBLE) AS rating_rate, CAST(rating_count AS BIGINT) AS rating_count
FROM fx_rated""")
def _(t):
    flat = flatten_documents(product_documents(t))
    return flat.select("product_id", "category", "price", "rating_rate", "rating_count")


@query("c3_catalog_refresh", """
WITH stored AS (SELECT * FROM fx_products WHERE category <> 'SMALL'),
     documents AS (SELECT product_id, stock_quantity > 100 AS pictured FROM fx_products)
SELECT CAST(c.weight AS DOUBLE) AS popularity_weight,
       CASE WHEN pictured THEN 'img-' || c.product_id ELSE '' END AS image_url,
       left(repeat(c.category || '/', 400), 2000) AS description, CAST(c.rating_count % 5 AS DOUBLE) AS rating_rate,
       CAST(c.rating_count AS BIGINT) AS rating_count, 'catalog_api' AS source,
       CAST(c.product_id AS BIGINT) AS product_id, left(repeat(c.name || ' ', 60), 490) AS name, c.category,
       CAST(c.price AS DOUBLE) AS price, CAST(coalesce(s.stock_quantity, c.stock) AS BIGINT) AS stock_quantity,
       CAST(coalesce(s.reorder_threshold, greatest(CAST(floor(c.stock * CAST(0.2 AS DOUBLE)) AS INT), 10)) AS BIGINT) AS reorder_threshold
FROM fx_catalog c JOIN documents d ON c.product_id = d.product_id LEFT JOIN stored s ON c.product_id = s.product_id""")
def _(t):
    stored = t.products.filter(F.col("category") != "SMALL")
    return hydrate(product_documents(t), stored)


@query("t9_stock_by_event_time", """
WITH levels AS (SELECT product_id, max(order_timestamp) AS restocked_at FROM fx_purchases WHERE product_id % 2 = 0 AND event_id % 5 = 1 GROUP BY 1),
     level AS (SELECT l.product_id, restocked_at, 40 + max(event_id % 50) AS q FROM levels l JOIN fx_purchases p
               ON l.product_id = p.product_id AND p.order_timestamp = restocked_at AND event_id % 5 = 1 GROUP BY 1, 2),
     sold AS (SELECT p.product_id, sum(quantity) AS q FROM fx_purchases p LEFT JOIN level l ON p.product_id = l.product_id
              WHERE restocked_at IS NULL OR order_timestamp > restocked_at GROUP BY 1)
SELECT CAST(p.product_id AS BIGINT) AS product_id, CAST(greatest(0, coalesce(l.q, stock_quantity) - coalesce(s.q, 0)) AS BIGINT) AS stock_quantity
FROM fx_products p LEFT JOIN level l ON p.product_id = l.product_id LEFT JOIN sold s ON p.product_id = s.product_id""")
def _(t):
    """Every fifth purchase of an even product is followed by a restock at its own time."""
    restocks = t.purchases.filter("product_id % 2 = 0 AND event_id % 5 = 1").select(
        "product_id", (40 + F.col("event_id") % 50).cast("int").alias("stock_quantity"), F.col("order_timestamp").alias("restocked_at")
    )
    return inventory.stock_after_movements(t.products, t.purchases, restocks).select("product_id", "stock_quantity")


@query("t9_current_stock", """
WITH sold AS (SELECT product_id, sum(CASE WHEN event_id % 2 = 0 THEN quantity END) AS earlier,
                     sum(CASE WHEN event_id % 2 = 1 THEN quantity END) AS later FROM fx_purchases GROUP BY product_id)
SELECT CAST(p.product_id AS BIGINT) AS product_id, category,
       CAST(greatest(0, CASE WHEN p.product_id % 3 = 0 THEN 77 ELSE stock_quantity - coalesce(earlier, 0) END
                        - coalesce(later, 0)) AS BIGINT) AS stock_quantity
FROM fx_products p LEFT JOIN sold s ON p.product_id = s.product_id""")
def _(t):
    """Stock after sales, a restock of every third product to 77, and more sales."""
    sales = t.purchases.select("product_id", F.col("quantity").cast("bigint").alias("quantity"), "event_id")
    earlier, later = (sales.filter(F.col("event_id") % 2 == k).drop("event_id") for k in (0, 1))
    levels = t.products.filter("product_id % 3 = 0").select("product_id", F.lit(77).alias("stock_quantity"))
    moved = inventory.restock_movements(t.products, earlier, levels)
    return inventory.apply_sales(t.products, earlier.union(moved).union(later)).select("product_id", "category", "stock_quantity")
