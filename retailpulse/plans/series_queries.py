"""Registered queries: series, rankings, streams as batch, detection, rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailpulse.functions.clock import before
from retailpulse.functions.labels import breaches
from retailpulse.functions.numbers import round_half_up
from retailpulse.operators import alerts as al
from retailpulse.operators import anomaly, calendar, cooldown, inventory, kpi, metrics, series, shape, sketches, star
from retailpulse.plans.registry import query


def _rounded(df, digits, *names):
    return df.withColumns({name: round_half_up(F.col(name), digits) for name in names})


# --- windows -------------------------------------------------------------------

@query("w1_trailing_zscore", """
SELECT window_start, revenue, n_history, floor(mean_revenue * 1000 + 0.5) / 1000 AS mean_revenue,
       floor(std_revenue * 1000 + 0.5) / 1000 AS std_revenue, floor(z * 1000 + 0.5) / 1000 AS z
FROM fx_zscore""")
def _(t):
    scored = series.trailing_zscore(t.sales_metrics, [])
    return _rounded(scored, 3, "mean_revenue", "std_revenue", "z").select(
        "window_start", "revenue", "n_history", "mean_revenue", "std_revenue", "z"
    )


@query("w2_window_over_window", """
WITH bins AS (SELECT time_bucket(INTERVAL 60 MINUTE, window_start) AS bin_start, sum(revenue) AS revenue
              FROM fx_sales GROUP BY 1),
     calendar AS (SELECT unnest(generate_series((SELECT min(bin_start) FROM bins),
                                                (SELECT max(bin_start) + INTERVAL 60 MINUTE FROM bins),
                                                INTERVAL 60 MINUTE)) AS bin_start),
     filled AS (SELECT c.bin_start, CAST(coalesce(revenue, 0) AS DOUBLE) AS revenue
                FROM calendar c LEFT JOIN bins b ON c.bin_start = b.bin_start),
     lagged AS (SELECT *, coalesce(lag(revenue) OVER (ORDER BY bin_start), 0) AS prior_revenue FROM filled)
SELECT bin_start, revenue, prior_revenue,
       CASE WHEN prior_revenue <= 0 THEN 0
            ELSE floor(greatest((prior_revenue - revenue) / prior_revenue * 100, 0) * 10000 + 0.5) / 10000 END AS drop_pct
FROM lagged WHERE revenue > 0 OR prior_revenue > 0""")
def _(t):
    return _rounded(series.window_over_window(t.sales_metrics, 60), 4, "drop_pct")


@query("w3_running_stock", """
SELECT event_id, CAST(s.product_id AS BIGINT) AS product_id,
       CAST(greatest(0, stock_quantity - sum(quantity) OVER (PARTITION BY s.product_id
            ORDER BY order_timestamp, event_id ROWS UNBOUNDED PRECEDING)) AS BIGINT) AS stock_after
FROM fx_purchases s JOIN fx_products p ON s.product_id = p.product_id""")
def _(t):
    return inventory.running_stock(t.products, t.purchases, "order_timestamp", "event_id").select(
        "event_id", "product_id", "stock_after"
    )


@query("w4_latest_row", """
SELECT day, window_start, CAST(revenue AS DOUBLE) AS revenue, order_count
FROM (SELECT *, date_trunc('day', window_start) AS day,
             row_number() OVER (PARTITION BY date_trunc('day', window_start) ORDER BY window_start DESC) AS n
      FROM fx_sales) WHERE n = 1""")
def _(t):
    days = t.sales_metrics.withColumn("day", F.date_trunc("day", "window_start"))
    return series.latest_row(days, "window_start", ["window_start", "revenue", "order_count"], "day")


@query("w5_rolling_sales", """
SELECT window_start, CAST(sum(revenue) OVER five AS DOUBLE) AS revenue_5m, CAST(sum(revenue) OVER hour AS DOUBLE) AS revenue_1h,
       CAST(sum(order_count) OVER five AS BIGINT) AS orders_5m, CAST(sum(order_count) OVER hour AS BIGINT) AS orders_1h
FROM fx_sales
WINDOW five AS (ORDER BY window_start RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW),
       hour AS (ORDER BY window_start RANGE BETWEEN INTERVAL 59 MINUTE PRECEDING AND CURRENT ROW)""")
def _(t):
    return series.rolling_sales(t.sales_metrics).select(
        "window_start", "revenue_5m", "revenue_1h", "orders_5m", "orders_1h"
    )


@query("w6_reference_lines", """
SELECT day, CAST(revenue AS DOUBLE) AS revenue,
       floor(CAST(sum(revenue) OVER () AS DOUBLE) / count(*) OVER () * 10000 + 0.5) / 10000 AS avg_revenue,
       CAST(min(revenue) OVER () AS DOUBLE) AS min_revenue, CAST(max(revenue) OVER () AS DOUBLE) AS max_revenue
FROM (SELECT date_trunc('day', order_timestamp) AS day, sum(total_amount) AS revenue FROM fx_orders GROUP BY 1)""")
def _(t):
    daily = t.orders.groupBy(F.date_trunc("day", "order_timestamp").alias("day")).agg(
        F.sum("total_amount").alias("revenue")
    )
    return _rounded(series.with_reference_lines(daily), 4, "avg_revenue")


@query("w7_alert_value_change", """
SELECT alert_id, entity_id, CAST(detected_value AS DOUBLE) AS detected_value,
       CAST(detected_value - lag(detected_value) OVER (PARTITION BY alert_type, entity_id ORDER BY detected_at, alert_id) AS DOUBLE) AS change
FROM fx_alerts""")
def _(t):
    return al.value_change(t.alerts).select("alert_id", "entity_id", "detected_value", "change")


# --- sorts and rankings --------------------------------------------------------

@query("o1_ordered_history", """
SELECT window_start, CAST(revenue AS DOUBLE) AS revenue, order_count FROM fx_sales ORDER BY window_start""")
def _(t):
    return t.sales_metrics.select("window_start", "revenue", "order_count").orderBy("window_start")


_TOP = """
SELECT CAST(l.product_id AS BIGINT) AS product_id, name, CAST(sum(quantity) AS BIGINT) AS units_sold
FROM fx_lines l JOIN fx_products p ON l.product_id = p.product_id
GROUP BY l.product_id, name ORDER BY units_sold DESC, product_id LIMIT 10"""


@query("o2_top_sellers", _TOP)
def _(t):
    return star.top_sellers(t.lines, t.products)


_FEED = """
SELECT alert_id, detected_at, severity, alert_type, entity_id, message,
       CASE severity WHEN 'CRITICAL' THEN '#C0392B' WHEN 'HIGH' THEN '#E67E22' WHEN 'WARNING' THEN '#F1C40F'
            ELSE '#BDC3C7' END AS color
FROM fx_alerts WHERE NOT resolved ORDER BY detected_at DESC, alert_id DESC LIMIT 15"""


@query("o3_alert_feed", _FEED)
def _(t):
    return al.alert_feed(t.alerts)


_LOG = """
SELECT alert_id, alert_type, severity, entity_type, entity_id, message, CAST(detected_value AS DOUBLE) AS detected_value,
       CAST(expected_low AS DOUBLE) AS expected_low, CAST(expected_high AS DOUBLE) AS expected_high, detected_at, resolved,
       CASE severity WHEN 'CRITICAL' THEN '#C0392B' WHEN 'HIGH' THEN '#E67E22' WHEN 'WARNING' THEN '#F1C40F'
            ELSE '#BDC3C7' END AS color
FROM fx_alerts"""


@query("o4_alert_log", _LOG)
def _(t):
    return al.alert_log(t.alerts)


_VELOCITY = """
SELECT CAST(product_id AS BIGINT) AS product_id, CAST(sum(units_sold) AS BIGINT) AS units_sold
FROM fx_psm WHERE window_start >= (SELECT as_of FROM fx_now) - INTERVAL 60 MINUTE GROUP BY product_id"""


@query("o5_depletion_velocity", _VELOCITY)
def velocity(t):
    recent = t.order_items.filter(F.col("order_timestamp") >= before(t.now, 60))
    return inventory.depletion_velocity(metrics.product_minute_sales(recent), t.now)


_REORDER = """
SELECT CAST(product_id AS BIGINT) AS product_id, name, CAST(stock_quantity AS BIGINT) AS stock_quantity,
       CAST(reorder_threshold AS BIGINT) AS reorder_threshold,
       CAST(reorder_threshold * 3 - stock_quantity AS BIGINT) AS suggested_order_qty
FROM fx_stock WHERE stock_quantity <= reorder_threshold"""


@query("o6_reorder_suggestions", _REORDER)
def _(t):
    return inventory.reorder_suggestions(t.stock)


# --- date dimension --------------------------------------------------------------

@query("f1_date_dimension", """
SELECT CAST(d AS STRING) AS date, year(d) AS year, strftime(d, '%b %Y') AS month, year(d) * 100 + month(d) AS month_num,
       day(d) AS day, strftime(d, '%a') AS weekday
FROM (SELECT CAST(unnest(generate_series(make_date(year(as_of) - 1, 1, 1), CAST(as_of AS DATE) + 30, INTERVAL 1 DAY)) AS DATE) AS d
      FROM fx_now)""")
def _(t):
    return calendar.date_dimension(t.spark, t.now)


# --- operators of the stream, over stored events ---------------------------------

@query("t2_tumbling_window", """
SELECT date_trunc('minute', ts) AS window_start, event_type, count(*) AS events
FROM events GROUP BY 1, 2""")
def _(t):
    counts = t.events.groupBy(F.window("ts", "1 minute").alias("w"), "event_type").agg(F.count("*").alias("events"))
    return counts.select(F.col("w.start").alias("window_start"), "event_type", "events")


def _chain(condition: str, keys: list[str], minutes: int) -> str:
    """The cooldown as a recursive walk from each emitted alert to the next."""
    own = ", ".join(keys)
    same = " AND ".join(f"c.{k} = a.{k}" for k in keys)
    grouped = ", ".join(f"c.{k}" for k in keys)
    return f"""
WITH chain_alerts AS (SELECT * FROM fx_alerts WHERE {condition}),
     chain_walk AS (
       SELECT {own}, min(detected_at) AS detected_at FROM chain_alerts GROUP BY {own}
       UNION ALL
       SELECT {grouped}, min(a.detected_at) FROM chain_walk c JOIN chain_alerts a
         ON {same} AND a.detected_at >= c.detected_at + INTERVAL {minutes} MINUTE
       GROUP BY {grouped}, c.detected_at)
SELECT {own}, detected_at FROM chain_walk"""


@query("t10_alert_cooldown", _chain("alert_type = 'KPI_VIOLATION'", ["entity_id", "severity"], 30))
def _(t):
    kpi_alerts = t.alerts.filter(F.col("alert_type") == "KPI_VIOLATION")
    kept = cooldown.suppress_repeats(kpi_alerts, ["entity_id", "severity"], "detected_at", 30, "alert_id")
    return kept.select("entity_id", "severity", "detected_at")


@query("t10_alert_cooldown_by_type", _chain("true", ["alert_type"], 10))
def _(t):
    kept = cooldown.suppress_repeats(t.alerts, ["alert_type"], "detected_at", 10, "alert_id")
    return kept.select("alert_type", "detected_at")


@query("t11_ingestion_lag", """
SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n_events,
       floor(avg(epoch_ms(l_shipdate) - epoch_ms(o_orderdate)) * 1000 + 0.5) / 1000 AS avg_lag_ms,
       max(epoch_ms(l_shipdate) - epoch_ms(o_orderdate)) AS max_lag_ms,
       quantile_disc(epoch_ms(l_shipdate) - epoch_ms(o_orderdate), 0.95) AS p95_lag_ms
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(t):
    ordered = t.raw("orders").select("o_orderkey", "o_orderdate")
    shipped = t.raw("lineitem").select("l_orderkey", "l_shipdate")
    joined = shipped.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    lag = metrics.ingestion_lag(
        joined, "o_orderdate", "l_shipdate", F.date_trunc("month", "o_orderdate").alias("month")
    )
    return _rounded(lag, 3, "avg_lag_ms")


def _minute_sketches(t):
    """Orders of the events; the lag of an event is its product number in seconds, spread within the second."""
    arrived = F.col("ts") + F.make_dt_interval(secs=F.get_json_object("props", "$.k").cast("decimal(18,6)") + F.col("event_id") % 1000 / 1000)
    rows = t.events.select(F.concat(F.lit("C"), "user_id").alias("order_id"), "ts", arrived.alias("arrived_at"))
    return rows, sketches.order_sketches(rows, "ts", "arrived_at", F.window("ts", "1 hour"))


@query("a7_distinct_from_sketches", """
SELECT date_trunc('day', ts) AS day, count(DISTINCT user_id) AS exact, true AS within_three_errors FROM events GROUP BY 1""")
def _(t):
    """Distinct ids per day, read off the merged sketches of its hours, beside the exact number."""
    rows, found = _minute_sketches(t)
    day = F.date_trunc("day", "window_start").alias("day")
    estimated = sketches.merged(found, day).select("day", sketches.order_count().alias("estimate"))
    exact = rows.groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.count_distinct("order_id").alias("exact"))
    off = F.abs(F.col("estimate") - F.col("exact"))
    return estimated.join(exact, "day").select("day", "exact", (off <= 1 + 3 * sketches.DISTINCT_ERROR * F.col("exact")).alias("within_three_errors"))


@query("t11_lag_from_sketches", """
SELECT date_trunc('day', ts) AS day, count(*) AS n_events, true AS within_rank_error FROM events GROUP BY 1""")
def _(t):
    """Lag quantiles per day from the sketches of its hours; their ranks are counted in the rows."""
    rows, found = _minute_sketches(t)
    days = sketches.lag_summary(found, F.date_trunc("day", "window_start").alias("day"))
    lag = F.unix_millis("arrived_at") - F.unix_millis("ts")
    shares = {"p50_lag_ms": 0.5, "p95_lag_ms": 0.95, "p99_lag_ms": 0.99}
    lags = rows.select(F.date_trunc("day", "ts").alias("day"), lag.alias("lag")).join(days, "day")
    ranks = lags.groupBy("day", "n_events").agg(
        *[F.count_if(F.col("lag") < F.col(c)).alias(f"low_{c}") for c in shares], *[F.count_if(F.col("lag") <= F.col(c)).alias(f"high_{c}") for c in shares]
    )
    # An answer is right if some rank of its value is near enough.
    slack = F.lit(2 * sketches.RANK_ERROR) * F.col("n_events") + 1
    near = [(F.col(f"low_{c}") <= s * F.col("n_events") + slack) & (F.col(f"high_{c}") >= s * F.col("n_events") - slack) for c, s in shares.items()]
    return ranks.select("day", "n_events", (near[0] & near[1] & near[2]).alias("within_rank_error"))


# --- anomaly detection -----------------------------------------------------------

_ZFRAME = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY window_start DESC) AS n FROM framed),
stats AS (SELECT frame, count(*) AS n_rows, max(window_start) AS window_start,
                 max(CAST(revenue AS DOUBLE)) FILTER (n = 1) AS revenue,
                 CAST(sum(revenue) FILTER (n > 1) AS DOUBLE) / nullif(count(*) FILTER (n > 1), 0) AS mean_revenue,
                 stddev_pop(CAST(revenue AS DOUBLE)) FILTER (n > 1) AS std_revenue FROM ranked GROUP BY frame),
judged AS (SELECT *, CASE WHEN n_rows >= 5 AND std_revenue > 0 THEN (revenue - mean_revenue) / std_revenue END AS z FROM stats)"""


@query("d1_zscore_spike", f"""
WITH framed AS (SELECT 1 AS frame, * FROM fx_sales WHERE window_start >= (SELECT as_of FROM fx_now) - INTERVAL 30 MINUTE),
{_ZFRAME}
SELECT n_rows, window_start, revenue, floor(mean_revenue * 1000 + 0.5) / 1000 AS mean_revenue,
       floor(std_revenue * 1000 + 0.5) / 1000 AS std_revenue, floor(z * 1000 + 0.5) / 1000 AS z,
       CASE WHEN z >= 5 THEN 'CRITICAL' WHEN z >= 3 THEN 'HIGH' END AS severity
FROM judged""")
def _(t):
    shown = metrics.recent_minute_sales(t.orders, t.now, 30).withColumn("series", F.lit("all"))
    judged = anomaly.zscore_by_frame(shown, ["series"])
    return _rounded(judged, 3, "mean_revenue", "std_revenue", "z").drop("series")


@query("d1_zscore_spike_hourly", f"""
WITH framed AS (SELECT date_trunc('hour', window_start) AS frame, * FROM fx_sales),
{_ZFRAME}
SELECT frame, n_rows, window_start, revenue, floor(z * 1000 + 0.5) / 1000 AS z,
       CASE WHEN z >= 5 THEN 'CRITICAL' WHEN z >= 3 THEN 'HIGH' END AS severity
FROM judged""")
def _(t):
    framed = t.sales_metrics.withColumn("frame", F.date_trunc("hour", "window_start"))
    judged = anomaly.zscore_by_frame(framed, ["frame"])
    return _rounded(judged, 3, "z").select("frame", "n_rows", "window_start", "revenue", "z", "severity")


# A forest is random by design; only its rows are checked here, its behaviour in tests.
@query("d2_isolation_forest_daily")
def _(t):
    framed = t.sales_metrics.withColumn("day", F.date_trunc("day", "window_start"))
    return anomaly.forest_by_frame(framed, ["day"])


@query("d2_forest_frames", """
SELECT date_trunc('day', window_start) AS day, count(*) AS n_rows, max(window_start) AS window_start,
       CAST(arg_max(revenue, window_start) AS DOUBLE) AS revenue,
       floor(avg(CAST(revenue AS DOUBLE)) * 100 + 0.5) / 100 AS mean_revenue,
       floor(stddev_pop(CAST(revenue AS DOUBLE)) * 100 + 0.5) / 100 AS std_revenue,
       floor(median(CAST(revenue AS DOUBLE)) * 100 + 0.5) / 100 AS median_revenue, TRUE AS share_holds
FROM fx_sales GROUP BY 1""")
def _(t):
    """What of the forest's verdict is not random: the frame, its latest minute, and at most the asked share of odd minutes."""
    framed = t.sales_metrics.withColumn("day", F.date_trunc("day", "window_start"))
    judged = anomaly.forest_by_frame(framed, ["day"])
    share_holds = F.col("n_outliers") <= F.col("n_rows") * anomaly.DEFAULT.contamination + 1
    return _rounded(judged, 2, "mean_revenue", "std_revenue", "median_revenue").select(
        "day", "n_rows", "window_start", "revenue", "mean_revenue", "std_revenue", "median_revenue", share_holds.alias("share_holds")
    )


@query("d3_cold_start_switch", f"""
WITH framed AS (SELECT date_trunc('hour', window_start) AS frame, * FROM fx_sales),
{_ZFRAME}
SELECT frame, n_rows, CASE WHEN n_rows >= 15 THEN 'isolation_forest' WHEN n_rows >= 5 THEN 'zscore' ELSE 'none' END AS method,
       CASE WHEN n_rows < 15 THEN floor(z * 1000 + 0.5) / 1000 END AS z
FROM judged""")
def _(t):
    framed = t.sales_metrics.withColumn("frame", F.date_trunc("hour", "window_start"))
    scores = anomaly.zscore_by_frame(framed, ["frame"])
    cold = F.when(F.col("n_rows") < 15, round_half_up(F.col("z"), 3))
    return scores.select("frame", "n_rows", anomaly.method_for(F.col("n_rows")).alias("method"), cold.alias("z"))


@query("d4_spike_alerts", """
SELECT 'REVENUE_SPIKE' AS alert_type, CASE WHEN z >= 5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
       CAST(window_start AS STRING) AS entity_id,
       format('Revenue spike via z-score z={:.2f}: ${:.2f} at {} (expected ${:.2f}-${:.2f})', z, revenue,
              CAST(window_start AS STRING), greatest(0, mean_revenue - 3 * std_revenue), mean_revenue + 3 * std_revenue) AS message,
       revenue AS detected_value
FROM fx_zscore WHERE z >= 3""")
def _(t):
    scored = series.trailing_zscore(t.sales_metrics, [])
    severity = F.when(F.col("z") >= 5, "CRITICAL").when(F.col("z") >= 3, "HIGH")
    spikes = anomaly.zscore_spikes(scored.withColumn("severity", severity).withColumn("revenue", F.col("revenue").cast("double")))
    return anomaly.spike_alerts(spikes, t.now).select(
        "alert_type", "severity", "entity_id", "message", "detected_value"
    )


# --- KPI rules -----------------------------------------------------------------------

def _values(t, rules, names=None):
    recent = metrics.recent_minute_sales(t.orders, t.now, kpi.lookback_minutes(rules))
    return kpi.metric_values(recent, t.stock, rules, t.now, names)


def _judged(t, rules=None):
    rules = t.rules if rules is None else rules
    return kpi.judge(_values(t, rules), rules)


def _metric(name):
    sql = f"SELECT metric_name, floor(value * 10000 + 0.5) / 10000 AS value FROM fx_metric_values WHERE metric_name = '{name}'"

    def run(t):
        return _rounded(_values(t, t.rules, [name]), 4, "value")

    return sql, run


for _key, _name in {
    "k1_revenue_per_5min": "revenue_per_5min",
    "k2_orders_per_5min": "orders_per_5min",
    "k3_low_stock_count": "low_stock_count",
    "k4_avg_order_value": "avg_order_value",
    "k5_revenue_drop_pct": "revenue_drop_pct",
}.items():
    _sql, _run = _metric(_name)
    query(_key, _sql)(_run)


@query("k6_unknown_metric", """
SELECT metric_name, CAST(window_minutes AS BIGINT) AS window_minutes
FROM (SELECT metric_name, window_minutes FROM fx_rules UNION ALL SELECT 'not_a_metric', 5)
JOIN fx_metric_values USING (metric_name)""")
def _(t):
    odd = t.rules.filter(F.col("metric_name") == "revenue_per_5min").withColumn("metric_name", F.lit("not_a_metric"))
    return _judged(t, t.rules.unionByName(odd)).select("metric_name", "window_minutes")


_OPERATORS = ["<", "<=", ">", ">=", "==", "!"]


@query("k7_breach_test", """
SELECT window_start, op AS operator,
       CASE op WHEN '<' THEN v < 50 WHEN '<=' THEN v <= 50 WHEN '>' THEN v > 50 WHEN '>=' THEN v >= 50
               WHEN '==' THEN v = 50 ELSE false END AS breached
FROM (SELECT window_start, CAST(revenue AS DOUBLE) AS v, unnest(['<', '<=', '>', '>=', '==', '!']) AS op FROM fx_sales)""")
def _(t):
    tested = t.sales_metrics.select(
        "window_start", F.col("revenue").cast("double").alias("v"),
        F.explode(F.array(*[F.lit(o) for o in _OPERATORS])).alias("operator"),
    )
    return tested.select(
        "window_start", "operator", breaches(F.col("v"), F.lit(50.0), F.col("operator")).alias("breached")
    )


def _hit(threshold):
    return (f"CASE op WHEN '<' THEN value < {threshold} WHEN '<=' THEN value <= {threshold} "
            f"WHEN '>' THEN value > {threshold} WHEN '>=' THEN value >= {threshold} ELSE value = {threshold} END")


@query("k8_rule_severity", f"""
SELECT window_start, metric_name, op AS comparison_operator,
       CASE WHEN {_hit("critical")} THEN 'CRITICAL' WHEN {_hit("warning")} THEN 'WARNING' END AS severity,
       CASE WHEN {_hit("critical")} THEN critical WHEN {_hit("warning")} THEN warning END AS threshold_used
FROM (SELECT window_start, 'revenue_per_5min' AS metric_name, CAST(revenue AS DOUBLE) AS value FROM fx_sales
      UNION ALL SELECT window_start, 'orders_per_5min', order_count FROM fx_sales
      UNION ALL SELECT window_start, 'avg_order_value', CAST(avg_order_value AS DOUBLE) FROM fx_sales)
JOIN (SELECT metric_name, CAST(critical_threshold AS DOUBLE) AS critical, CAST(warning_threshold AS DOUBLE) AS warning,
             unnest(['<', '<=', '>', '>=', '==']) AS op FROM fx_rules) USING (metric_name)""")
def _(t):
    operators = F.explode(F.array(*[F.lit(o) for o in ("<", "<=", ">", ">=", "==")]))
    judged = kpi.judge(kpi.minute_metric_values(t.sales_metrics), t.rules.withColumn("comparison_operator", operators))
    return judged.select("window_start", "metric_name", "comparison_operator", "severity", "threshold_used")


_VIOLATIONS = """
violations AS (
  SELECT metric_name, description, comparison_operator AS op, value, severity,
         CASE severity WHEN 'CRITICAL' THEN critical_threshold ELSE warning_threshold END AS used
  FROM (SELECT *, CASE WHEN CASE comparison_operator WHEN '<' THEN value < critical_threshold ELSE value > critical_threshold END THEN 'CRITICAL'
                       WHEN CASE comparison_operator WHEN '<' THEN value < warning_threshold ELSE value > warning_threshold END THEN 'WARNING'
                  END AS severity
        FROM fx_metric_values JOIN (SELECT metric_name, description, comparison_operator, window_minutes,
                                           CAST(warning_threshold AS DOUBLE) AS warning_threshold,
                                           CAST(critical_threshold AS DOUBLE) AS critical_threshold FROM fx_rules)
          USING (metric_name))
  WHERE severity IS NOT NULL)"""


@query("k9_violation_alerts", f"""
WITH {_VIOLATIONS.strip()}
SELECT 'KPI_VIOLATION' AS alert_type, severity, metric_name AS entity_id,
       trim(format('KPI {{}} {{}} {{}}: observed {{:.2f}}. {{}}', metric_name, op, CAST(used AS STRING), value, description)) AS message,
       CAST(CAST(value AS DECIMAL(14,4)) AS DOUBLE) AS detected_value, used AS expected_high
FROM violations v
WHERE NOT EXISTS (SELECT 1 FROM fx_alerts a WHERE a.alert_type = 'KPI_VIOLATION' AND a.entity_id = v.metric_name
                  AND a.severity = v.severity AND a.detected_at > (SELECT as_of FROM fx_now) - INTERVAL 5 MINUTE)""")
def _(t):
    raised = al.suppress_recent(kpi.violation_alerts(_judged(t), t.now), t.alerts, al.KPI_KEY, t.now, 5)
    return raised.select("alert_type", "severity", "entity_id", "message", "detected_value", "expected_high")


@query("k10_low_stock_alerts", """
SELECT CASE WHEN stock_quantity = 0 THEN 'CRITICAL' WHEN stock_quantity <= reorder_threshold / 2.0 THEN 'HIGH'
            ELSE 'WARNING' END AS severity, CAST(product_id AS STRING) AS entity_id,
       concat('Low stock: ', name, ' (', stock_quantity, ' <= ', reorder_threshold, ')') AS message,
       CAST(stock_quantity AS DOUBLE) AS detected_value, CAST(0 AS DOUBLE) AS expected_low,
       CAST(reorder_threshold AS DOUBLE) AS expected_high
FROM fx_stock p WHERE stock_quantity <= reorder_threshold
  AND NOT EXISTS (SELECT 1 FROM fx_alerts a WHERE a.alert_type = 'LOW_STOCK'
                  AND a.entity_id = CAST(p.product_id AS STRING)
                  AND a.detected_at > (SELECT as_of FROM fx_now) - INTERVAL 10 MINUTE)""")
def _(t):
    raised = al.suppress_recent(
        inventory.low_stock_alerts(t.stock, t.now), t.alerts, al.LOW_STOCK_KEY, t.now, 10
    )
    return raised.select("severity", "entity_id", "message", "detected_value", "expected_low", "expected_high")


@query("u1_alert_union", f"""
WITH framed AS (SELECT 1 AS frame, * FROM fx_sales WHERE window_start >= (SELECT as_of FROM fx_now) - INTERVAL 30 MINUTE),
{_ZFRAME},
{_VIOLATIONS.strip()}
SELECT 'LOW_STOCK' AS alert_type,
       CASE WHEN stock_quantity = 0 THEN 'CRITICAL' WHEN stock_quantity <= reorder_threshold / 2.0 THEN 'HIGH'
            ELSE 'WARNING' END AS severity, 'PRODUCT' AS entity_type, CAST(product_id AS STRING) AS entity_id,
       CAST(stock_quantity AS DOUBLE) AS detected_value, as_of AS detected_at, false AS resolved
FROM fx_stock, fx_now WHERE stock_quantity <= reorder_threshold
UNION ALL
SELECT 'KPI_VIOLATION', severity, 'KPI', metric_name, CAST(CAST(value AS DECIMAL(14,4)) AS DOUBLE), as_of, false FROM violations, fx_now
UNION ALL
SELECT 'REVENUE_SPIKE', CASE WHEN z >= 5 THEN 'CRITICAL' ELSE 'HIGH' END, 'WINDOW', CAST(window_start AS STRING), revenue, as_of, false
FROM judged, fx_now WHERE z >= 3""")
def _(t):
    shown = metrics.recent_minute_sales(t.orders, t.now, 30).withColumn("series", F.lit("all"))
    spikes = anomaly.zscore_spikes(anomaly.zscore_by_frame(shown, ["series"]))
    return al.unify(
        inventory.low_stock_alerts(t.stock, t.now),
        kpi.violation_alerts(_judged(t), t.now),
        anomaly.spike_alerts(spikes, t.now),
    ).select("alert_type", "severity", "entity_type", "entity_id", "detected_value", "detected_at", "resolved")
