"""Registration of named queries with the SQL they are checked against."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, ShortType

from retailpulse.schemas import SEED_RULES
from retailpulse.sources.testbed import Testbed


@dataclass(frozen=True)
class Registered:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines share: BIGINT, DOUBLE, text dates."""
    def plain(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (IntegerType, ShortType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, DateType):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register ``fn(testbed) -> DataFrame`` under ``name``."""
    def register(fn: Callable[[Testbed], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(fn(Testbed(spark, folder)))

        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = Registered(run, None if sql is None else with_views(sql))
        return fn

    return register


_RULES = ", ".join(
    f"('{m}', '{d}', CAST({w} AS DECIMAL(14,4)), CAST({c} AS DECIMAL(14,4)), '{o}', {n})"
    for m, d, w, c, o, n in SEED_RULES
)

# The retail tables in SQL, written from their definitions in FIXTURES.md.
VIEWS: dict[str, str] = {
    "fx_now": "SELECT max(ts) AS as_of FROM events",
    "fx_today": "SELECT max(o_orderdate) AS as_of FROM orders",
    "fx_products": """
SELECT CAST(p_partkey AS INT) AS product_id, p_name AS name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(p_size * 4 AS INT) AS stock_quantity,
       CAST(greatest(floor(p_size * 4 * CAST(0.2 AS DOUBLE)), 10) AS INT) AS reorder_threshold
FROM part""",
    "fx_rated": """
SELECT p.*, CAST(coalesce(rc, 0) AS INT) AS rating_count
FROM fx_products p LEFT JOIN (SELECT l_partkey, count(*) AS rc FROM lineitem GROUP BY l_partkey) r
  ON product_id = l_partkey""",
    "fx_catalog": """
SELECT product_id, name, category, price, rating_count,
       CAST(least(CAST(floor(80 + sqrt(greatest(rating_count, 1)) * 12) AS INT), 600) AS INT) AS stock,
       floor((1 + least(log10(greatest(rating_count, 1) + 1), 3.5)) * 100 + 0.5) / 100 AS weight
FROM fx_rated""",
    "fx_orders": """
SELECT event_id, concat('E', CAST(event_id AS STRING)) AS order_id,
       concat('CUST-', lpad(CAST(user_id AS STRING), 5, '0')) AS customer_id,
       ts AS order_timestamp, CAST(value AS DECIMAL(12,2)) AS total_amount,
       CAST(1 + event_id % 5 AS INT) AS item_count,
       CASE WHEN event_type = 'signup' THEN NULL ELSE upper(event_type) END AS status, event_type,
       CAST(json_extract_string(props, '$.k') AS INT) AS k
FROM events""",
    "fx_order_items": """
SELECT concat('E', CAST(event_id AS STRING)) AS order_id,
       CAST(json_extract_string(props, '$.k') AS INT) AS product_id,
       CAST(1 + event_id % 5 AS INT) AS quantity, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
       ts AS order_timestamp, event_type, event_id
FROM events JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS INT)""",
    "fx_purchases": """
SELECT CAST(json_extract_string(props, '$.k') AS INT) AS product_id,
       CAST(1 + event_id % 5 AS INT) AS quantity, ts AS order_timestamp, event_id
FROM events WHERE event_type = 'purchase'""",
    "fx_sold": "SELECT product_id, CAST(sum(quantity) AS BIGINT) AS qty FROM fx_purchases GROUP BY product_id",
    "fx_stock": """
SELECT p.product_id, name, category, price,
       CAST(greatest(0, stock_quantity - coalesce(qty, 0)) AS INT) AS stock_quantity, reorder_threshold
FROM fx_products p LEFT JOIN fx_sold s ON p.product_id = s.product_id""",
    # The average is taken in whole cents, rounded half up.
    "fx_sales": """
SELECT *, CAST(((2 * CAST(revenue * 100 AS BIGINT) + order_count) // (2 * order_count)) / 100.0
               AS DECIMAL(10,2)) AS avg_order_value
FROM (SELECT date_trunc('minute', order_timestamp) AS window_start,
             date_trunc('minute', order_timestamp) + INTERVAL 1 MINUTE AS window_end,
             CAST(sum(total_amount) AS DECIMAL(14,2)) AS revenue, count(*) AS order_count,
             CAST(sum(item_count) AS BIGINT) AS item_count
      FROM fx_orders GROUP BY 1, 2)""",
    "fx_psm": """
SELECT date_trunc('minute', order_timestamp) AS window_start,
       date_trunc('minute', order_timestamp) + INTERVAL 1 MINUTE AS window_end, product_id,
       CAST(sum(quantity) AS BIGINT) AS units_sold, CAST(sum(quantity * unit_price) AS DECIMAL(12,2)) AS revenue
FROM fx_order_items GROUP BY 1, 2, 3""",
    "fx_alerts": """
SELECT event_id AS alert_id,
       CASE event_type WHEN 'error' THEN 'LOW_STOCK' WHEN 'signup' THEN 'REVENUE_SPIKE'
            ELSE 'KPI_VIOLATION' END AS alert_type,
       CASE WHEN value >= 100 THEN 'CRITICAL' WHEN value >= 50 THEN 'HIGH' ELSE 'WARNING' END AS severity,
       CASE event_type WHEN 'error' THEN 'PRODUCT' WHEN 'signup' THEN 'WINDOW' ELSE 'KPI' END AS entity_type,
       CASE event_type WHEN 'error' THEN json_extract_string(props, '$.k')
            WHEN 'signup' THEN CAST(date_trunc('minute', ts) AS STRING)
            ELSE CASE event_id % 5 WHEN 0 THEN 'revenue_per_5min' WHEN 1 THEN 'orders_per_5min'
                 WHEN 2 THEN 'low_stock_count' WHEN 3 THEN 'avg_order_value' ELSE 'revenue_drop_pct' END
            END AS entity_id,
       'event ' || event_id || ' of user ' || user_id AS message,
       CAST(value AS DECIMAL(14,4)) AS detected_value,
       CASE WHEN event_type = 'signup' THEN CAST(CAST(json_extract_string(props, '$.k') AS INT) AS DECIMAL(14,4)) END AS expected_low,
       CASE WHEN event_type = 'signup' THEN CAST(2 * CAST(json_extract_string(props, '$.k') AS INT) AS DECIMAL(14,4)) END AS expected_high,
       ts AS detected_at, event_id % 3 = 0 AS resolved
FROM events WHERE event_type IN ('error', 'signup', 'click')""",
    "fx_resolutions": """
SELECT event_id AS alert_id, ts + INTERVAL 5 MINUTE AS resolved_at FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, ts + INTERVAL 9 MINUTE FROM events WHERE event_id % 4 = 0""",
    "fx_alert_states": """
SELECT a.* REPLACE (resolved OR first_at IS NOT NULL AS resolved), first_at AS resolved_at
FROM fx_alerts a LEFT JOIN (SELECT alert_id, min(resolved_at) AS first_at FROM fx_resolutions GROUP BY alert_id) r ON a.alert_id = r.alert_id""",
    "fx_lines": """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS INT) AS product_id,
       CAST(l_quantity AS INT) AS quantity,
       CAST(floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS DECIMAL(10,2)) AS unit_price
FROM lineitem""",
    "fx_heads": """
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
       o_orderdate AS order_timestamp, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
       o_orderstatus AS status
FROM orders""",
    "fx_carts": "SELECT CAST(l_orderkey AS STRING) AS cart_id, count(*) AS n_items FROM lineitem GROUP BY l_orderkey",
    "fx_rules": f"""
SELECT * FROM (VALUES {_RULES}) AS t(metric_name, description, warning_threshold, critical_threshold,
                                     comparison_operator, window_minutes)""",
    "fx_metric_values": """
SELECT 'revenue_per_5min' AS metric_name, CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS value
  FROM fx_sales WHERE window_start >= (SELECT as_of FROM fx_now) - INTERVAL 5 MINUTE
UNION ALL
SELECT 'orders_per_5min', CAST(coalesce(sum(order_count), 0) AS DOUBLE)
  FROM fx_sales WHERE window_start >= (SELECT as_of FROM fx_now) - INTERVAL 5 MINUTE
UNION ALL
SELECT 'low_stock_count', CAST(count(*) AS DOUBLE) FROM fx_stock WHERE stock_quantity <= reorder_threshold
UNION ALL
SELECT 'avg_order_value',
       coalesce(CAST(sum(avg_order_value) AS DOUBLE) / CAST(nullif(count(*), 0) AS DOUBLE), 0)
  FROM fx_sales WHERE window_start >= (SELECT as_of FROM fx_now) - INTERVAL 5 MINUTE
UNION ALL
SELECT 'revenue_drop_pct', CASE WHEN p <= 0 THEN 0 ELSE greatest((p - c) / p * 100, 0) END
  FROM (SELECT CAST(coalesce(sum(revenue) FILTER (window_start < as_of - INTERVAL 5 MINUTE), 0) AS DOUBLE) AS p,
               CAST(coalesce(sum(revenue) FILTER (window_start >= as_of - INTERVAL 5 MINUTE), 0) AS DOUBLE) AS c
        FROM fx_sales, fx_now WHERE window_start >= as_of - INTERVAL 10 MINUTE)""",
    "fx_zscore": """
SELECT *, CASE WHEN n_history >= 4 AND std_revenue > 0 THEN (revenue - mean_revenue) / std_revenue END AS z
FROM (SELECT window_start, CAST(revenue AS DOUBLE) AS revenue, order_count,
             count(*) OVER w AS n_history, CAST(sum(revenue) OVER w AS DOUBLE) / nullif(count(*) OVER w, 0) AS mean_revenue,
             stddev_pop(CAST(revenue AS DOUBLE)) OVER w AS std_revenue
      FROM fx_sales
      WINDOW w AS (ORDER BY window_start RANGE BETWEEN INTERVAL 29 MINUTE PRECEDING AND INTERVAL 1 MINUTE PRECEDING))""",
}


def with_views(body: str) -> str:
    """Prefix ``body`` with the views it uses, in order of dependency."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bfx_\w+", text)):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    recursive = "RECURSIVE " if "chain_" in body else ""
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {recursive}{views},\n{body[5:]}"
    return f"WITH {recursive}{views}\n{body}"
