"""Edge cases of thresholds, detectors and cooldowns."""

import pytest
from pyspark.sql import functions as F

from conftest import at, money, product_frame, rows, sales_frame
from retailpulse.config import AnomalyParams
from retailpulse.functions.labels import stock_health, stock_row_color
from retailpulse.operators import alerts as al
from retailpulse.operators import anomaly, kpi
from retailpulse.operators.inventory import low_stock_alerts, stock_histogram

RULE_DDL = (
    "metric_name string, description string, warning_threshold decimal(14,4), critical_threshold decimal(14,4), "
    "comparison_operator string, window_minutes int, enabled boolean"
)


def rules_frame(spark, *rules):
    data = [
        (m, d, None if w is None else money(w), None if c is None else money(c), o, n, e)
        for m, d, w, c, o, n, e in rules
    ]
    return spark.createDataFrame(data, RULE_DDL)


def judged(spark, value, *rules):
    values = spark.createDataFrame([("m", float(value))], "metric_name string, value double")
    return kpi.judge(values, rules_frame(spark, *rules)).collect()


@pytest.mark.parametrize(
    "operator,value,severity",
    [
        ("<", 49, "CRITICAL"), ("<", 50, "WARNING"), ("<", 200, None), ("<=", 200, "WARNING"),
        ("==", 50, "CRITICAL"), ("==", 51, None), ("!", 10, None),
    ],
)
def test_breach_operators(spark, operator, value, severity):
    (row,) = judged(spark, value, ("m", "", 200, 50, operator, 5, True))
    assert row.severity == severity


def test_missing_thresholds_and_disabled_rules(spark):
    (row,) = judged(spark, 10, ("m", None, 200, None, "<", 5, True))
    assert (row.severity, row.threshold_used) == ("WARNING", 200.0)
    (row,) = judged(spark, 10, ("m", None, None, None, "<", 5, True))
    assert row.severity is None
    assert judged(spark, 10, ("m", None, 200, 50, "<", 5, False)) == []
    assert judged(spark, 10, ("other", None, 200, 50, "<", 5, True)) == []


def test_metric_values_follow_the_rule_windows(spark):
    sales = sales_frame(spark, [(0, 100, 1), (4, 10, 1), (6, 20, 2), (9, 30, 1)])
    products = product_frame(spark, [(1, 0, 10), (2, 10, 10), (3, 11, 10)])
    rules = rules_frame(
        spark,
        ("revenue_per_5min", "", 1, 1, "<", 4, True),
        ("orders_per_5min", "", 1, 1, "<", 5, True),
        ("low_stock_count", "", 1, 1, ">", 1, True),
        ("avg_order_value", "", 1, 1, "<", 5, True),
        ("revenue_drop_pct", "", 1, 1, ">", 5, True),
    )
    values = dict(rows(kpi.metric_values(sales, products, rules, at(10))))
    assert values["revenue_per_5min"] == 50
    assert values["orders_per_5min"] == 3
    assert values["low_stock_count"] == 2
    assert values["avg_order_value"] == 20  # unweighted mean of 10.00 and 30.00
    assert values["revenue_drop_pct"] == pytest.approx((110 - 50) / 110 * 100)


def test_no_prior_revenue_is_no_drop(spark):
    sales = sales_frame(spark, [(9, 30, 1)])
    rules = rules_frame(spark, ("revenue_drop_pct", "", 1, 1, ">", 5, True))
    values = dict(rows(kpi.metric_values(sales, product_frame(spark, [(1, 5, 1)]), rules, at(10))))
    assert values["revenue_drop_pct"] == 0
    empty = dict(rows(kpi.metric_values(sales.filter("false"), product_frame(spark, [(1, 5, 1)]), rules, at(10))))
    assert empty["avg_order_value"] == 0


def test_violation_text(spark):
    judged_frame = kpi.judge(
        spark.createDataFrame([("m", 12.345)], "metric_name string, value double"),
        rules_frame(spark, ("m", None, 200, 50, "<", 5, True)),
    )
    (row,) = kpi.violation_alerts(judged_frame, at(0)).collect()
    assert row.message == "KPI m < 50.0: observed 12.35."
    assert row.expected_low is None and row.expected_high == money("50.0000")


def spike(spark, revenues):
    frame = sales_frame(spark, [(i, r, 1) for i, r in enumerate(revenues)])
    return anomaly.zscore_by_frame(frame.withColumn("s", F.lit(1)), ["s"]).collect()[0]


def test_zscore_needs_five_rows_and_variation(spark):
    assert spike(spark, [1, 3, 1, 100]).severity is None
    assert spike(spark, [1, 3, 1, 3, 100]).severity == "CRITICAL"
    assert spike(spark, [2, 2, 2, 2, 100]).severity is None


def test_zscore_boundaries(spark):
    # History 1, 3, 1, 3: mean 2, population deviation 1.
    assert spike(spark, [1, 3, 1, 3, 4.99]).severity is None
    assert spike(spark, [1, 3, 1, 3, 5]).severity == "HIGH"
    assert spike(spark, [1, 3, 1, 3, 7]).severity == "CRITICAL"
    row = anomaly.zscore_spikes(
        anomaly.zscore_by_frame(
            sales_frame(spark, [(0, 1, 1), (1, 3, 1), (2, 1, 1), (3, 3, 1), (4, 7, 1)]).withColumn("s", F.lit(1)), ["s"]
        )
    ).collect()[0]
    assert (row.expected_low, row.expected_high, row.method) == (0.0, 5.0, "z-score z=5.00")


def series(n, last=None):
    points = [(i, 100 + (i * 37) % 11, 5 + i % 3) for i in range(n)]
    if last is not None:
        points[-1] = (n - 1, last, 60)
    return points


def test_cold_start_uses_zscore_below_fifteen_rows(spark):
    cold = anomaly.detect(sales_frame(spark, series(14, 5000)), at(14)).collect()
    warm = anomaly.detect(sales_frame(spark, series(15, 5000)), at(15)).collect()
    assert [r.method[:7] for r in cold] == ["z-score"]
    assert [r.method[:9] for r in warm] == ["isolation"]
    assert anomaly.detect(sales_frame(spark, series(4, 5000)), at(4)).collect() == []


def test_method_parameter(spark):
    frame = sales_frame(spark, series(40, 5000))
    found = anomaly.detect(frame, at(40), params=AnomalyParams(method="zscore")).collect()
    assert [r.method[:7] for r in found] == ["z-score"]
    with pytest.raises(ValueError):
        anomaly.detect(frame, at(40), params=AnomalyParams(method="guess"))


def test_forest_finds_planted_spike_and_ignores_equal_rows(spark):
    planted = sales_frame(spark, series(120, 5000)).withColumn("s", F.lit(1))
    verdict = anomaly.forest_by_frame(planted, ["s"]).collect()[0]
    assert verdict.severity == "CRITICAL" or verdict.severity == "HIGH"
    scores = anomaly.forest_scores(planted, ["s"], ["revenue", "order_count"], "window_start", AnomalyParams())
    lowest = scores.orderBy("score").first()
    assert lowest.window_start == at(119)
    equal = sales_frame(spark, [(i, 100, 5) for i in range(60)]).withColumn("s", F.lit(1))
    assert anomaly.forest_by_frame(equal, ["s"]).collect()[0].severity is None


def test_forest_ignores_low_outliers(spark):
    points = series(120)
    points[-1] = (119, 0.01, 60)
    frame = sales_frame(spark, points).withColumn("s", F.lit(1))
    verdict = anomaly.forest_by_frame(frame, ["s"]).collect()[0]
    assert verdict.decision < 0 and verdict.severity is None


def test_forest_does_not_depend_on_partitioning(spark):
    frame = sales_frame(spark, series(80, 900)).withColumn("s", F.lit(1))
    one = anomaly.forest_by_frame(frame.coalesce(1), ["s"]).collect()
    many = anomaly.forest_by_frame(frame.repartition(7).orderBy(F.rand(3)), ["s"]).collect()
    assert one[0].decision == many[0].decision


@pytest.mark.parametrize(
    "stock,threshold,icon,color,severity",
    [
        (0, 10, "🔴 OUT", "#FADBD8", "CRITICAL"),
        (5, 10, "🔴 CRIT", "#FDEBD0", "HIGH"),
        (5, 11, "🔴 CRIT", "#FDEBD0", "HIGH"),
        (6, 11, "🟠 LOW", "#FCF3CF", "WARNING"),
        (10, 10, "🟠 LOW", "#FCF3CF", "WARNING"),
        (11, 10, "🟡 OK", "#FFFFFF", None),
        (21, 10, "🟢 HEALTHY", "#FFFFFF", None),
    ],
)
def test_stock_states(spark, stock, threshold, icon, color, severity):
    products = product_frame(spark, [(1, stock, threshold)])
    s, t = F.col("stock_quantity"), F.col("reorder_threshold")
    row = products.select(stock_health(s, t).alias("icon"), stock_row_color(s, t).alias("color")).first()
    assert (row.icon, row.color) == (icon, color)
    raised = low_stock_alerts(products, at(0)).collect()
    assert [a.severity for a in raised] == ([severity] if severity else [])
    if severity:
        assert raised[0].message == f"Low stock: p1 ({stock} <= {threshold})"


def test_blank_stock_counts_as_zero(spark):
    row = product_frame(spark, [(1, None, 10)]).select(
        stock_health(F.col("stock_quantity"), F.col("reorder_threshold")).alias("icon")
    ).first()
    assert row.icon == "🔴 OUT"


def test_zero_threshold_histogram(spark):
    assert rows(stock_histogram(product_frame(spark, [(1, 0, 0), (2, 5, 0)]))) == [("0", 1), (">200%", 1)]


def test_cooldown_key_and_boundary(spark):
    history = spark.createDataFrame(
        [("LOW_STOCK", "1", "WARNING", at(0)), ("KPI_VIOLATION", "m", "WARNING", at(6))],
        "alert_type string, entity_id string, severity string, detected_at timestamp",
    )
    low = low_stock_alerts(product_frame(spark, [(1, 0, 10)]), at(10))
    # Exactly the cooldown ago: allowed. A minute less: held back, whatever the severity.
    assert al.suppress_recent(low, history, al.LOW_STOCK_KEY, at(10), 10).count() == 1
    assert al.suppress_recent(low, history, al.LOW_STOCK_KEY, at(9), 10).count() == 0
    candidates = spark.createDataFrame(
        [("KPI_VIOLATION", "m", "WARNING"), ("KPI_VIOLATION", "m", "CRITICAL")],
        "alert_type string, entity_id string, severity string",
    )
    assert rows(al.suppress_recent(candidates, history, al.KPI_KEY, at(8), 5), "severity") == [("CRITICAL",)]
