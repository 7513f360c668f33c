"""Properties of the physical plans that matter at scale."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA, rows
from retailpulse.operators import shape, star
from retailpulse.plans.catalogue import REGISTRY
from retailpulse.plans.measures import evaluate, star_model
from retailpulse.sources import tables
from retailpulse.sources.testbed import Testbed

FOLDER = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def plan(spark, name):
    return REGISTRY[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(REGISTRY))
def test_no_pairwise_joins_and_no_one_task_windows(name, spark):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    # An unpartitioned window would sit on a single-partition exchange.
    for found in re.finditer(r"windowspecdefinition\(([^)]*)", text):
        assert not re.match(r"\S+ (ASC|DESC)", found.group(1)), f"window without keys in {name}"


@pytest.mark.parametrize("name", ["v2_revenue_per_minute", "m5_revenue_last_5_min", "k1_revenue_per_5min", "d1_zscore_spike"])
def test_trailing_windows_filter_the_scan(name, spark):
    scans = [line for line in plan(spark, name).splitlines() if "FileScan" in line]
    assert any("(ts#" in line.split("DataFilters:")[1] and "Subquery" in line for line in scans)


def test_alert_feed_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(spark, "o3_alert_feed")
    assert "TakeOrderedAndProject" in plan(spark, "o2_top_sellers")


def test_cooldown_is_an_anti_join(spark):
    assert "LeftAnti" in plan(spark, "j1_cooldown_anti_join")


def test_scans_read_only_needed_columns(spark):
    text = REGISTRY["m1_total_revenue"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"FileScan parquet \[value#\d+\]", text)


def test_messages_are_parsed_once(spark):
    assert plan(spark, "s2_decode_payload").count("from_json") == 1


def test_co_located_facts_meet_without_a_shuffle(spark):
    t = Testbed(spark, FOLDER)
    plain = {"saved_orders": t.orders, "saved_items": t.order_items}
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        tables.save_co_located(plain, "order_id", 4)
        # Facts are too large to broadcast.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        orders, items = spark.table("saved_orders"), spark.table("saved_items")

        def joined(orders, items):
            return items.join(orders.select("order_id", "order_timestamp"), "order_id")

        def today(orders, items):
            model = star_model(orders, items, t.products, t.sales_metrics, t.alerts)
            return evaluate(model, ["units_sold_today"], orders.agg(F.max("order_timestamp")).scalar())

        def documents(orders, items):
            return shape.nest_orders(items, ["product_id", "quantity", "unit_price"])

        for build in (joined, documents, today):
            found = build(orders, items)
            assert "hashpartitioning(order_id" not in found._jdf.queryExecution().executedPlan().toString()
            assert rows(found) == rows(build(t.orders, t.order_items))
        star_rows = star.enrich_items(orders, items, t.products)
        # Only the join with the products, by their own key, deals rows.
        assert "hashpartitioning(order_id" not in star_rows._jdf.queryExecution().executedPlan().toString()
        assert star_rows.count() == star.enrich_items(t.orders, t.order_items, t.products).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
        for name in plain:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
