"""Measures grouped and sliced by columns of related tables."""

import pytest
from pyspark.sql import functions as F

from conftest import at, money, rows
from retailpulse.plans.day_sums import STORED, day_sums, evaluate_from_days
from retailpulse.plans.measures import evaluate
from retailpulse.plans.relationships import Relationship, Slicer, Star

ITEMS = [("o1", 1, 2, "2.50"), ("o1", 2, 1, "1.00"), ("o2", 1, 4, "2.50"), ("o3", 3, 1, "9.00"), ("o4", 9, 5, "1.00"), (None, 2, 7, "1.00"), ("o2", None, 1, "3.00")]
ORDERS = [("o1", 0, "10.00"), ("o2", 60 * 24, "20.00"), ("o3", 60 * 24 * 2, "30.00"), ("o5", 0, "5.00")]
PRODUCTS = [(1, "a", "high", 10), (2, "a", "low", 20), (3, "b", "high", 30), (4, "b", "low", 40)]


@pytest.fixture
def model(spark):
    items = [(o, p, q, money(price)) for o, p, q, price in ITEMS]
    orders = [(o, at(m), money(x)) for o, m, x in ORDERS]
    dates = [(at(60 * 24 * k).date(), f"day {k}") for k in range(2)]
    return {
        "order_items": spark.createDataFrame(items, "order_id string, product_id int, quantity int, unit_price decimal(10,2)"),
        "orders": spark.createDataFrame(orders, "order_id string, order_timestamp timestamp, total_amount decimal(12,2)"),
        "products": spark.createDataFrame(PRODUCTS, "product_id int, category string, tier string, stock_quantity int"),
        "dates": spark.createDataFrame(dates, "date date, label string"),
    }


def test_columns_of_other_tables_group_without_losing_rows(model):
    found = rows(evaluate(model, ["units_sold", "total_stock"], at(0), ["category"]))
    # Items of unknown or no product are blank, like in a report.
    assert found == sorted([("a", 14, 30), ("b", 1, 70), (None, 6, None)], key=repr)
    by_day = rows(evaluate(model, ["units_sold"], at(0), ["label"]))
    assert by_day == sorted([("day 0", 3), ("day 1", 5), (None, 13)], key=repr)
    both = rows(evaluate(model, ["units_sold"], at(0), ["label", "category"]))
    assert both == sorted([("day 0", "a", 3), ("day 1", "a", 4), ("day 1", None, 1), (None, "b", 1), (None, None, 5), (None, "a", 7)], key=repr)


def test_two_slicers_at_once_and_those_that_do_not_reach(model):
    date = Slicer("dates", F.col("label") == "day 1")
    tier = Slicer("products", F.col("tier") == "high")
    one = evaluate(model, ["units_sold", "line_revenue", "total_revenue", "order_count", "total_stock"], at(0), slicers=[date, tier]).first()
    # Orders are not sliced by product, products not by date.
    assert tuple(one) == (4, money("10.00"), money("20.00"), 1, 40)
    assert evaluate(model, ["units_sold"], at(0), slicers=[Slicer("order_items", F.col("quantity") > 4)]).first()[0] == 12


def test_distinct_counts_by_a_related_column(model):
    assert rows(evaluate(model, ["order_count", "total_revenue"], at(0), ["label"])) == sorted(
        [("day 0", 2, money("15.00")), ("day 1", 1, money("20.00")), (None, 1, money("30.00"))], key=repr
    )


def test_a_column_that_nothing_leads_to_is_an_error(model):
    with pytest.raises(ValueError, match="orders"):
        evaluate(model, ["total_revenue"], at(0), ["category"])


def test_the_shortest_way_is_taken(model):
    more = [Relationship("order_items", "orders", "order_id", "order_id"), Relationship("orders", "dates", "to_date(order_timestamp)", "date")]
    star = Star(model, more)
    assert [r.one for r in star.path("order_items", lambda t: t == "dates")] == ["orders", "dates"]
    assert star.path("orders", lambda t: t == "order_items") is None and star.path("orders", lambda t: t == "orders") == []


def test_sums_are_taken_before_the_catalog_is_joined(model):
    plan = evaluate(model, ["units_sold"], at(0), ["category"])._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join")
    assert plan.rindex("Aggregate") > join and "sum(" in plan[join:]


@pytest.mark.parametrize("closed_days", [0, 1, 2, 3, 10])
def test_measures_from_day_sums_read_no_order_of_a_closed_day(spark, model, closed_days):
    now, midnight = at(60 * 24 * 2 + 30), at(60 * 24 * closed_days - 12 * 60)
    known = model["orders"].select("order_id", "order_timestamp")
    model["order_items_of_orders"] = model["order_items"].join(known, "order_id")
    names = [*STORED, "average_order_value", "revenue_vs_yesterday_pct", "total_stock"]
    want = evaluate(model, names, now).collect()
    sums = day_sums(model["orders"], model["order_items"])
    sums = spark.createDataFrame(sums.collect(), sums.schema)
    # What the closed days' rows say now does not matter any more.
    closed = F.col("order_timestamp") < F.lit(midnight)
    spoilt = model | {"orders": model["orders"].withColumn("total_amount", F.when(closed, F.col("total_amount") * 1000).otherwise(F.col("total_amount")))}
    assert evaluate_from_days(spoilt, sums, midnight, names, now).collect() == want


def test_measures_from_day_sums_without_any_order(spark, model):
    empty = {name: rows_.limit(0) for name, rows_ in model.items()}
    empty["order_items_of_orders"] = empty["order_items"].join(empty["orders"], "order_id")
    sums = day_sums(empty["orders"], empty["order_items"])
    assert sums.count() == 0
    assert evaluate_from_days(empty, sums, at(0), list(STORED), at(0)).collect() == evaluate(empty, list(STORED), at(0)).collect()
