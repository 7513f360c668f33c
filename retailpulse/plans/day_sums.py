"""The measures of orders and order items from stored daily sums, with raw rows for the open days alone.

A closed day's orders do not change any more: one row a day holds what the measures
add up. A dashboard then reads as many rows as there are days, and the orders since
the last closed day, however long the shop's history is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpulse.functions.clock import Clock, moment
from retailpulse.functions.numbers import zero_as_blank
from retailpulse.plans.measures import MEASURES, bases_of, with_formulas

#: The column of the daily sums that each measure adds up. All look at whole days.
STORED = {
    "total_revenue": "total_amount",
    "total_revenue_today": "total_amount",
    "total_revenue_yesterday": "total_amount",
    "order_count": "orders",
    "orders_today": "orders",
    "units_sold": "quantity",
    "units_sold_today": "quantity",
    "line_revenue": "line_revenue",
}


def _day() -> Column:
    return F.date_trunc("day", "order_timestamp").alias("order_timestamp")


def day_sums(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """(order_timestamp, total_amount, orders, quantity, line_revenue): one row per day, at its start.

    An order id belongs to one day (the ingest counts repeats once). Orders without a
    time, and items whose order is not known, are in the row without a time. A day
    without orders has no row.
    """
    by_order = orders.groupBy(_day()).agg(
        F.sum("total_amount").alias("total_amount"), F.count_distinct("order_id").alias("orders")
    )
    sold = order_items.groupBy("order_id").agg(
        F.sum("quantity").alias("quantity"), F.sum(F.col("quantity") * F.col("unit_price")).alias("line_revenue")
    )
    dated = sold.join(orders.select("order_id", "order_timestamp"), "order_id", "left")
    by_item = dated.groupBy(_day()).agg(F.sum("quantity").alias("quantity"), F.sum("line_revenue").alias("line_revenue"))
    both = by_order.unionByName(by_item, allowMissingColumns=True)
    return both.groupBy("order_timestamp").agg(*[F.sum(c).alias(c) for c in ("total_amount", "orders", "quantity", "line_revenue")])


def evaluate_from_days(
    model: dict[str, DataFrame], sums: DataFrame, until: Clock, names: list[str], as_of: Clock
) -> DataFrame:
    """The named measures in one row, as ``measures.evaluate`` gives them over all of ``model``.

    Days before ``until`` (the start of a day) come from ``sums``, made by ``day_sums`` when
    they were closed; of the orders only those from ``until`` on are read, of the items those
    of these orders. Measures that do not look at whole days come from their own tables.
    """
    end = moment(until)
    recent = model["orders"].filter(F.col("order_timestamp") >= end)
    items = model["order_items"].drop("order_timestamp").join(recent.select("order_id", "order_timestamp"), "order_id")
    # Sums of the open days have the same form, so one aggregation covers both.
    closed = sums.filter(F.col("order_timestamp").isNull() | (F.col("order_timestamp") < end))
    days = closed.unionByName(day_sums(recent, items))
    bases = bases_of(names)
    stored = [name for name in bases if name in STORED]

    def summed(name: str) -> Column:
        measure = MEASURES[name]
        value = F.col(STORED[name])
        total = F.sum(value if measure.where is None else F.when(measure.where(as_of), value))
        return zero_as_blank(total) if measure.kind == "distinct" else total

    parts = [days.agg(*[summed(name).alias(name) for name in stored])] if stored else []
    return with_formulas(model, parts, [name for name in bases if name not in STORED], names, as_of)
