"""The thirty dashboard measures, evaluated together in one pass per table.

A measure is an aggregate over one base table, optionally limited by a
condition, or a formula over other measures. `evaluate` scans each base table
once whatever the number of measures, groups by any columns, its own or those that
relationships lead to (`relationships`), and takes sums before it joins; the tables'
partial results are unioned and folded by key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpulse.functions.clock import Clock, before, is_today, is_yesterday
from retailpulse.functions.labels import is_low_stock, trend_arrow, trend_color
from retailpulse.functions.numbers import blank_as_zero, zero_as_blank
from retailpulse.plans.relationships import RELATIONSHIPS, Relationship, Slicer, Star


@dataclass(frozen=True)
class Base:
    """An aggregate of ``value`` over the rows of ``table`` that meet ``where``."""

    table: str
    kind: str  # sum, count or distinct
    value: Callable[[], Column] = lambda: F.lit(1)
    where: Callable[[Clock], Column] | None = None


@dataclass(frozen=True)
class Formula:
    needs: tuple[str, ...]
    value: Callable[[dict[str, Column]], Column]


@dataclass(frozen=True)
class Span:
    """The rows from ``start`` to before ``end`` minutes ago; without ``end`` up to now."""

    column: str
    start: int
    end: int | None = None

    def __call__(self, as_of: Clock) -> Column:
        inside = F.col(self.column) >= before(as_of, self.start)
        return inside if self.end is None else inside & (F.col(self.column) < before(as_of, self.end))


_since = _between = Span


def _today(as_of: Clock) -> Column:
    return is_today(F.col("order_timestamp"), as_of)


def _yesterday(as_of: Clock) -> Column:
    return is_yesterday(F.col("order_timestamp"), as_of)


def _col(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _open(as_of: Clock) -> Column:
    return ~F.col("resolved")


def _ratio(top: str, bottom: str) -> Callable[[dict[str, Column]], Column]:
    return lambda m: F.try_divide(m[top].cast("double"), m[bottom].cast("double"))


def _trend(m: dict[str, Column]) -> Column:
    return blank_as_zero(m["revenue_last_5_min"]) - blank_as_zero(m["revenue_prior_5_min"])


def _vs_yesterday(m: dict[str, Column]) -> Column:
    today, yesterday = m["total_revenue_today"], m["total_revenue_yesterday"]
    gain = blank_as_zero(today) - blank_as_zero(yesterday)
    return F.try_divide(gain.cast("double"), yesterday.cast("double"))


def _alert(kind: str, n_minutes: int) -> Callable[[Clock], Column]:
    return lambda as_of: (F.col("alert_type") == kind) & (F.col("detected_at") >= before(as_of, n_minutes))


MEASURES: dict[str, Base | Formula] = {
    "total_revenue": Base("orders", "sum", _col("total_amount")),
    "total_revenue_today": Base("orders", "sum", _col("total_amount"), _today),
    "total_revenue_yesterday": Base("orders", "sum", _col("total_amount"), _yesterday),
    "revenue_vs_yesterday_pct": Formula(("total_revenue_today", "total_revenue_yesterday"), _vs_yesterday),
    "revenue_last_5_min": Base("sales_metrics", "sum", _col("revenue"), _since("window_start", 5)),
    "revenue_last_1_hour": Base("sales_metrics", "sum", _col("revenue"), _since("window_start", 60)),
    "revenue_prior_5_min": Base("sales_metrics", "sum", _col("revenue"), _between("window_start", 10, 5)),
    "revenue_trend_arrow": Formula(
        ("revenue_last_5_min", "revenue_prior_5_min"), lambda m: trend_arrow(_trend(m))
    ),
    "average_order_value": Formula(("total_revenue", "order_count"), _ratio("total_revenue", "order_count")),
    "order_count": Base("orders", "distinct", _col("order_id")),
    "orders_today": Base("orders", "distinct", _col("order_id"), _today),
    "average_order_value_today": Formula(
        ("total_revenue_today", "orders_today"), _ratio("total_revenue_today", "orders_today")
    ),
    "orders_last_5_min": Base("sales_metrics", "sum", _col("order_count"), _since("window_start", 5)),
    "units_sold": Base("order_items", "sum", _col("quantity")),
    # `order_items_of_orders`: items whose order passes the filter, see `star_model`.
    "units_sold_today": Base("order_items_of_orders", "sum", _col("quantity"), _today),
    "line_revenue": Base("order_items", "sum", lambda: F.col("quantity") * F.col("unit_price")),
    "total_stock": Base("products", "sum", _col("stock_quantity")),
    "low_stock_count": Base(
        "products", "distinct", _col("product_id"),
        lambda as_of: is_low_stock(F.col("stock_quantity"), F.col("reorder_threshold")),
    ),
    "out_of_stock_count": Base(
        "products", "distinct", _col("product_id"), lambda as_of: F.col("stock_quantity") == 0
    ),
    "stock_coverage_days": Formula(("total_stock", "units_sold_today"), _ratio("total_stock", "units_sold_today")),
    "active_alerts": Base("alerts", "count", where=_open),
    "critical_alerts": Base(
        "alerts", "count", where=lambda as_of: _open(as_of) & (F.col("severity") == "CRITICAL")
    ),
    "anomaly_count_last_hour": Base("alerts", "count", where=_alert("REVENUE_SPIKE", 60)),
    "low_stock_alerts_active": Base(
        "alerts", "count", where=lambda as_of: _open(as_of) & (F.col("alert_type") == "LOW_STOCK")
    ),
    "kpi_violations_last_hour": Base("alerts", "count", where=_alert("KPI_VIOLATION", 60)),
    "alerts_last_15_min": Base("alerts", "count", where=_since("detected_at", 15)),
    "revenue_trend_color": Formula(
        ("revenue_last_5_min", "revenue_prior_5_min"), lambda m: trend_color(_trend(m))
    ),
}
# The remaining three measures describe one selected row and are columns:
# stock health icon, severity colour and stock row colour (functions.labels).


def bases_of(names: Iterable[str]) -> list[str]:
    found: list[str] = []
    for name in names:
        measure = MEASURES[name]
        for base in [name] if isinstance(measure, Base) else bases_of(measure.needs):
            if base not in found:
                found.append(base)
    return found


def _plain(measure: Base, as_of: Clock) -> Column:
    value = measure.value() if measure.where is None else F.when(measure.where(as_of), measure.value())
    return F.sum(value) if measure.kind == "sum" else zero_as_blank(F.count(value))


def _one_table(table: DataFrame, wanted: dict[str, Base], by: list[str], as_of: Clock) -> DataFrame:
    """All measures of one table in one aggregation (or two, with distincts).

    Distinct counts over one id are taken by grouping on the id first: each
    row is shuffled once, not once per distinct measure.
    """
    conditions = [m.where(as_of) for m in wanted.values() if m.where is not None]
    if len(conditions) == len(wanted):
        table = table.filter(reduce(or_, conditions))
    distinct = {name: m for name, m in wanted.items() if m.kind == "distinct"}
    if not distinct:
        return table.groupBy(*by).agg(*[_plain(m, as_of).alias(n) for n, m in wanted.items()])

    idents = {str(m.value()): m.value() for m in distinct.values()}
    if len(idents) > 1:
        raise ValueError(f"distinct counts of one table over several columns: {sorted(idents)}")
    (ident,) = idents.values()
    first, second = [], []
    for name, m in wanted.items():
        if m.kind == "distinct":
            hit = F.lit(True) if m.where is None else m.where(as_of)
            first.append(F.max(hit).alias(name))
            second.append(zero_as_blank(F.count_if(F.col(name) & F.col("_id").isNotNull())).alias(name))
        else:
            first.append(_plain(m, as_of).alias(name))
            second.append(F.sum(name).alias(name))
    per_id = table.groupBy(*by, ident.alias("_id")).agg(*first)
    return per_id.groupBy(*by).agg(*second)


def _related(star: Star, name: str, wanted: dict[str, Base], by: list[str], as_of: Clock, slicers: list[Slicer]) -> DataFrame:
    """All measures of one table, sliced, by columns of its own or of tables it is related to.

    Sums and counts are taken per key before the last join, so a key with many rows
    meets its description once. Distinct counts need the rows themselves.
    """
    rows, late = star.related(name, by, slicers)
    if late is None:
        return _one_table(rows, wanted, by, as_of)
    before, key, join = late
    if any(m.kind == "distinct" for m in wanted.values()):
        return _one_table(join(rows.select("*", key)), wanted, by, as_of)
    summed = _one_table(rows.select("*", key), wanted, [*before, "_many"], as_of)
    return join(summed).groupBy(*by).agg(*[F.sum(n).alias(n) for n in wanted])


def evaluate(
    model: dict[str, DataFrame],
    names: list[str],
    as_of: Clock,
    by: list[str] | None = None,
    slicers: Iterable[Slicer] = (),
    relationships: Iterable[Relationship] = RELATIONSHIPS,
) -> DataFrame:
    """The named measures, per combination of ``by`` (or in one row), over the rows that all ``slicers`` select.

    A column of ``by`` may belong to any table that relationships lead to; rows
    without a partner there have it blank. A slicer acts on its own table and on those
    whose relationships lead to it; others are not sliced.
    """
    by, bases = by or [], bases_of(names)
    return with_formulas(model, [], bases, names, as_of, by, slicers, relationships)


def with_formulas(
    model: dict[str, DataFrame],
    parts: list[DataFrame],
    bases: list[str],
    names: list[str],
    as_of: Clock,
    by: Iterable[str] = (),
    slicers: Iterable[Slicer] = (),
    relationships: Iterable[Relationship] = RELATIONSHIPS,
) -> DataFrame:
    """The measures ``names`` from ``bases``, evaluated here, and the base measures that ``parts`` already hold."""
    by, star, slicers = list(by), Star(model, relationships), list(slicers)
    tables: dict[str, dict[str, Base]] = {}
    for name in bases:
        tables.setdefault(MEASURES[name].table, {})[name] = MEASURES[name]
    parts = [*parts, *(_related(star, t, wanted, by, as_of, slicers) for t, wanted in tables.items())]
    found = bases_of(names)
    folded = parts[0]
    if len(parts) > 1:
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        folded = union.groupBy(*by).agg(*[F.max(name).alias(name) for name in found])

    known: dict[str, Column] = {name: F.col(name) for name in found}

    def column(name: str) -> Column:
        measure = MEASURES[name]
        if isinstance(measure, Base):
            return known[name]
        return measure.value({need: column(need) for need in measure.needs})

    return folded.select(*by, *[column(name).alias(name) for name in names])


def star_model(
    orders: DataFrame, order_items: DataFrame, products: DataFrame, sales_metrics: DataFrame, alerts: DataFrame
) -> dict[str, DataFrame]:
    """Base tables with the order -> item relationship in place.

    A condition on the order's time is pushed to the orders, whose remaining
    ids then decide (by broadcast or run-time filter) which items are moved.
    """
    of_orders = order_items.select("order_id", "quantity").join(
        orders.select("order_id", "order_timestamp"), "order_id"
    )
    return {
        "orders": orders,
        "order_items": order_items,
        "order_items_of_orders": of_orders,
        "products": products,
        "sales_metrics": sales_metrics,
        "alerts": alerts,
    }


def lookback_minutes(table: str, names: Iterable[str] = tuple(MEASURES)) -> int:
    """How far back the measures ``names`` look over the rows of ``table``."""
    furthest = 0
    for name in names:
        measure = MEASURES[name]
        if isinstance(measure, Formula):
            furthest = max(furthest, lookback_minutes(table, measure.needs))
        elif measure.table == table and isinstance(measure.where, Span):
            furthest = max(furthest, measure.where.start)
    return furthest
