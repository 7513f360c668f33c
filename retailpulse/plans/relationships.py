"""Relationships between the dashboard's tables, and what they let a measure be grouped and sliced by.

A relationship leads from a table with many rows for a key to the one that describes
the key. A column or slicer of a table further along acts on every table whose
relationships lead there, as in a report: never the other way.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Relationship:
    """``many_key`` (an SQL expression) of ``many`` finds one row of ``one`` by ``one_key``.

    ``reduces``: there are far fewer keys than rows, so sums are taken before the join.
    """

    many: str
    one: str
    many_key: str
    one_key: str
    reduces: bool = True


@dataclass(frozen=True)
class Slicer:
    """Rows of ``table`` that stay selected, and so all rows related to them."""

    table: str
    condition: Column


RELATIONSHIPS = (
    Relationship("order_items", "orders", "order_id", "order_id", reduces=False),
    Relationship("order_items", "products", "product_id", "product_id"),
    Relationship("product_sales_metrics", "products", "product_id", "product_id"),
    Relationship("orders", "dates", "to_date(order_timestamp)", "date"),
    Relationship("sales_metrics", "dates", "to_date(window_start)", "date"),
    Relationship("product_sales_metrics", "dates", "to_date(window_start)", "date"),
)


class Star:
    """Tables by name with their relationships."""

    def __init__(self, tables: dict[str, DataFrame], relationships: Iterable[Relationship] = RELATIONSHIPS):
        self.tables = tables
        self.relationships = [r for r in relationships if r.many in tables and r.one in tables]

    def path(self, table: str, goal) -> list[Relationship] | None:
        """The shortest way from ``table`` to one that meets ``goal``; of equally short ones the first named."""
        ways, seen = [[]], {table}
        while ways:
            longer = []
            for way in ways:
                here = way[-1].one if way else table
                if goal(here):
                    return way
                for r in self.relationships:
                    if r.many == here and r.one not in seen:
                        seen.add(r.one)
                        longer.append([*way, r])
            ways = longer
        return None

    def _hops(self, table: str, columns: list[str], slicers: list[Slicer]) -> dict[Relationship, tuple[list[str], list[Slicer]]]:
        """What each relationship of ``table`` is needed for: columns beyond it, slicers beyond it."""
        hops: dict[Relationship, tuple[list[str], list[Slicer]]] = {}
        for column in columns:
            way = self.path(table, lambda t, c=column: c in self.tables[t].columns)
            if way is None:
                raise ValueError(f"no relationship leads from {table} to a table with a column {column}")
            if way:
                hops.setdefault(way[0], ([], []))[0].append(column)
        for slicer in slicers:
            way = self.path(table, lambda t, s=slicer: t == s.table)
            if way:
                hops.setdefault(way[0], ([], []))[1].append(slicer)
        return hops

    def _sliced(self, table: str, slicers: list[Slicer]) -> DataFrame:
        rows = self.tables[table]
        for slicer in slicers:
            if slicer.table == table:
                rows = rows.filter(slicer.condition)
        return rows

    def _beyond(self, r: Relationship, columns: list[str], slicers: list[Slicer]) -> DataFrame:
        """(_key, columns): the described side of ``r`` with what lies further along, only rows that stay selected."""
        rows = self._sliced(r.one, slicers)
        for hop, (more, cuts) in self._hops(r.one, columns, slicers).items():
            rows = self._joined(rows, hop, more, cuts)
        return rows.select(F.expr(r.one_key).alias("_key"), *columns)

    def _joined(self, rows: DataFrame, r: Relationship, columns: list[str], slicers: list[Slicer], key: str | None = None) -> DataFrame:
        """``rows`` with ``columns`` beyond ``r``. A row without a partner has them blank, and is not selected by a slicer."""
        one = self._beyond(r, columns, slicers)
        return rows.join(one, F.expr(key or r.many_key) == one["_key"], "inner" if slicers else "left").drop(one["_key"])

    def related(self, table: str, by: list[str], slicers: list[Slicer]) -> tuple[DataFrame, tuple | None]:
        """``table`` sliced and with the columns ``by`` from other tables, up to one join that is better made after summing.

        That join comes second: (columns to sum by besides the own ones, key, how to join).
        """
        own = [c for c in by if c in self.tables[table].columns]
        rows = self._sliced(table, slicers)
        hops = self._hops(table, [c for c in by if c not in own], slicers)
        late = [r for r in hops if r.reduces]
        for r in [r for r in hops if r not in late[-1:]]:
            rows = self._joined(rows, r, *hops[r])
        if not late:
            return rows, None
        last = late[-1]
        before = [c for c in by if c not in hops[last][0]]
        return rows, (before, F.expr(last.many_key).alias("_many"), lambda summed: self._joined(summed, last, *hops[last], key="_many").drop("_many"))
