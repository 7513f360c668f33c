"""Stateful queries that remember something of their own for every key.

The state lives in the query's state store and its checkpoint: a restart continues
where the last batch ended, and how the stream was cut into batches changes nothing.
Both order what arrives by event time and hold it back until the watermark has passed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from retailpulse.operators.metrics import minute_sales
from retailpulse.session import send_with_task

send_with_task(__name__)

MICROS_PER_MINUTE = 60_000_000
# Rows travel through the state as text; microseconds are kept.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
SALE, RESTOCK = 0, 1
SECONDS_PER_MINUTE = 60
# Minutes that a minute's own figures look back on, itself included.
FIVE_MINUTES, HOUR = 5, 60


def _tuples(frames: Iterator[pd.DataFrame], *columns: str) -> list[tuple]:
    return [row for frame in frames for row in zip(*(frame[c].tolist() for c in columns))]


class _Cooldown(StatefulProcessor):
    """Per key: the alerts that the watermark has not passed, and the time of the last one emitted."""

    def __init__(self, keys: list[str], cooldown: int):
        self.keys, self.cooldown = keys, cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, tie long, body string")
        self.last = handle.getValueState("last", "at long")

    def _wake(self, at: int) -> None:
        """Call again once the watermark is beyond ``at`` (microseconds)."""
        self.handle.registerTimer(at // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        settled = timerValues.getCurrentWatermarkInMs() * 1000
        new = [row for row in _tuples(rows, "at", "tie", "body") if row[0] >= settled]
        if new:
            self.waiting.appendList(new)
            self._wake(min(row[0] for row in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        settled = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.waiting.get())
        due = [row for row in waiting if row[0] < settled]
        rest = waiting[len(due):]
        last = self.last.get()[0] if self.last.exists() else None
        emitted = []
        for at, _, body in due:
            if last is None or at >= last + self.cooldown:
                emitted.append(body)
                last = at
        if rest:
            self.waiting.put(rest)
            self._wake(rest[0][0])
        else:
            self.waiting.clear()
        if emitted:
            self.last.update((last,))
        if last is not None and last + self.cooldown < settled:
            # Whatever still comes is later than the cooldown: nothing is left to remember.
            self.last.clear()
        elif last is not None and not rest:
            self._wake(last + self.cooldown)
        if emitted:
            yield pd.DataFrame(dict(zip(self.keys, ([k] * len(emitted) for k in key))) | {"body": emitted})

    def close(self) -> None:
        pass


def cooldown_stream(alerts: DataFrame, keys: list[str], time: str, minutes: int, tie: str, delay: str = "10 minutes") -> DataFrame:
    """Alerts that pass the cooldown after the last *emitted* one of their key (append mode).

    The result is that of ``cooldown.suppress_repeats`` over all alerts that were at
    most ``delay`` late, whatever their order of arrival; of equal times the least
    ``tie`` (a whole number) wins. An alert comes out once the watermark has passed it.
    A key is forgotten when its cooldown is over and nothing of it waits. Null keys are
    a key of their own; alerts without a time are left out.
    """
    own = StructType([alerts.schema[k] for k in keys])
    marked = alerts.filter(F.col(time).isNotNull()).withWatermark(time, delay)
    rows = marked.select(
        *keys, F.col(time), F.unix_micros(time).alias("at"), F.col(tie).cast("long").alias("tie"),
        F.to_json(F.struct(*alerts.columns), JSON_TIMES).alias("body"),
    )
    processor = _Cooldown(keys, minutes * MICROS_PER_MINUTE)
    out = StructType([*own.fields]).add("body", "string")
    emitted = rows.groupBy(*keys).transformWithStateInPandas(processor, out, "Append", "EventTime")
    return emitted.select(F.inline(F.array(F.from_json("body", alerts.schema, JSON_TIMES))))


class _Stock(StatefulProcessor):
    """Per product: the last settled level, the units sold since, and the movements that may still be overtaken."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.settled = handle.getValueState("settled", "level long, at long, sold long")
        self.open = handle.getListState("open", "at long, kind int, amount long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.settled.update((int(initialState["amount"].iloc[0]), -(2**62), 0))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.settled.exists():
            return
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        arrived = [row for row in _tuples(rows, "at", "kind", "amount") if row[0] >= watermark]
        # A restock comes after the sales of its own instant, and the largest of several counts.
        moves = sorted([*self.open.get(), *arrived])
        state = self.settled.get()
        past = [m for m in moves if m[0] < watermark]
        if past:
            state = _moved(state, past)
            self.settled.update(state)
        ahead = moves[len(past):]
        if ahead:
            self.open.put(ahead)
        elif self.open.exists():
            self.open.clear()
        level, _, sold = _moved(state, ahead)
        newest = moves[-1][0] if moves else state[1]
        yield pd.DataFrame({"product_id": [key[0]], "at": [newest], "stock": [max(0, level - sold)]})

    def close(self) -> None:
        pass


def _moved(state: tuple, moves: list[tuple]) -> tuple:
    """(level, its time, units sold since) after movements in order."""
    level, since, sold = state
    for at, kind, amount in moves:
        if kind == RESTOCK:
            level, since, sold = amount, at, 0
        elif at > since:
            sold += amount
    return level, since, sold


def keyed_stock_stream(lines: DataFrame, restocks: DataFrame, products: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """(product_id, as_of, stock_quantity) of every product that moved (update mode).

    ``lines`` (product_id, quantity, order_timestamp) and ``restocks`` (product_id,
    stock_quantity, restocked_at) are two streams in one state per product, ordered by
    event time: a restock that arrives late still counts the sales after it, if it is
    at most ``delay`` late. What the last row of a product says equals
    ``inventory.stock_after_movements`` over all that arrived so far. The state starts
    with the catalog's stock (``products``, static); products the catalog lacks, and rows
    without a time, are left out. Movements behind the watermark are kept as one sum.
    """
    at = F.col("order_timestamp").alias("moved_at")
    sales = lines.select("product_id", at, F.lit(SALE).alias("kind"), F.col("quantity").cast("long").alias("amount"))
    levels = restocks.select(
        "product_id", F.col("restocked_at").alias("moved_at"), F.lit(RESTOCK).alias("kind"), F.col("stock_quantity").cast("long").alias("amount")
    )
    moves = sales.unionByName(levels).filter(F.col("moved_at").isNotNull()).withWatermark("moved_at", delay)
    moves = moves.select("product_id", "moved_at", F.unix_micros("moved_at").alias("at"), "kind", "amount")
    start = products.select("product_id", F.col("stock_quantity").cast("long").alias("amount")).groupBy("product_id")
    out = StructType([lines.schema["product_id"]]).add("at", "long").add("stock", "long")
    found = moves.groupBy("product_id").transformWithStateInPandas(_Stock(), out, "Update", "EventTime", initialState=start)
    return found.select("product_id", F.timestamp_micros("at").alias("as_of"), F.col("stock").cast("int").alias("stock_quantity"))


class _Trailing(StatefulProcessor):
    """Per series: the minutes that later ones still look back on."""

    def __init__(self, n_minutes: int):
        self.n_minutes = n_minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "at long, cents long, orders long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = sorted(self.recent.get()) if self.recent.exists() else []
        out = []
        for minute in sorted(_tuples(rows, "at", "cents", "orders")):
            oldest = minute[0] - (max(self.n_minutes, HOUR) - 1) * SECONDS_PER_MINUTE
            kept = [m for m in kept if m[0] >= oldest] + [minute]
            out.append((*key, *minute, *_looked_back(kept, self.n_minutes)))
        self.recent.put(kept)
        yield pd.DataFrame(out, columns=["series", "at", "cents", "orders", *TRAILING])

    def close(self) -> None:
        pass


TRAILING = ["n_history", "mean_revenue", "std_revenue", "cents_5m", "orders_5m", "cents_1h", "orders_1h"]


def _looked_back(minutes: list[tuple], n_minutes: int) -> tuple:
    """``TRAILING`` of the last of some minutes (time, cents, orders)."""
    now = minutes[-1][0]

    def last(n: int) -> list[tuple]:
        return [m for m in minutes if m[0] >= now - (n - 1) * SECONDS_PER_MINUTE]

    before = [float(Decimal(cents).scaleb(-2)) for _, cents, _ in last(n_minutes)[:-1]]
    mean = std = math.nan
    if before:
        mean = float(Decimal(sum(m[1] for m in last(n_minutes)[:-1])).scaleb(-2)) / len(before)
        std = math.sqrt(math.fsum((x - mean) ** 2 for x in before) / len(before))
    sums = [sum(m[k] for m in last(n)) for n in (FIVE_MINUTES, HOUR) for k in (1, 2)]
    return len(before), mean, std, *sums


def trailing_stream(orders: DataFrame, n_minutes: int = 30, delay: str = "10 minutes", series: str | None = None) -> DataFrame:
    """Every closed minute with its spike test and its rolling sales (append mode).

    Two stateful operators in a row: orders are summed per event-time minute until the
    watermark closes it; the closed minute then meets the last hour of its series in
    state. The rows are those of ``series.trailing_zscore`` and ``series.rolling_sales``
    over all orders that were at most ``delay`` late. ``series``, a column of ``orders``,
    parts them into series of their own; null is one of them. A series keeps at most an
    hour of minutes (or ``n_minutes``, if more). Orders without a time are left out.

    Returns series, window_start, revenue, order_count, n_history, mean_revenue,
    std_revenue, z, revenue_5m, orders_5m, revenue_1h and orders_1h.
    """
    name = (F.col(series) if series else F.lit("all")).cast("string").alias("series")
    marked = orders.filter(F.col("order_timestamp").isNotNull()).withWatermark("order_timestamp", delay)
    closed = minute_sales(marked.select("order_timestamp", "total_amount", "item_count", name), by=["series"])
    cents = (F.coalesce("revenue", F.lit(0)) * 100).cast("long").alias("cents")
    minutes = closed.select("series", F.unix_seconds("window_start").alias("at"), cents, F.col("order_count").alias("orders"))
    schema = "series string, at long, cents long, orders long, n_history long, mean_revenue double, std_revenue double"
    schema += ", cents_5m long, orders_5m long, cents_1h long, orders_1h long"
    found = minutes.groupBy("series").transformWithStateInPandas(_Trailing(n_minutes), schema, "Append", "None")

    def money(column: str) -> Column:
        return (F.col(column).cast("decimal(18,0)") / 100).cast("decimal(14,2)")

    def known(column: str) -> Column:
        return F.when(F.col("n_history") > 0, F.col(column))

    z = F.when(
        (F.col("n_history") >= 4) & (F.col("std_revenue") > 0),
        (money("cents").cast("double") - F.col("mean_revenue")) / F.col("std_revenue"),
    )
    return found.select(
        "series", F.timestamp_seconds("at").alias("window_start"), money("cents").alias("revenue"), F.col("orders").alias("order_count"),
        "n_history", known("mean_revenue").alias("mean_revenue"), known("std_revenue").alias("std_revenue"), z.alias("z"),
        money("cents_5m").alias("revenue_5m"), "orders_5m", money("cents_1h").alias("revenue_1h"), "orders_1h",
    )
