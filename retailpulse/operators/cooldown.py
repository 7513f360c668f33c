"""Alert cooldown as an exact replay over whole histories.

An alert is emitted when at least the cooldown has passed since the last
*emitted* alert of its key. Suppressed alerts do not count, so the choice is a
chain: each emitted alert decides the next one. The chain of a busy key is not
followed in one task. Time is cut into spans; each span is reduced, in
parallel, to a table of steps "allowed from `enter` on -> allowed again at
`leave`"; the small tables are chained per key; then the spans are visited
again, in parallel, with their entry known.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.session import send_with_task, shuffle_width

send_with_task(__name__)

MICROS_PER_MINUTE = 60_000_000
# A span of one level holds this many spans of the level below; the lowest
# span is this many cooldowns long.
FAN = 16
LEVELS = (1, 2)
ANY_TIME = -(2**62)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _in_order(table: pa.Table) -> pa.Table:
    return table.take(pa.array(np.argsort(_column(table, "enter"), kind="stable")))


def _summarise(keys: list[str], span: int, cooldown: int) -> Callable[[pa.Table], pa.Table]:
    """Steps of a span: where a chain that enters it comes out."""

    def run(table: pa.Table) -> pa.Table:
        table = _in_order(table)
        enter, leave = _column(table, "enter"), _column(table, "leave")
        n = len(enter)
        # Pointer doubling: from each step to the last one of its chain.
        hop = np.searchsorted(enter, leave, side="left")
        last = np.append(np.where(hop == n, np.arange(n), hop), n)
        while True:
            further = last[last]
            if np.array_equal(further, last):
                break
            last = further
        out = leave[last[:n]]
        # A chain arrives less than one cooldown after the span begins, so only
        # the steps up to the first one past that point can be entered.
        start = enter[0] // span * span
        usable = int(np.searchsorted(enter, start + cooldown, side="left")) + 1
        out = out[:usable]
        # Steps with the same outcome: the latest one answers for all.
        kept = np.flatnonzero(np.append(out[1:] != out[:-1], True))
        steps = table.select(keys).take(pa.array(kept))
        return steps.append_column("enter", pa.array(enter[kept])).append_column("leave", pa.array(out[kept]))

    return run


def _follow(keys: list[str]) -> Callable[[pa.Table], pa.Table]:
    """The steps a chain visits, each with the time it was allowed from."""

    def run(table: pa.Table) -> pa.Table:
        table = _in_order(table)
        enter, leave = _column(table, "enter"), _column(table, "leave")
        allowed = _column(table, "allowed")[0]
        visited, asked = [], []
        at = int(np.searchsorted(enter, allowed, side="left"))
        while at < len(enter):
            visited.append(at)
            asked.append(allowed)
            allowed = leave[at]
            at = int(np.searchsorted(enter, allowed, side="left"))
        index = np.array(visited, dtype="int64")
        steps = table.select(keys).take(pa.array(index))
        return steps.append_column("visited", pa.array(enter[index])).append_column(
            "allowed", pa.array(np.array(asked, dtype="int64"))
        )

    return run


def emitted_times(
    alerts: DataFrame, keys: list[str], time: str, minutes: int, last_emitted: DataFrame | None = None
) -> DataFrame:
    """Keys and times of the alerts that pass the cooldown.

    ``last_emitted`` (keys, ``last_at``) continues earlier runs, as a stream
    does between its batches.
    """
    cooldown = minutes * MICROS_PER_MINUTE
    key_ddl = ", ".join(f"{name} {alerts.schema[name].dataType.simpleString()}" for name in keys)
    steps_ddl = f"{key_ddl}, enter bigint, leave bigint"
    visited_ddl = f"{key_ddl}, visited bigint, allowed bigint"
    # A fixed width: groups cost CPU rather than bytes, and adaptive execution
    # would put many of them into one task.
    width = shuffle_width(alerts.sparkSession)

    base = (
        alerts.select(*keys, F.unix_micros(time).alias("enter"))
        .distinct()
        .withColumn("leave", F.col("enter") + cooldown)
    )
    if last_emitted is not None:
        again = last_emitted.select(*keys, (F.unix_micros("last_at") + cooldown).alias("again"))
        base = (
            base.join(again, keys, "left")
            .filter(F.col("again").isNull() | (F.col("enter") >= F.col("again")))
            .drop("again")
        )

    def spanned(df: DataFrame, span: int, by: str = "enter") -> DataFrame:
        return df.withColumn("span", F.floor(F.col(by) / span))

    levels, spans = [base], [cooldown * FAN**depth for depth in LEVELS]
    for span in spans:
        cut = spanned(levels[-1], span).repartition(width, *keys, "span")
        levels.append(cut.groupBy(*keys, "span").applyInArrow(_summarise(keys, span, cooldown), steps_ddl))

    top = levels.pop().withColumn("allowed", F.lit(ANY_TIME))
    visited = top.groupBy(*keys).applyInArrow(_follow(keys), visited_ddl)
    for level, span in zip(reversed(levels), reversed(spans)):
        entries = spanned(visited, span, "visited").drop("visited")
        visited = (
            spanned(level, span)
            .repartition(width, *keys, "span")
            .join(entries, [*keys, "span"])
            .groupBy(*keys, "span")
            .applyInArrow(_follow(keys), visited_ddl)
        )
    return visited.select(*keys, F.timestamp_micros("visited").alias(time))


def suppress_repeats(
    alerts: DataFrame,
    keys: list[str],
    time: str,
    minutes: int,
    tie: str,
    last_emitted: DataFrame | None = None,
) -> DataFrame:
    """The alerts that are emitted; of equal times the least ``tie`` wins."""
    others = [c for c in alerts.columns if c not in (*keys, time)]
    firsts = (
        alerts.groupBy(*keys, time)
        .agg(F.min_by(F.struct(*others), tie).alias("_row"))
        .select(*keys, time, "_row.*")
    )
    emitted = emitted_times(alerts, keys, time, minutes, last_emitted)
    return firsts.join(emitted, [*keys, time], "left_semi").select(*alerts.columns)
