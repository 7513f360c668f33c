"""The explicit clock: every trailing window is measured from ``as_of``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Clock = Column | datetime | str


def latest(df: DataFrame, column: str) -> Column:
    """The maximum of ``column`` as a scalar subquery.

    Spark runs it once ahead of the main query and hands the value to the file
    scan as an ordinary pushed filter, so no join and no driver round trip.
    """
    return df.agg(F.max(column)).scalar()


def moment(as_of: Clock) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def minutes(n: int | Column) -> Column:
    return F.make_dt_interval(mins=n if isinstance(n, Column) else F.lit(n))


def before(as_of: Clock, n: int | Column) -> Column:
    """``as_of`` minus ``n`` minutes."""
    return moment(as_of) - minutes(n)


def midnight(as_of: Clock) -> Column:
    return F.date_trunc("day", moment(as_of))


def is_today(column: Column, as_of: Clock) -> Column:
    day = midnight(as_of)
    return (column >= day) & (column < day + F.expr("INTERVAL 1 DAY"))


def is_yesterday(column: Column, as_of: Clock) -> Column:
    day = midnight(as_of)
    return (column >= day - F.expr("INTERVAL 1 DAY")) & (column < day)


def epoch_seconds(column: str | Column) -> Column:
    return F.unix_seconds(F.col(column) if isinstance(column, str) else column)
