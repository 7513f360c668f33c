"""The date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpulse.functions.clock import Clock, moment


def date_dimension(spark: SparkSession, as_of: Clock) -> DataFrame:
    """1 January of last year up to 30 days after ``as_of``."""
    today = F.to_date(moment(as_of))
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.make_date(F.year(today) - 1, F.lit(1), F.lit(1)), F.date_add(today, 30))
        ).alias("date")
    )
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.date_format("date", "MMM yyyy").alias("month"),
        (F.year("date") * 100 + F.month("date")).alias("month_num"),
        F.day("date").alias("day"),
        F.date_format("date", "EEE").alias("weekday"),
    )


def by_calendar(orders: DataFrame, calendar: DataFrame, *by: str) -> DataFrame:
    """Orders and revenue per calendar attribute.

    Only the calendar's days are read. Orders are summed per day first; one row per
    day meets the calendar.
    """
    first = calendar.agg(F.min("date").cast("timestamp")).scalar()
    end = calendar.agg(F.date_add(F.max("date"), 1).cast("timestamp")).scalar()
    orders = orders.filter((F.col("order_timestamp") >= first) & (F.col("order_timestamp") < end))
    daily = orders.groupBy(F.to_date("order_timestamp").alias("date")).agg(
        F.count("*").alias("orders"), F.sum("total_amount").alias("revenue")
    )
    return daily.join(calendar, "date").groupBy(*by).agg(
        F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue")
    )
