"""Basket mining: how many lines an order has, how many units a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sizes above this share one bucket, and the weights used as
# long as no baskets were observed.
TOP_BUCKET = 8
DEFAULT_SIZES = {1: 30, 2: 35, 3: 20, 4: 10, 5: 5}
DEFAULT_QUANTITIES = {1: 70, 2: 20, 3: 7, 4: 2, 5: 1}


def _histogram(df: DataFrame, value: Column) -> DataFrame:
    bucket = F.least(value, F.lit(TOP_BUCKET)).cast("int").alias("bucket")
    return df.groupBy(bucket).agg(F.count("*").alias("weight"))


def basket_sizes(carts: DataFrame, n_items: Column) -> DataFrame:
    return _histogram(carts, n_items)


def line_quantities(lines: DataFrame, quantity: str = "quantity") -> DataFrame:
    """A line without a quantity counts as one unit."""
    return _histogram(lines, F.coalesce(F.col(quantity), F.lit(1)))


def cart_histograms(carts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both histograms of landed cart documents (``products`` arrays)."""
    size = F.coalesce(F.size("products"), F.lit(0))
    size = F.when(F.col("products").isNull(), 0).otherwise(size)
    lines = carts.select(F.explode("products").alias("p")).select("p.quantity")
    return basket_sizes(carts, size), line_quantities(lines)


def or_default(histogram: DataFrame, default: dict[int, int]) -> DataFrame:
    """The histogram, or the default weights if it has no rows.

    The default rows pass a filter on the number of observed rows, which Spark
    evaluates once as a scalar subquery.
    """
    rows = ", ".join(f"({bucket}, {weight}L)" for bucket, weight in default.items())
    fallback = histogram.sparkSession.sql(
        f"SELECT bucket, weight FROM VALUES {rows} AS d(bucket, weight)"
    )
    observed = histogram.agg(F.count("*")).scalar()
    return histogram.unionByName(fallback.filter(observed == 0))
