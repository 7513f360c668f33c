"""The eight retail tables: reading, registering, counting, resetting."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpulse.config import CatalogParams, JdbcParams
from retailpulse.schemas import SEED_RULES, TABLES

# Tables a reporting tool loads, and tables a demo reset empties.
BI_TABLES = (
    "orders",
    "order_items",
    "products",
    "sales_metrics",
    "product_sales_metrics",
    "alerts",
    "kpi_thresholds",
)
RESET_TABLES = (
    "alerts",
    "inventory_log",
    "order_items",
    "orders",
    "product_sales_metrics",
    "sales_metrics",
    "products",
)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A Parquet table under ``root`` with its declared schema."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def read_jdbc_table(
    spark: SparkSession,
    jdbc: JdbcParams,
    name: str,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    parts: int = 1,
) -> DataFrame:
    """A table of a relational store; ``split_on`` reads it in parallel ranges."""
    reader = (
        spark.read.format("jdbc")
        .option("url", jdbc.url)
        .option("dbtable", name)
        .option("user", jdbc.user)
        .option("password", jdbc.password)
        .option("driver", jdbc.driver)
    )
    if split_on and bounds:
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", parts)
        )
    return reader.load()


def register_bi_tables(spark: SparkSession, root: str, names: Iterable[str] = BI_TABLES) -> None:
    """Expose the reporting tables to ``spark.sql`` under their own names."""
    for name in names:
        read_table(spark, root, name).createOrReplaceTempView(name)


def append_jdbc(df: DataFrame, jdbc: JdbcParams, name: str, mode: str = "append") -> None:
    (
        df.write.format("jdbc")
        .option("url", jdbc.url)
        .option("dbtable", name)
        .option("user", jdbc.user)
        .option("password", jdbc.password)
        .option("driver", jdbc.driver)
        .option("batchsize", jdbc.batch_size)
        .mode(mode)
        .save()
    )


def append_parquet(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("append").parquet(f"{root}/{name}")


def save_co_located(tables: dict[str, DataFrame], key: str, buckets: int, mode: str = "errorifexists") -> None:
    """Save ``tables`` (name: rows) in the catalog, bucketed and sorted by ``key`` alike.

    Joins and groupings of the saved tables by ``key`` then need no shuffle: a task reads
    one bucket of each. Rows are dealt once here, so every bucket is one file. Choose
    ``buckets`` so that a bucket fits a task (some hundred MB), the same for all tables. A
    key with a large share of the rows makes one large bucket, which a join without a
    shuffle cannot split: leave such tables as plain files.
    """
    for name, rows in tables.items():
        dealt = rows.repartition(buckets, key)
        dealt.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def reset_tables(spark: SparkSession, root: str, names: Iterable[str] = RESET_TABLES) -> None:
    """Empty the given tables, keeping their schemas."""
    for name in names:
        empty = spark.createDataFrame([], TABLES[name])
        empty.write.option("partitionOverwriteMode", "static").mode("overwrite").parquet(
            f"{root}/{name}"
        )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def seed_rules(spark: SparkSession) -> DataFrame:
    """The starting KPI rules as an inline table (its size is known to Catalyst)."""
    rows = ", ".join(
        f"('{name}', '{text}', CAST({warning} AS DECIMAL(14,4)), "
        f"CAST({critical} AS DECIMAL(14,4)), '{operator}', {window}, true)"
        for name, text, warning, critical, operator, window in SEED_RULES
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS rules(metric_name, description, warning_threshold, "
        "critical_threshold, comparison_operator, window_minutes, enabled)"
    )


def enabled_rules(rules: DataFrame) -> DataFrame:
    return rules.filter("enabled")


def catalog_scan(products: DataFrame, source: str | None = CatalogParams.source_name) -> DataFrame:
    """The sellable catalog; ``source=None`` keeps rows of every origin."""
    if source is not None:
        products = products.filter(F.col("source") == source)
    return products.select("product_id", "name", "category", "price", "popularity_weight")


def find_product(catalog: DataFrame, product_id: int | Column) -> DataFrame:
    """The catalog row of one product; no row if it does not exist."""
    return catalog.filter(F.col("product_id") == product_id)
