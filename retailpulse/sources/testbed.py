"""Retail tables derived from the generic star-schema test tables.

Each event stands for one order; line items, parts and orders give the star
schema. Frames are lazy, so a query only reads the columns it uses.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpulse.functions.clock import latest
from retailpulse.functions.numbers import round_half_up
from retailpulse.operators.alerts import fold_resolutions
from retailpulse.operators.inventory import apply_sales
from retailpulse.operators.metrics import minute_sales, product_minute_sales
from retailpulse.schemas import SEED_RULES
from retailpulse.session import prepare
from retailpulse.sources.tables import seed_rules

# Timestamps are declared as TIMESTAMP, not inferred as TIMESTAMP_NTZ: time
# filters then need no cast and reach the Parquet scan.
RAW = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, "
    "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, "
    "l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, "
    "p_size int, p_retailprice double",
}



class Testbed:
    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

    @cached_property
    def now(self) -> Column:
        """Clock of the minute-grained tables."""
        return latest(self.events, "ts")

    @cached_property
    def today(self) -> Column:
        """Clock of the day-grained tables."""
        return latest(self.raw("orders"), "o_orderdate")

    @cached_property
    def products(self) -> DataFrame:
        size = F.col("p_size") * 4
        return self.raw("part").select(
            F.col("p_partkey").cast("int").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
            size.cast("int").alias("stock_quantity"),
            F.greatest(F.floor(size * F.lit(0.2)), F.lit(10)).cast("int").alias("reorder_threshold"),
        )

    @cached_property
    def rated_products(self) -> DataFrame:
        ratings = self.raw("lineitem").groupBy(
            F.col("l_partkey").cast("int").alias("product_id")
        ).agg(F.count("*").cast("int").alias("rating_count"))
        return self.products.join(ratings, "product_id", "left").withColumn(
            "rating_count", F.coalesce("rating_count", F.lit(0))
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.events.select(
            F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("order_id"),
            F.concat(F.lit("CUST-"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("customer_id"),
            F.col("ts").alias("order_timestamp"),
            F.col("value").cast("decimal(12,2)").alias("total_amount"),
            (1 + F.col("event_id") % 5).cast("int").alias("item_count"),
            F.when(F.col("event_type") == "signup", F.lit(None))
            .otherwise(F.upper("event_type")).alias("status"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        lines = self.events.select(
            F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("order_id"),
            F.get_json_object("props", "$.k").cast("int").alias("product_id"),
            (1 + F.col("event_id") % 5).cast("int").alias("quantity"),
            F.col("ts").alias("order_timestamp"),
            "event_type",
            "event_id",
        )
        prices = self.products.select("product_id", F.col("price").alias("unit_price"))
        return lines.join(prices, "product_id")

    @cached_property
    def purchases(self) -> DataFrame:
        """Sold lines only; no price needed, so no join."""
        return self.events.filter(F.col("event_type") == "purchase").select(
            F.get_json_object("props", "$.k").cast("int").alias("product_id"),
            (1 + F.col("event_id") % 5).cast("int").alias("quantity"),
            F.col("ts").alias("order_timestamp"),
            "event_id",
        )

    @cached_property
    def stock(self) -> DataFrame:
        """Products after all purchases were taken off the shelf."""
        return apply_sales(self.products, self.purchases)

    @cached_property
    def sales_metrics(self) -> DataFrame:
        return minute_sales(self.orders)

    @cached_property
    def product_sales_metrics(self) -> DataFrame:
        return product_minute_sales(self.order_items)

    @cached_property
    def alerts(self) -> DataFrame:
        kind = F.col("event_type")
        product = F.get_json_object("props", "$.k")
        metric = F.element_at(
            F.array(*[F.lit(rule[0]) for rule in SEED_RULES]),
            (F.col("event_id") % 5 + 1).cast("int"),
        )
        return self.events.filter(kind.isin("error", "signup", "click")).select(
            F.col("event_id").alias("alert_id"),
            F.when(kind == "error", "LOW_STOCK").when(kind == "signup", "REVENUE_SPIKE")
            .otherwise("KPI_VIOLATION").alias("alert_type"),
            F.when(F.col("value") >= 100, "CRITICAL").when(F.col("value") >= 50, "HIGH")
            .otherwise("WARNING").alias("severity"),
            F.when(kind == "error", "PRODUCT").when(kind == "signup", "WINDOW")
            .otherwise("KPI").alias("entity_type"),
            F.when(kind == "error", product)
            .when(kind == "signup", F.date_trunc("minute", F.col("ts")).cast("string"))
            .otherwise(metric).alias("entity_id"),
            F.concat(F.lit("event "), "event_id", F.lit(" of user "), "user_id").alias("message"),
            F.col("value").cast("decimal(14,4)").alias("detected_value"),
            F.when(kind == "signup", product.cast("int")).cast("decimal(14,4)").alias("expected_low"),
            F.when(kind == "signup", product.cast("int") * 2).cast("decimal(14,4)").alias("expected_high"),
            F.col("ts").alias("detected_at"),
            (F.col("event_id") % 3 == 0).alias("resolved"),
        )

    @cached_property
    def resolutions(self) -> DataFrame:
        """Every second alert resolved after five minutes, every fourth once more after nine; one of no alert."""
        again = F.sequence(F.lit(5), F.when(F.col("alert_id") % 4 == 0, 9).otherwise(5), F.lit(4))
        chosen = self.events.select(F.col("event_id").alias("alert_id"), "ts").filter(F.col("alert_id") % 2 == 0)
        return chosen.select("alert_id", "ts", F.explode(again).alias("after")).select(
            "alert_id", (F.col("ts") + F.make_dt_interval(mins="after")).alias("resolved_at")
        )

    @cached_property
    def alert_states(self) -> DataFrame:
        return fold_resolutions(self.alerts, self.resolutions)

    @cached_property
    def lines(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_partkey").cast("int").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            round_half_up(F.col("l_extendedprice") / F.col("l_quantity"), 2)
            .cast("decimal(10,2)").alias("unit_price"),
        )

    @cached_property
    def heads(self) -> DataFrame:
        """Order headers without the item count: no join with the lines."""
        return self.raw("orders").select(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("o_orderdate").alias("order_timestamp"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
            F.col("o_orderstatus").alias("status"),
        )

    @cached_property
    def carts(self) -> DataFrame:
        return self.raw("lineitem").groupBy(
            F.col("l_orderkey").cast("string").alias("cart_id")
        ).agg(F.count("*").alias("n_items"))

    @cached_property
    def rules(self) -> DataFrame:
        return seed_rules(self.spark)
