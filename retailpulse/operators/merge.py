"""Keyed merges: additive metrics and catalog refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.operators.metrics import average_order_value

MINUTE_KEY = ["window_start", "window_end"]


def merge_minute_sales(target: DataFrame, delta: DataFrame) -> DataFrame:
    """Add ``delta`` to ``target`` by minute; the average follows from the totals."""
    columns = [*MINUTE_KEY, "revenue", "order_count", "item_count"]
    sums = target.select(*columns).unionByName(delta.select(*columns)).groupBy(*MINUTE_KEY).agg(
        F.sum("revenue").cast("decimal(14,2)").alias("revenue"),
        F.sum("order_count").alias("order_count"),
        F.sum("item_count").alias("item_count"),
    )
    return sums.withColumn("avg_order_value", average_order_value())


def merge_product_minutes(target: DataFrame, delta: DataFrame) -> DataFrame:
    key = [*MINUTE_KEY, "product_id"]
    columns = [*key, "units_sold", "revenue"]
    return target.select(*columns).unionByName(delta.select(*columns)).groupBy(*key).agg(
        F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").cast("decimal(12,2)").alias("revenue"),
    )


# Which columns an update takes from the incoming row, and which it only fills
# when the stored value is missing. Columns in neither list keep their value.
REFRESH = {
    "replace": [
        "name", "category", "price", "popularity_weight", "image_url", "description",
        "rating_rate", "rating_count",
    ],
    "fill": ["stock_quantity", "reorder_threshold"],
}
RESTOCK = {"replace": ["price", "stock_quantity"], "fill": []}


def merge_catalog(
    target: DataFrame, incoming: DataFrame, rule: dict[str, list[str]] = REFRESH, key: str = "product_id"
) -> DataFrame:
    """Upsert products: unknown keys are inserted whole, known ones by ``rule``.

    Columns that only ``incoming`` has are added, empty for products it does not
    bring, and taken from it for those it does. Of several incoming rows with one key
    the largest is used, columns compared in order; rows without a key are left out.
    """
    others = [c for c in incoming.columns if c != key]
    last = F.max(F.struct(*others))
    incoming = incoming.filter(F.col(key).isNotNull()).groupBy(key).agg(last.alias("_row")).select(key, "_row.*")
    old = target.withColumn("_old", F.lit(True)).alias("old")
    new = incoming.withColumn("_new", F.lit(True)).alias("new")
    both = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    matched = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    inserted = F.col("_old").isNull()
    merged = [F.coalesce(F.col(f"old.{key}"), F.col(f"new.{key}")).alias(key)]
    for name in target.columns:
        if name == key:
            continue
        kept = F.col(f"old.{name}")
        if name not in incoming.columns:
            merged.append(kept.alias(name))
            continue
        given = F.col(f"new.{name}")
        value = F.when(inserted, given)
        if name in rule["replace"]:
            value = value.when(matched, given)
        elif name in rule["fill"]:
            value = value.when(matched, F.coalesce(kept, given))
        merged.append(value.otherwise(kept).alias(name))
    merged += [F.col(f"new.{name}").alias(name) for name in others if name not in target.columns]
    return both.select(*merged)
