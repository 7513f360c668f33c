"""The order stream: one micro-batch in, all retail tables out.

Orders are always counted, however late; the watermark of the source bounds no
state here. Each batch is safe to run again (see `store`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retailpulse.config import DEFAULTS, Params
from retailpulse.operators.alerts import LOW_STOCK_KEY, suppress_recent
from retailpulse.operators.inventory import (
    apply_sales,
    low_stock_alerts,
    sale_movements,
    unknown_products,
)
from retailpulse.operators.metrics import minute_sales, product_minute_sales, units_by_product
from retailpulse.operators.sketches import order_sketches
from retailpulse.operators.shape import order_headers, order_lines, with_line_total
from retailpulse.session import shared_folder
from retailpulse.sources.events import accepted, is_complete, quarantined
from retailpulse.streaming.store import ALL, MAIN, RESTOCK, BatchTable, Carried, Store

# Marks a stream whose own state let each order id through once.
REMEMBERED = "remembered"


def _day(column: str):
    return F.date_format(column, "yyyy-MM-dd")


def remembered(decoded: DataFrame) -> DataFrame:
    """Each order once, by the ids that the stream keeps in its state for as long as it lives.

    What a batch costs depends on its own orders alone: they are looked up by key. The
    same rejected text passes once, too. Which of several payloads with one id in one
    batch passes is open; the batch's tables all follow the same one.
    """
    key = F.when(is_complete(), F.concat(F.lit("order "), "order_id")).otherwise(F.concat(F.lit("text "), F.sha2(F.col("json").cast("binary"), 256)))
    kept = decoded.withColumn("_key", key).dropDuplicates(["_key"]).drop("_key")
    return kept.withColumn(REMEMBERED, F.lit(True))


def first_seen(store: Store, orders: DataFrame, batch_id: int, run: str = MAIN) -> DataFrame:
    """Orders not stored by an earlier batch, one row per order id, whatever its timestamp.

    Stored ids are read back, no other column.
    """
    others = [c for c in orders.columns if c not in ("order_id", "arrived_at")]
    # The payload with the least text wins, so a second run picks the same.
    unique = (
        orders.groupBy("order_id")
        .agg(F.min_by(F.struct(*others), F.to_json(F.struct(*others))).alias("o"), F.min("arrived_at").alias("arrived_at"))
        .select("order_id", "o.*", "arrived_at")
    )
    return unseen(store, unique, batch_id, run)


def unseen(store: Store, orders: DataFrame, batch_id: int, run: str) -> DataFrame:
    """Orders that neither another run nor a batch of ``run`` before ``batch_id`` has stored."""
    return orders.join(store.order_ids.read(before=batch_id, run=run).select("order_id"), "order_id", "left_anti")


def run_of(batch: DataFrame) -> str:
    """The run a micro-batch belongs to: its query's id, which lives with the checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or MAIN


def batch_handler(
    store: Store,
    read_products: Callable[[], DataFrame],
    params: Params = DEFAULTS,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function over decoded events.

    ``read_products`` is called per batch, so catalog changes apply at once;
    stock is the catalog's stock less all units sold so far. A batch already
    committed is left as it is.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        run, known = run_of(batch), REMEMBERED in batch.columns
        if store.log.committed(batch_id, run) or not known and batch.isEmpty():
            return
        # Computed once: with state before it, the batch is not to be run twice.
        text = F.when(~is_complete(), F.col("json")).alias("json")
        batch = store.frozen(batch.select(text, *[c for c in batch.columns if c != "json"]), run)
        before = store.carried(batch_id, run)
        fresh = accepted(batch).drop(REMEMBERED)
        if not known:
            fresh = first_seen(store, fresh, batch_id, run)
        elif before.others - {RESTOCK}:
            # The run's own ids are in its state; those of other runs are stored.
            fresh = unseen(store, fresh, 0, run)
        fresh = fresh.withColumn("part", F.date_format("order_timestamp", store.order_format)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rejected = quarantined(batch).withColumn("part", F.lit(ALL))
            stock, carried = inventory_tables(store, read_products(), fresh, before, params)
            outputs = [(store.quarantine, rejected), *order_tables(store, fresh, params), *stock]
            store.write_batch(batch_id, run, outputs, before, carried)
        finally:
            fresh.unpersist()
        if (batch_id + 1) % params.stream.compact_every == 0:
            store.compact(batch_id, run)

    return handle


def order_tables(store: Store, orders: DataFrame, params: Params) -> list[tuple[BatchTable, DataFrame]]:
    items = order_lines(orders, "order_timestamp", "part")
    window = params.stream.window
    minutes = minute_sales(orders, window).withColumn("part", _day("window_start"))
    product_minutes = product_minute_sales(items, window).withColumn("part", _day("window_start"))
    sketches = order_sketches(orders, "order_timestamp", "arrived_at", window).withColumn("part", _day("window_start"))
    return [
        (store.orders, order_headers(orders, "part")),
        (store.order_ids, orders.select("order_id", F.lit(ALL).alias("part"))),
        (store.order_items, with_line_total(items)),
        (store.minute_sums, minutes),
        (store.product_minute_sums, product_minutes),
        (store.minute_sketches, sketches),
    ]


def inventory_tables(
    store: Store, products: DataFrame, orders: DataFrame, before: Carried, params: Params
) -> tuple[list[tuple[BatchTable, DataFrame]], DataFrame]:
    """Stock movements of the batch and the low-stock alerts they lead to, and what the run carries on.

    The clock is the newest order of this and all earlier batches: late orders do
    not turn it back.
    """
    items = order_lines(orders)
    newest = F.max("order_timestamp")
    clock = orders.agg(F.when(newest.isNotNull(), F.greatest(newest, before.newest_order()))).first()[0]
    now = F.lit(clock).cast("timestamp")
    opening = apply_sales(products, before.sold())

    sold = units_by_product(items).withColumnRenamed("qty", "quantity")
    known = sold.join(products.select("product_id"), "product_id", "left_semi")
    unknown = unknown_products(products, items)
    log = sale_movements(opening, items, now)
    candidates = low_stock_alerts(apply_sales(opening, items), now)
    history = before.alerts().withColumn("alert_type", F.lit("LOW_STOCK"))
    raised = suppress_recent(candidates, history, LOW_STOCK_KEY, now, params.cooldown.low_stock)
    # Nothing is alerted by a batch without a single new order.
    raised = raised.filter(F.col("detected_at").isNotNull())
    outputs = [
        (store.units_sold, known.withColumn("part", F.lit(ALL))),
        (store.unknown_products, unknown.withColumn("part", F.lit(ALL))),
        (store.inventory_log, log.withColumn("part", _day("event_timestamp"))),
        (store.alerts, raised.withColumn("part", _day("detected_at"))),
    ]
    return outputs, before.next(known, clock, raised)


def start(
    decoded: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
    params: Params = DEFAULTS,
    drain: bool = False,
) -> StreamingQuery:
    """Run the handler on every trigger, or once over what is there (``drain``).

    Repeated orders are held back by the query's state (`remembered`).
    Progress is kept in ``checkpoint``, a folder that all executors share; without
    one, below the folder the session names in ``spark.checkpoint.dir``.
    """
    checkpoint = checkpoint or f"{shared_folder(decoded.sparkSession)}/order-ingest"
    writer = (
        remembered(decoded).writeStream.foreachBatch(handler)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=params.stream.trigger)
    return writer.start()
