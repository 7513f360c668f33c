"""Parquet tables fed by numbered micro-batches of runs.

A run is the life of one stream checkpoint: batch numbers start again with a new
checkpoint, so a batch is named by run and number. Every batch has a folder of its
own in each table; writing it again replaces that folder whole, also by nothing, and
touches no other. A batch counts once its commit row is written, after all its tables:
readers join the commits, so nobody sees half a batch. Measures that add up over
batches are stored as per-batch sums and added when read; nothing is read, changed and
written back, and late orders simply arrive in a later batch.

What a batch must know of all earlier ones is carried from batch to batch as one small
table (`Store.carried`), and repeated orders are known to the stream's own state, so a
batch reads no more files after a year than after a minute.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from functools import cached_property, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from retailpulse import schemas
from retailpulse.operators.alerts import fold_resolutions, open_alerts, with_alert_id
from retailpulse.operators.inventory import apply_sales, restock_movements
from retailpulse.operators.metrics import average_order_value
from retailpulse.operators.sketches import WINDOW, merged


# The run of batches that no stream checkpoint names, and those of other writers.
MAIN = "main"
MONITOR = "monitor"
RESTOCK = "restock"
RESOLVE = "resolve"
ALL = "all"


def _written(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table, or None as long as nothing was written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or an empty frame as long as nothing was written."""
    found = _written(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def _from_day(rows: DataFrame, since: Column | None) -> DataFrame:
    return rows if since is None else rows.filter(F.col("part") >= F.date_format(since, "yyyy-MM-dd"))


def _write(df: DataFrame, folder: str) -> None:
    """Replace ``folder`` by ``df``, by part.

    The rebalance hint gives each part few files but splits a busy one over several
    tasks.
    """
    (
        df.hint("rebalance", "part")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("part")
        .parquet(folder)
    )


def _replace(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)


def _side_by_side(*jobs) -> None:
    """Run the jobs at once; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(max_workers=6) as pool:
        running = [pool.submit(job) for job in jobs]
    for job in running:
        job.result()


def _struct(**kinds: str) -> StructType:
    return reduce(lambda s, item: s.add(*item), kinds.items(), StructType())


PART = StructField("part", StringType())
BATCH = [StructField("run", StringType()), StructField("batch_id", LongType())]
SEQ = StructField("seq", LongType())


@dataclass(frozen=True)
class Compacted:
    """What the last compaction covers: batches up to ``through`` of each run, in the files up to ``seq``."""

    seq: int = 0
    # Files up to this one were emptied.
    cleared: int = 0
    through: dict[str, int] = field(default_factory=dict)

    def uncovered(self) -> Column:
        covered = F.lit(False)
        for run, last in self.through.items():
            covered |= (F.col("run") == run) & (F.abs("batch_id") <= last)
        return ~covered


class Log:
    """Which batches count, and which of them a compaction covers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def commit(self, batch_id: int, run: str = MAIN) -> None:
        _replace(self.spark.range(1).select(F.lit(batch_id).cast("long").alias("committed")).coalesce(1), f"{self.root}/commits/run={run}/batch_id={batch_id}")

    def committed(self, batch_id: int, run: str = MAIN) -> bool:
        found = _written(self.spark, f"{self.root}/commits/run={run}/batch_id={batch_id}", _struct(committed="long"))
        return found is not None and not found.isEmpty()

    def batches(self, compacted: Compacted) -> DataFrame:
        """(run, batch_id) of the committed batches that no compaction covers."""
        return _read(self.spark, f"{self.root}/commits", StructType(BATCH)).filter(compacted.uncovered())

    def compacted(self) -> Compacted:
        """The newest note; of the two folders written in turn one is whole, whatever breaks off."""
        found = _written(self.spark, f"{self.root}/compactions", _struct(seq="long", cleared="long", run="string", through="long"))
        rows = [] if found is None else found.collect()
        newest = max((r.seq for r in rows), default=None)
        rows = [r for r in rows if r.seq == newest]
        return Compacted(rows[0].seq, rows[0].cleared, {r.run: r.through for r in rows}) if rows else Compacted()

    def note(self, now: Compacted) -> None:
        rows = [(now.seq, now.cleared, run, last) for run, last in now.through.items()]
        _replace(self.spark.createDataFrame(rows, "seq long, cleared long, run string, through long").coalesce(1), f"{self.root}/compactions/slot={now.seq % 2}")


class BatchTable:
    """Rows by batch and ``part``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, log: Log):
        self.spark, self.path, self.schema, self.log = spark, path, schema, log

    def write(self, df: DataFrame, batch_id: int, run: str = MAIN) -> None:
        """Replace the batch's rows; they count once the batch is committed."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        rows = df.select(*columns, F.col("part").cast("string").alias("part"))
        _write(rows, f"{self.path}/run={run}/batch_id={batch_id}")

    def _batches(self, compacted: Compacted) -> DataFrame:
        rows = _read(self.spark, self.path, StructType([*self.schema.fields, PART, *BATCH]))
        return rows.filter(compacted.uncovered()).join(self.log.batches(compacted), ["run", "batch_id"], "left_semi")

    def read(self, before: int | None = None, since: Column | None = None, run: str = MAIN) -> DataFrame:
        """All rows of committed batches, or without those of ``run`` from batch ``before`` on.

        ``since`` skips the days before a moment, for tables with daily parts.
        """
        compacted = self.log.compacted()
        fields = [*self.schema.fields, PART, *BATCH]
        gathered = _read(self.spark, f"{self.path}_compacted", StructType([*fields, SEQ]))
        gathered = gathered.filter((F.col("seq") <= compacted.seq) & (F.col("seq") > compacted.cleared)).drop("seq")
        rows = self._batches(compacted).select(*gathered.columns).unionByName(gathered)
        if before is not None:
            rows = rows.filter((F.col("run") != run) | (F.col("batch_id") < before))
        return _from_day(rows, since)

    def compact(self, old: Compacted, now: Compacted) -> None:
        """Write the rows that ``now`` covers but ``old`` does not, as files ``now.seq``."""
        _write(self._batches(old).filter(~now.uncovered()), f"{self.path}_compacted/seq={now.seq}")


class AlertTable(BatchTable):
    """Alerts with an id of their own, made of run, batch and content, and resolved by another table's rows."""

    def __init__(self, spark, path, schema, log, resolutions: BatchTable):
        super().__init__(spark, path, schema, log)
        self.resolutions = resolutions

    def write(self, df: DataFrame, batch_id: int, run: str = MAIN) -> None:
        super().write(with_alert_id(df, F.lit(run), F.lit(batch_id)), batch_id, run)

    def raised(self, before: int | None = None, since: Column | None = None, run: str = MAIN) -> DataFrame:
        """The alerts as they were raised."""
        return super().read(before, since, run)

    def read(self, before: int | None = None, since: Column | None = None, run: str = MAIN) -> DataFrame:
        return fold_resolutions(self.raised(before, since, run), self.resolutions.read(since=since))


class AdditiveTable(BatchTable):
    """Per-batch sums by key; the table's content is their total.

    A compaction adds up what was compacted before and the new batches, for every part
    that these touch. Readers take a part's newest compacted sums and the batches that
    no compaction covers.
    """

    def __init__(self, spark, path, schema, log, keys: list[str], sums: list[str]):
        super().__init__(spark, path, schema, log)
        self.keys, self.sums = keys, sums

    def _gathered(self, compacted: Compacted) -> DataFrame:
        """The newest compacted sums of each part."""
        parts = _read(self.spark, f"{self.path}_parts", StructType([PART, SEQ]))
        parts = parts.filter((F.col("seq") <= compacted.seq) & (F.col("seq") > compacted.cleared))
        newest = parts.groupBy("part").agg(F.max("seq").alias("seq"))
        gathered = _read(self.spark, f"{self.path}_compacted", StructType([*self.schema.fields, PART, SEQ]))
        return gathered.join(newest, ["part", "seq"], "left_semi").drop("seq")

    def _sum(self, rows: DataFrame, *extra: str) -> DataFrame:
        types = {f.name: f.dataType for f in self.schema.fields}
        return rows.groupBy(*extra, *self.keys).agg(
            *[F.sum(name).cast(types[name]).alias(name) for name in self.sums]
        )

    def totals(self, before: int | None = None, since: Column | None = None, run: str = MAIN) -> DataFrame:
        """``before`` leaves out batches of ``run`` that no compaction covers yet."""
        compacted = self.log.compacted()
        rows = self._batches(compacted)
        if before is not None:
            rows = rows.filter((F.col("run") != run) | (F.col("batch_id") < before))
        gathered = self._gathered(compacted)
        return self._sum(_from_day(rows.select(*gathered.columns).unionByName(gathered), since))

    def compact(self, old: Compacted, now: Compacted) -> None:
        new = self._batches(old).filter(~now.uncovered())
        touched = new.select("part").distinct()
        before = self._gathered(old).join(touched, "part", "left_semi")
        _write(self._sum(new.select(*before.columns).unionByName(before), "part"), f"{self.path}_compacted/seq={now.seq}")
        _write(touched.withColumn("touched", F.lit(True)), f"{self.path}_parts/seq={now.seq}")


class SketchTable(AdditiveTable):
    """Per-batch sketches by key, merged instead of summed."""

    def _sum(self, rows: DataFrame, *extra: str) -> DataFrame:
        return merged(rows, *extra, *self.keys)


#: What a run carries from batch to batch: the newest order's time, the units sold and the last low-stock alert of each product.
CARRIED = _struct(kind="string", product_id="integer", units="long", at="timestamp")
CLOCK, SOLD, ALERT = "clock", "sold", "alert"


@dataclass(frozen=True)
class Carried:
    """What was known before a batch: by its own run, and by all (`CARRIED` with ``run``); where the next version goes."""

    run: str
    known: DataFrame
    slot: int
    cleared: int
    others: frozenset[str]

    @property
    def own(self) -> DataFrame:
        return self.known.filter(F.col("run") == self.run)

    def newest_order(self) -> Column:
        return self.known.filter(F.col("kind") == CLOCK).agg(F.max("at")).scalar()

    def sold(self) -> DataFrame:
        return self.known.filter(F.col("kind") == SOLD).select("product_id", F.col("units").alias("quantity"))

    def alerts(self) -> DataFrame:
        """(entity_id, detected_at) of the last low-stock alert of each product and run."""
        return self.known.filter(F.col("kind") == ALERT).select(F.col("product_id").cast("string").alias("entity_id"), F.col("at").alias("detected_at"))

    def next(self, sold: DataFrame, now: datetime | None = None, alerts: DataFrame | None = None) -> DataFrame:
        """The own run's next version: with units sold (product_id, quantity), the clock and alerts of a batch."""
        def row(kind, **values):
            return [F.lit(kind).alias("kind"), *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in CARRIED.fields[1:]]]

        clock = sold.sparkSession.range(1).select(*row(CLOCK, at=now))
        rows = [self.own.drop("run"), clock, sold.select(*row(SOLD, product_id=F.col("product_id"), units=F.col("quantity")))]
        if alerts is not None:
            rows.append(alerts.select(*row(ALERT, product_id=F.col("entity_id"), at=F.col("detected_at"))))
        return reduce(DataFrame.unionByName, rows).groupBy("kind", "product_id").agg(F.sum("units").alias("units"), F.max("at").alias("at"))


class Store:
    """All tables of the monitoring job under one root folder.

    Orders and their items are stored by ``order_part`` of their event time:
    by hour for a busy shop, by day where an hour holds too little for a file.
    """

    def __init__(self, spark: SparkSession, root: str, order_part: str = "hour"):
        self.spark, self.root = spark, root
        self.order_format = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}[order_part]
        self.log = Log(spark, root)

    def _batch(self, name: str, schema: StructType) -> BatchTable:
        return BatchTable(self.spark, f"{self.root}/{name}", schema, self.log)

    def _additive(self, name: str, schema: StructType, keys: list[str], sums: list[str]) -> AdditiveTable:
        return AdditiveTable(self.spark, f"{self.root}/{name}", schema, self.log, keys, sums)

    @cached_property
    def orders(self) -> BatchTable:
        fields = [f for f in schemas.ORDERS.fields if f.name != "inserted_at"]
        return self._batch("orders", StructType(fields))

    @cached_property
    def order_ids(self) -> BatchTable:
        """The ids of all stored orders, for runs that do not remember them."""
        return self._batch("order_ids", StructType([StructField("order_id", StringType())]))

    @cached_property
    def order_items(self) -> BatchTable:
        return self._batch("order_items", schemas.ORDER_ITEMS)

    @cached_property
    def inventory_log(self) -> BatchTable:
        return self._batch("inventory_log", schemas.INVENTORY_LOG)

    @cached_property
    def resolutions(self) -> BatchTable:
        """When an alert was resolved, by the day the alert was raised."""
        return self._batch("resolutions", schemas.RESOLUTIONS)

    @cached_property
    def alerts(self) -> AlertTable:
        return AlertTable(self.spark, f"{self.root}/alerts", schemas.ALERTS, self.log, self.resolutions)

    @cached_property
    def quarantine(self) -> BatchTable:
        return self._batch("quarantine", StructType([StructField("json", StringType())]))

    @cached_property
    def unknown_products(self) -> BatchTable:
        fields = [schemas.ORDER_LINE["product_id"], StructField("qty", LongType())]
        return self._batch("unknown_products", StructType(fields))

    @cached_property
    def minute_sums(self) -> AdditiveTable:
        fields = [f for f in schemas.SALES_METRICS.fields if f.name != "avg_order_value"]
        return self._additive("minute_sums", StructType(fields), ["window_start", "window_end"], ["revenue", "order_count", "item_count"])

    @cached_property
    def product_minute_sums(self) -> AdditiveTable:
        keys = ["window_start", "window_end", "product_id"]
        return self._additive("product_minute_sums", schemas.PRODUCT_SALES_METRICS, keys, ["units_sold", "revenue"])

    @cached_property
    def units_sold(self) -> AdditiveTable:
        fields = [schemas.ORDER_LINE["product_id"], StructField("quantity", LongType())]
        return self._additive("units_sold", StructType(fields), ["product_id"], ["quantity"])

    @cached_property
    def minute_sketches(self) -> SketchTable:
        """Sketches of order ids and arrival lags per minute (see ``operators.sketches``)."""
        return SketchTable(self.spark, f"{self.root}/minute_sketches", schemas.MINUTE_SKETCHES, self.log, WINDOW, ["orders", "lags"])

    @property
    def tables(self) -> list[BatchTable]:
        return [
            self.orders, self.order_ids, self.order_items, self.inventory_log, self.resolutions, self.alerts, self.quarantine,
            self.unknown_products, self.minute_sums, self.product_minute_sums, self.minute_sketches, self.units_sold,
        ]

    # --- batches -----------------------------------------------------------------------

    def commit(self, batch_id: int, run: str = MAIN) -> None:
        """Let the batch count: its tables are written."""
        self.log.commit(batch_id, run)

    def write_batch(
        self, batch_id: int, run: str, outputs: list[tuple[BatchTable, DataFrame]], before: Carried | None = None, carried: DataFrame | None = None
    ) -> None:
        """Write the batch's tables side by side, with what it carries on, and commit it.

        No output reads what another one writes in the same batch, and each may be
        written again, so their order does not matter.
        """
        jobs = [lambda t=table, df=df: t.write(df, batch_id, run) for table, df in outputs]
        if carried is not None:
            version = [F.lit(batch_id).cast("long").alias("version"), F.lit(before.cleared).cast("long").alias("cleared")]
            folder = f"{self.root}/carried/run={run}/slot={before.slot}"
            jobs.append(lambda: _replace(carried.select(*version, *CARRIED.names), folder))
        _side_by_side(*jobs)
        self.commit(batch_id, run)

    def frozen(self, batch: DataFrame, run: str) -> DataFrame:
        """The batch as files, of which the run keeps one set: whatever is computed again starts from the same rows."""
        folder = f"{self.root}/incoming/run={run}"
        _replace(batch, folder)
        return self.spark.read.schema(batch.schema).parquet(folder)

    def carried(self, before: int, run: str = MAIN) -> Carried:
        """What ``run`` knew before batch ``before``, and what other runs know now.

        Each run has two folders, written in turn, and the newer one is read: nothing
        of the batches themselves. A version that broke off leaves the one before it.
        """
        cleared = self.log.compacted().cleared
        root = f"{self.root}/carried"
        kinds = _struct(version="long", cleared="long", run="string", slot="integer")
        versions = _written(self.spark, root, kinds)
        heads = {}
        if versions is not None:
            versions = versions.filter((F.col("cleared") == cleared) & ((F.col("run") != run) | (F.col("version") < before)))
            heads = {r.run: r.head for r in versions.groupBy("run").agg(F.max(F.struct("version", "slot")).alias("head")).collect()}
        fields = StructType([*CARRIED.fields, BATCH[0]])
        if heads:
            folders = [f"{root}/run={r}/slot={head.slot}" for r, head in heads.items()]
            known = self.spark.read.schema(fields).option("basePath", root).parquet(*folders).select(*fields.names)
        else:
            known = self.spark.createDataFrame([], fields)
        slot = 1 - heads[run].slot if run in heads else 0
        return Carried(run, known, slot, cleared, frozenset(heads) - {run})

    def compact(self, through: int, run: str = MAIN) -> None:
        """Gather in every table the batches of ``run`` up to ``through``, and all committed ones of other runs, in few files.

        One compaction at a time. It counts once it is noted, so one that breaks off is
        simply made again.
        """
        old = self.log.compacted()
        new = self.log.batches(old).filter((F.col("run") != run) | (F.abs("batch_id") <= through))
        last = {r.run: r.last for r in new.groupBy("run").agg(F.max(F.abs("batch_id")).alias("last")).collect()}
        if not last:
            return
        now = Compacted(old.seq + 1, old.cleared, old.through | last)
        _side_by_side(*[lambda t=t: t.compact(old, now) for t in self.tables])
        self.log.note(now)

    def clear(self) -> None:
        """Empty all tables; batches written so far never count again. For use while no batch runs.

        Orders that a running stream remembers stay known to it; a new checkpoint forgets them.
        """
        old = self.log.compacted()
        seen = _read(self.spark, f"{self.root}/commits", StructType(BATCH)).groupBy("run").agg(F.max(F.abs("batch_id")).alias("last"))
        last = {r.run: r.last for r in seen.collect()}
        self.log.note(Compacted(old.seq + 1, old.seq + 1, old.through | last or {MAIN: -1}))

    # --- readers and other writers ------------------------------------------------------

    def sales_metrics(self, since: Column | None = None) -> DataFrame:
        """Minute metrics, at least those from the day of ``since`` on."""
        return self.minute_sums.totals(since=since).withColumn("avg_order_value", average_order_value())

    def product_sales_metrics(self, since: Column | None = None) -> DataFrame:
        return self.product_minute_sums.totals(since=since)

    def products(self, catalog: DataFrame) -> DataFrame:
        """``catalog`` with the stock left after all sales and restocks."""
        return apply_sales(catalog, self.units_sold.totals())

    def restock(self, catalog: DataFrame, levels: DataFrame, number: int) -> None:
        """Set the stock of the products in ``levels`` (product_id, stock_quantity) to these values.

        Kept as a movement beside the sales, so earlier and later sales count as they
        should. ``number`` names the restock and must grow; a number once used changes
        nothing more.
        """
        if self.log.committed(number, RESTOCK):
            return
        before = self.carried(number, RESTOCK)
        moved = restock_movements(catalog, before.sold(), levels).withColumn("part", F.lit(ALL)).persist()
        try:
            self.write_batch(number, RESTOCK, [(self.units_sold, moved)], before, before.next(moved))
        finally:
            moved.unpersist()

    def resolve(self, at: datetime | Column, number: int, chosen: Column | None = None) -> int:
        """Resolve all open alerts, or those ``chosen``, and return how many there were.

        A row beside the alerts, folded in when they are read; nothing is rewritten.
        ``number`` names the call: a number once used resolves nothing more.
        """
        if self.log.committed(number, RESOLVE):
            return 0
        found = open_alerts(self.alerts.read(), at, chosen).persist()
        try:
            n = found.count()
            self.write_batch(number, RESOLVE, [(self.resolutions, found)])
        finally:
            found.unpersist()
        return n
