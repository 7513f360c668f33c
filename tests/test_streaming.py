"""The order stream end to end, over landed files."""

import json
import os
from datetime import timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import T0, at, money, product_frame, rows
from retailpulse.config import DEFAULTS, Params, StreamParams
from retailpulse.operators import alerts as al
from retailpulse.operators import metrics, sketches
from retailpulse.plans.measures import evaluate
from retailpulse.session import shared_folder
from retailpulse.sources import events
from retailpulse.sources.tables import seed_rules
from retailpulse.streaming import ingest, monitor, native
from retailpulse.streaming import store as store_module
from retailpulse.streaming.store import Store


def order(i, minute, *items, **extra):
    lines = [{"product_id": p, "quantity": q, "unit_price": price} for p, q, price in items]
    return {
        "order_id": f"o{i}", "customer_id": "c",
        "order_timestamp": at(minute).strftime("%Y-%m-%dT%H:%M:%S.000+00:00"),
        "total_amount": sum(q * p for _, q, p in items), "item_count": sum(q for _, q, _ in items),
        "items": lines, **extra,
    }


def land(folder, name, documents):
    os.makedirs(folder, exist_ok=True)
    text = "\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents)
    (folder / name).write_text(text + "\n")


ORDERS = [order(i, i % 17 / 2, (1 + i % 3, 1 + i % 2, 2.5), (2, 1, 1.25)) for i in range(40)]


class Run:
    def __init__(self, spark, tmp_path, stock=((1, 500, 10), (2, 500, 10), (3, 500, 10)), params=DEFAULTS):
        self.spark, self.inbox = spark, tmp_path / "in"
        self.store = Store(spark, str(tmp_path / "out"))
        self.checkpoint = str(tmp_path / "cp")
        self.products = product_frame(spark, list(stock))
        self.handler = ingest.batch_handler(self.store, lambda: self.products, params)

    def drain(self, files_per_batch=None):
        decoded = events.decode(events.file_events(self.spark, str(self.inbox), files_per_batch))
        query = ingest.start(decoded, self.handler, self.checkpoint, drain=True)
        query.awaitTermination()

    def batch(self, documents):
        raw = self.spark.createDataFrame(
            [(d if isinstance(d, str) else json.dumps(d),) for d in documents], "json string"
        ).withColumn("arrived_at", F.lit(T0).cast("timestamp"))
        return events.decode(raw)

    def replay(self, documents, batch_id):
        self.handler(self.batch(documents), batch_id)

    def remembered_batch(self, documents, batch_id):
        """As a stream hands it over whose state has taken out repeated ids."""
        self.handler(ingest.remembered(self.batch(documents)), batch_id)

    def totals(self):
        return rows(self.store.sales_metrics(), "window_start", "revenue", "order_count", "item_count", "avg_order_value")


@pytest.fixture
def run(spark, tmp_path):
    return Run(spark, tmp_path)


def expected_minutes(spark):
    raw = spark.createDataFrame([(json.dumps(o),) for o in ORDERS], "json string").withColumn(
        "arrived_at", F.lit(T0).cast("timestamp")
    )
    sales = metrics.minute_sales(events.accepted(events.decode(raw)))
    return rows(sales, "window_start", "revenue", "order_count", "item_count", "avg_order_value")


def test_one_batch_or_many_give_the_same(spark, tmp_path):
    one, many = Run(spark, tmp_path / "one"), Run(spark, tmp_path / "many")
    land(one.inbox, "all.json", ORDERS)
    one.drain()
    for i in range(4):
        land(many.inbox, f"{i}.json", ORDERS[i::4])
    many.drain(files_per_batch=1)
    assert one.totals() == many.totals() == expected_minutes(spark)
    assert rows(one.store.product_sales_metrics()) == rows(many.store.product_sales_metrics())
    assert many.store.orders.read().count() == 40
    assert many.store.order_items.read().count() == 80
    day = F.date_trunc("day", "window_start").alias("day")
    for each in (one, many):
        (minutes,) = sketches.lag_summary(each.store.minute_sketches.totals(), day).collect()
        assert (minutes.order_count, minutes.n_events) == (40, 40) and minutes.p50_lag_ms > 0
    stock = {r.product_id: r.stock_after for r in many.store.inventory_log.read().orderBy("batch_id").collect()}
    sold = dict(rows(one.store.units_sold.totals()))
    assert stock == {p: 500 - q for p, q in sold.items()}


def test_replayed_batch_changes_nothing(run):
    run.replay(ORDERS[:25], 0)
    run.replay(ORDERS[25:], 1)
    before = run.totals(), rows(run.store.units_sold.totals()), rows(run.store.inventory_log.read())
    run.replay(ORDERS[25:], 1)
    assert (run.totals(), rows(run.store.units_sold.totals()), rows(run.store.inventory_log.read())) == before


def test_repeated_orders_count_once(spark, run):
    run.replay(ORDERS[:25] + ORDERS[:5], 0)
    run.replay(ORDERS[20:], 1)
    assert run.totals() == expected_minutes(spark)
    assert run.store.orders.read().count() == 40


def test_late_orders_count_and_bad_text_is_kept_aside(run):
    run.replay(ORDERS[:5], 0)
    late = order("late", -365 * 24 * 60, (1, 1, 9.0))
    run.replay([late, "{broken", json.dumps({"order_id": "x"})], 1)
    assert any(r[0] == at(-365 * 24 * 60) for r in run.totals())
    assert run.store.quarantine.read().count() == 2
    run.replay(["{only broken"], 2)
    assert run.store.quarantine.read().count() == 3


def test_restart_reads_only_new_files(run):
    land(run.inbox, "a.json", ORDERS[:10])
    run.drain()
    first = run.totals()
    run.drain()
    assert run.totals() == first
    land(run.inbox, "b.json", ORDERS[10:])
    run.drain()
    assert sum(r[2] for r in run.totals()) == 40


def test_empty_batch_writes_nothing(spark, run):
    run.replay([], 0)
    assert not os.path.exists(run.store.root)
    assert run.totals() == []


def test_low_stock_alerts_with_cooldown_and_unknown_products(spark, tmp_path):
    run = Run(spark, tmp_path, stock=((1, 12, 10), (2, 100, 10)))
    run.replay([order("a", 0, (1, 3, 1.0), (77, 2, 1.0))], 0)
    run.replay([order("b", 5, (1, 20, 1.0))], 1)      # worse, but within 10 minutes
    run.replay([order("c", 11, (2, 1, 1.0))], 2)      # scans all products again
    alerts = rows(run.store.alerts.read(), "batch_id", "entity_id", "severity")
    assert alerts == [(0, "1", "WARNING"), (2, "1", "CRITICAL")]
    assert rows(run.store.unknown_products.read(), "product_id", "qty") == [(77, 2)]
    assert rows(run.store.inventory_log.read(), "batch_id", "product_id", "quantity_change", "stock_after") == [
        (0, 1, -3, 9), (1, 1, -20, 0), (2, 2, -1, 99)
    ]


def test_compaction_keeps_totals_and_accepts_late_batches(spark, run):
    run.replay(ORDERS[:15], 0)
    run.replay(ORDERS[15:30], 1)
    before = run.totals()
    run.store.compact(1)
    assert run.totals() == before
    run.replay(ORDERS[30:], 2)
    assert run.totals() == expected_minutes(spark)
    run.store.compact(2)
    run.store.compact(2)
    assert run.totals() == expected_minutes(spark)
    # Running the last batch again still sees only the batches before it.
    run.replay(ORDERS[30:], 2)
    assert run.totals() == expected_minutes(spark)


def test_monitor_raises_each_alert_once(spark, run):
    quiet = [order(i, i, (1, 1 + i % 2, 1.0)) for i in range(14)]
    run.replay([*quiet, order("burst", 14, (1, 400, 1.0))], 0)
    rules = seed_rules(spark)
    monitor.evaluate_once(run.store, run.products, rules, at(15), 1)
    first = rows(run.store.alerts.read().filter("batch_id = -1"), "alert_type", "entity_id")
    assert ("REVENUE_SPIKE", "2024-03-01 12:14:00") in first
    monitor.evaluate_once(run.store, run.products, rules, at(15), 1)
    assert rows(run.store.alerts.read().filter("batch_id = -1"), "alert_type", "entity_id") == first
    monitor.evaluate_once(run.store, run.products, rules, at(16), 2)
    second = rows(run.store.alerts.read().filter("batch_id = -2"), "alert_type", "entity_id")
    assert not set(second) & {a for a in first if a[0] == "REVENUE_SPIKE"}


def test_a_new_checkpoint_keeps_what_is_stored(spark, run):
    land(run.inbox, "a.json", ORDERS[:20])
    run.drain()
    run.checkpoint += "-new"
    land(run.inbox, "b.json", ORDERS[20:])
    run.drain()
    assert run.totals() == expected_minutes(spark)
    assert run.store.orders.read().count() == 40
    assert run.store.orders.read().select("run").distinct().count() == 2
    run.store.compact(0)
    assert run.totals() == expected_minutes(spark)


def test_a_rerun_without_alerts_clears_the_old_ones(spark, run):
    quiet = [order(i, i, (1, 1, 1.0)) for i in range(14)]
    run.replay([*quiet, order("burst", 14, (1, 400, 1.0))], 0)
    rules = seed_rules(spark)
    monitor.evaluate_once(run.store, run.products, rules, at(15), 1)
    assert run.store.alerts.read().filter("run = 'monitor'").count() > 0
    nothing = run.store.alerts.read().filter("false").select(*[f.name for f in run.store.alerts.schema.fields], "part")
    run.store.alerts.write(nothing, -1, monitor.MONITOR)
    assert run.store.alerts.read().filter("run = 'monitor'").count() == 0


def test_a_batch_that_broke_off_between_two_tables_is_made_whole(spark, run, monkeypatch):
    run.replay(ORDERS[:20], 0)
    broken = type(run.store.units_sold)
    write = broken.write

    def fails(self, df, batch_id, run="main"):
        if self.path.endswith("units_sold"):
            raise OSError("lost")
        write(self, df, batch_id, run)

    monkeypatch.setattr(broken, "write", fails)
    with pytest.raises(OSError):
        run.replay(ORDERS[20:], 1)
    monkeypatch.setattr(broken, "write", write)
    run.replay(ORDERS[20:], 1)
    assert run.totals() == expected_minutes(spark)
    assert sum(q for _, q in rows(run.store.units_sold.totals())) == sum(o["item_count"] for o in ORDERS)


def test_one_id_with_two_timestamps_counts_once(spark, tmp_path):
    pair = [order("same", 0, (1, 1, 2.0)), order("same", 120, (1, 1, 2.0))]
    together, apart = Run(spark, tmp_path / "a"), Run(spark, tmp_path / "b")
    together.replay(pair, 0)
    for k, one in enumerate(pair):
        apart.replay([one], k)
    assert together.store.orders.read().count() == apart.store.orders.read().count() == 1


def test_late_orders_do_not_turn_the_clock_back(spark, tmp_path):
    run = Run(spark, tmp_path, stock=((1, 12, 10), (2, 100, 10)))
    run.replay([order("now", 0, (2, 1, 1.0))], 0)
    run.replay([order("late", -30 * 24 * 60, (1, 3, 1.0))], 1)
    assert rows(run.store.alerts.read(), "detected_at", "entity_id") == [(at(0), "1")]


def test_monitor_and_readers_see_the_stock_left(spark, tmp_path):
    run = Run(spark, tmp_path, stock=[(p, 40, 10) for p in range(1, 20)])
    run.replay([order(p, 0, (p, 50, 1.0)) for p in range(1, 20)], 0)
    assert {q for _, q in rows(run.store.products(run.products), "product_id", "stock_quantity")} == {0}
    monitor.evaluate_once(run.store, run.products, seed_rules(spark), at(1), 1)
    alerts = rows(run.store.alerts.read(), "entity_id", "severity")
    assert ("low_stock_count", "CRITICAL") in alerts
    levels = spark.createDataFrame([(1, 30), (2, 5)], "product_id int, stock_quantity int")
    run.store.restock(run.products, levels, 0)
    run.store.restock(run.products, levels, 0)
    run.replay([order("more", 2, (1, 4, 1.0))], 1)
    stock = dict(rows(run.store.products(run.products), "product_id", "stock_quantity"))
    assert (stock[1], stock[2], stock[3]) == (26, 5, 0)


def test_a_session_without_a_shared_folder_is_refused():
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ValueError, match="share"):
        shared_folder(bare)


# --- stateful queries ------------------------------------------------------------------

def native_query(spark, tmp_path, build, mode, batches):
    folder = tmp_path / "in"
    name = f"t{abs(hash(str(tmp_path))) % 10**8}"
    land(folder, "000.json", batches[0])
    orders = events.read_orders(events.file_events(spark, str(folder)))
    query = (
        build(orders).writeStream.outputMode(mode).format("memory").queryName(name)
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    try:
        query.processAllAvailable()
        for i, documents in enumerate(batches[1:], 1):
            land(folder, f"{i:03}.json", documents)
            query.processAllAvailable()
    finally:
        query.stop()
    return spark.table(name)


def test_native_minutes_drop_what_is_too_late(spark, tmp_path):
    batches = [ORDERS, [order("mark", 60, (1, 1, 1.0))], [order("late", 1, (1, 1, 99.0))], [order("end", 120, (1, 1, 1.0))]]
    final = native_query(spark, tmp_path, native.minute_sales_stream, "append", batches)
    got = rows(final, "window_start", "revenue", "order_count", "item_count", "avg_order_value")
    assert [r for r in got if r[0] < at(60)] == expected_minutes(spark)


def test_native_deduplication_and_stock(spark, tmp_path):
    products = product_frame(spark, [(1, 10, 3), (2, 10, 3)])

    def build(orders):
        return native.stock_stream(orders, products)

    batches = [[order("a", 0, (1, 4, 1.0))], [order("b", 1, (1, 9, 1.0), (2, 1, 1.0))]]
    updates = native_query(spark, tmp_path / "s", build, "update", batches)
    assert set(rows(updates, "product_id", "units_sold", "stock_after")) == {(1, 4, 6), (1, 13, 0), (2, 1, 9)}
    unique = native_query(
        spark, tmp_path / "d", native.deduplicated, "append", [[order("a", 0, (1, 1, 1.0))] * 2, [order("a", 0, (1, 1, 1.0))]]
    )
    assert unique.count() == 1


def files_read(monkeypatch, run, documents, batch_id):
    """Files that a batch names to Spark, its own input and output apart."""
    named = []
    read = store_module._written

    def counted(spark, path, schema):
        found = read(spark, path, schema)
        if found is not None:
            named.extend(f for f in found.inputFiles())
        return found

    with monkeypatch.context() as m:
        m.setattr(store_module, "_written", counted)
        run.remembered_batch(documents, batch_id)
    return len(named)


def test_a_batch_reads_no_more_after_many_batches(spark, run, monkeypatch):
    counts = [files_read(monkeypatch, run, ORDERS[k:k + 1], k) for k in range(14)]
    assert counts[2] > 0 and set(counts[2:]) == {counts[2]}
    assert run.store.orders.read().count() == 14
    # The clock is one carried number, not a look at all orders.
    newest = max(r[0] for r in rows(run.store.orders.read(), "order_timestamp"))
    assert spark.range(1).select(run.store.carried(14).newest_order()).first()[0] == newest


def test_a_repeat_after_any_time_counts_once(spark, run):
    for k in range(3):
        land(run.inbox, f"{k}.json", [*ORDERS[k * 10:k * 10 + 10], order(0, 999_999, (1, 9, 9.0)), "{broken", "{broken"])
        run.drain()
    assert run.store.orders.read().count() == 30
    assert run.store.quarantine.read().count() == 1
    # A new checkpoint forgets its state, so what other runs stored is looked up.
    run.checkpoint += "-new"
    land(run.inbox, "last.json", ORDERS)
    run.drain()
    assert run.store.orders.read().count() == 40
    assert rows(run.store.units_sold.totals()) == rows(spark.createDataFrame(
        [(p, sum(i["quantity"] for o in ORDERS for i in o["items"] if i["product_id"] == p)) for p in (1, 2, 3)], "product_id int, quantity long"
    ))


def test_half_a_batch_is_not_seen(spark, run, monkeypatch):
    run.replay(ORDERS[:20], 0)
    seen = run.totals(), rows(run.store.units_sold.totals()), run.store.orders.read().count(), run.store.order_items.read().count()
    write = store_module.BatchTable.write

    def fails(self, df, batch_id, run="main"):
        if self.path.endswith("minute_sums"):
            raise OSError("lost")
        write(self, df, batch_id, run)

    monkeypatch.setattr(store_module.BatchTable, "write", fails)
    with pytest.raises(OSError):
        run.replay(ORDERS[20:], 1)
    assert os.path.isdir(f"{run.store.root}/orders/run=main/batch_id=1")
    assert seen == (run.totals(), rows(run.store.units_sold.totals()), run.store.orders.read().count(), run.store.order_items.read().count())
    monkeypatch.setattr(store_module.BatchTable, "write", write)
    run.replay(ORDERS[20:], 1)
    assert run.totals() == expected_minutes(spark)
    assert run.store.orders.read().count() == 40


def everything(store):
    out = {}
    for table in store.tables:
        df = table.totals() if isinstance(table, store_module.AdditiveTable) else table.read()
        if isinstance(table, store_module.SketchTable):
            df = sketches.lag_summary(df, "window_start")
        out[table.path.rsplit("/", 1)[1]] = rows(df.drop("part"))
    return out


def test_all_tables_compact_and_clear(spark, tmp_path):
    params = Params(stream=StreamParams(compact_every=2))
    often, never = Run(spark, tmp_path / "often", ((1, 12, 10), (2, 20, 10)), params), Run(spark, tmp_path / "never", ((1, 12, 10), (2, 20, 10)))
    for k in range(3):
        for one in (often, never):
            one.replay([*ORDERS[k * 13:k * 13 + 13], f"{{broken {k}"], k)
    assert often.store.log.compacted().through == {"main": 1}
    assert everything(often.store) == everything(never.store)
    # Compacted batches are no longer read one by one.
    assert often.store.log.batches(often.store.log.compacted()).count() == 1
    broken = often.store.log.note
    often.store.log.note = lambda now: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        often.store.compact(2)
    often.store.log.note = broken
    assert everything(often.store) == everything(never.store)
    often.store.compact(2)
    assert everything(often.store) == everything(never.store)
    often.store.clear()
    assert not any(everything(often.store).values())
    often.replay(ORDERS[:3], 3)
    assert often.store.orders.read().count() == 3
    assert rows(often.store.products(often.products), "product_id", "stock_quantity") == [(1, 11), (2, 15)]


def test_alerts_have_an_identity_and_can_be_resolved(spark, tmp_path):
    run = Run(spark, tmp_path, stock=((1, 12, 10), (2, 12, 10)))
    run.replay([order("a", 0, (1, 3, 1.0))], 0)
    run.replay([order("b", 11, (2, 12, 1.0))], 1)
    store = run.store
    first = rows(store.alerts.read(), "alert_id", "detected_at", "entity_id")
    assert len({r[0] for r in first}) == len(first) == 3
    feed = al.alert_feed(store.alerts.read()).collect()
    assert [(r.entity_id, r.detected_at) for r in feed][-1] == ("1", at(0)) and len(feed) == 3
    change = rows(al.value_change(store.alerts.read()), "entity_id", "detected_at", "previous_value", "change")
    assert [(r[0], r[1], r[2], r[3]) for r in change if r[2] is not None] == [("1", at(11), money("9.0000"), money("0.0000"))]
    assert al.alert_log(store.alerts.read()).count() == 3
    assert store.resolve(at(12), 1, F.col("entity_id") == "2") == 1
    assert store.resolve(at(13), 1) == 0 and store.resolve(at(13), 2) == 2 and store.resolve(at(14), 3) == 0
    state = rows(store.alerts.read(), "entity_id", "detected_at", "resolved", "resolved_at")
    assert state == [("1", at(0), True, at(13)), ("1", at(11), True, at(13)), ("2", at(11), True, at(12))]
    assert al.alert_feed(store.alerts.read()).count() == 0
    assert evaluate({"alerts": store.alerts.read()}, ["active_alerts"], at(15)).first()[0] in (None, 0)
    # A repeated run raises the same alerts with the same ids, still resolved; new ones are open.
    assert rows(store.alerts.read(), "alert_id", "detected_at", "entity_id") == first
    run.replay([order("c", 30, (1, 1, 1.0))], 2)
    assert al.unresolved(store.alerts.read()).count() == 2
    store.compact(2)
    assert al.unresolved(store.alerts.read()).count() == 2 and store.alerts.read().count() == 5


def test_a_repeated_stream_step_keeps_its_alerts(spark, run):
    ddl = "alert_type string, severity string, entity_type string, entity_id string, message string, detected_at timestamp, resolved boolean"
    due = spark.createDataFrame([("LOW_STOCK", "HIGH", "PRODUCT", "1", "m", at(0), False)], ddl)
    empty = [F.lit(None).alias(c) for c in ("detected_value", "expected_low", "expected_high")]
    for name in ("main", "some-query"):
        for _ in range(2):
            step = monitor.alert_stream_step(run.store, due.withColumn("entity_id", F.lit(name)), ["alert_type", "entity_id"], 5, 7, name)
            assert step.count() == 1
            run.store.alerts.write(step.select("*", *empty, F.lit("2024-03-01").alias("part")), 7, name)
            run.store.commit(7, name)


def test_cooldown_step_continues_between_batches(spark, run):
    ddl = "alert_type string, severity string, entity_type string, entity_id string, message string, detected_at timestamp, resolved boolean"
    stamps = [0, 3, 6, 9, 11, 12, 16, 17, 30]
    for batch_id, part in enumerate([stamps[:4], stamps[4:6], stamps[6:]]):
        data = [("LOW_STOCK", "HIGH", "PRODUCT", "1", "m", at(m), False) for m in part]
        due = monitor.alert_stream_step(run.store, spark.createDataFrame(data, ddl), ["alert_type", "entity_id"], 5, batch_id)
        empty = [F.lit(None).alias(c) for c in ("detected_value", "expected_low", "expected_high")]
        run.store.alerts.write(due.select("*", *empty, F.date_format("detected_at", "yyyy-MM-dd").alias("part")), batch_id)
        run.store.commit(batch_id)
    assert sorted(r[0] for r in rows(run.store.alerts.read(), "detected_at")) == [at(m) for m in (0, 6, 11, 16, 30)]


def test_lag_stream(spark, tmp_path):
    lag = native_query(spark, tmp_path, native.lag_stream, "update", [[order("a", 0, (1, 1, 1.0))]])
    (row,) = lag.collect()
    assert row.n_events == 1 and row.avg_lag_ms > timedelta(days=1).total_seconds() * 1000
