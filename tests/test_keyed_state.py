"""Cooldown and stock as keyed state: any cutting into batches, late rows and restarts give the batch result."""

import json
import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import T0, at, product_frame, rows
from retailpulse.operators import cooldown, inventory, metrics, series
from retailpulse.streaming import keyed

ALERT = "alert_type string, entity_id string, number long, value decimal(14,4), detected_at timestamp"
LINE = "product_id int, quantity int, order_timestamp timestamp"
LEVEL = "product_id int, stock_quantity int, restocked_at timestamp"


def land(folder, n, documents):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{n:03}.json", "w") as out:
        out.writelines(json.dumps(d, default=lambda x: x.isoformat()) + "\n" for d in documents)


class Query:
    """A streaming query over landed files, stopped and started again between batches if asked."""

    def __init__(self, spark, tmp_path, build, mode):
        self.spark, self.tmp_path, self.build, self.mode = spark, tmp_path, build, mode
        self.query, self.starts, self.out = None, 0, []

    def _start(self):
        def keep(batch, batch_id):
            self.out.append((batch_id, batch.collect()))

        self.query = (
            self.build().writeStream.outputMode(self.mode).foreachBatch(keep)
            .option("checkpointLocation", str(self.tmp_path / "cp")).start()
        )

    def settle(self, restart=False):
        if self.query is None:
            self._start()
        self.query.processAllAvailable()
        if restart:
            self.stop()

    def stop(self):
        if self.query is not None:
            self.query.stop()
            self.query = None

    def rows(self):
        return [r for _, batch in sorted(self.out, key=lambda x: x[0]) for r in batch]


def read(spark, folder, schema):
    os.makedirs(folder, exist_ok=True)
    return spark.readStream.schema(schema).json(str(folder))


def random_alerts(seed, n=60):
    rng = random.Random(seed)
    found = []
    for k in range(n):
        moment = T0 + timedelta(seconds=rng.randrange(0, 3600), microseconds=rng.choice([0, 1, 999_999]))
        found.append({"alert_type": rng.choice(["A", "B", None]), "entity_id": str(rng.randrange(2)), "number": k,
                      "value": round(rng.random(), 4), "detected_at": moment})
    return found


@pytest.mark.parametrize("cut, restart", [([60], False), ([17, 30, 60], True)])
def test_cooldown_stream_equals_the_replay(spark, tmp_path, cut, restart):
    alerts = random_alerts(4)
    keys = ["alert_type", "entity_id"]
    query = Query(spark, tmp_path, lambda: keyed.cooldown_stream(read(spark, tmp_path / "in", ALERT), keys, "detected_at", 7, "number", "2 hours"), "append")
    end = [{"alert_type": "end", "entity_id": "", "number": -1, "value": 0, "detected_at": at(m)} for m in (400, 800)]
    start = 0
    try:
        for n, stop in enumerate(cut):
            land(tmp_path / "in", n, alerts[start:stop])
            query.settle(restart)
            start = stop
        for n, mark in enumerate(end):
            land(tmp_path / "in", 100 + n, [mark])
            query.settle()
    finally:
        query.stop()
    whole = spark.read.schema(ALERT).json(str(tmp_path / "in")).filter("alert_type IS NULL OR alert_type <> 'end'")
    want = cooldown.suppress_repeats(whole.na.fill("null"), keys, "detected_at", 7, "number")
    got = [(r.alert_type or "null", *r[1:]) for r in query.rows() if r.alert_type != "end"]
    assert sorted(got, key=repr) == rows(want) and 10 < len(got) < 60


def movements(seed):
    rng = random.Random(seed)
    sales = [{"product_id": rng.randrange(1, 4), "quantity": rng.randrange(1, 4), "order_timestamp": at(rng.randrange(60))} for _ in range(50)]
    levels = [{"product_id": rng.randrange(1, 3), "stock_quantity": rng.randrange(5, 60), "restocked_at": at(rng.randrange(60))} for _ in range(8)]
    return sales, levels


@pytest.mark.parametrize("cut", [1, 3])
def test_keyed_stock_equals_the_batch_after_any_interleaving(spark, tmp_path, cut):
    sales, levels = movements(cut)
    # A restock of long ago comes last: the sales after it still count. One product is not in the catalog.
    levels.append({"product_id": 3, "stock_quantity": 500, "restocked_at": at(30)})
    sales.append({"product_id": 99, "quantity": 1, "order_timestamp": at(5)})
    products = product_frame(spark, [(1, 40, 1), (2, 30, 1), (3, 20, 1), (4, 10, 1)])

    def build():
        return keyed.keyed_stock_stream(read(spark, tmp_path / "lines", LINE), read(spark, tmp_path / "levels", LEVEL), products, "2 hours")

    query = Query(spark, tmp_path, build, "update")
    try:
        for n in range(cut):
            land(tmp_path / "lines", n, sales[n::cut])
            land(tmp_path / "levels", n, levels[n * len(levels) // cut:(n + 1) * len(levels) // cut])
            query.settle(restart=n == 1)
        # Far later movements settle what is behind the watermark; nothing of it is lost.
        for n, minute in ((50, 300), (51, 600)):
            more = [{"product_id": p, "quantity": 1, "order_timestamp": at(minute)} for p in (1, 2, 3)]
            sales += more
            land(tmp_path / "lines", n, more)
            query.settle()
    finally:
        query.stop()
    want = inventory.stock_after_movements(
        products, spark.read.schema(LINE).json(str(tmp_path / "lines")), spark.read.schema(LEVEL).json(str(tmp_path / "levels"))
    )
    got = {r.product_id: r.stock_quantity for r in query.rows()}
    assert got == {p: q for p, q in rows(want, "product_id", "stock_quantity") if p != 4}


def test_stock_after_movements_matches_a_loop(spark):
    sales, levels = movements(9)
    products = product_frame(spark, [(p, 25, 1) for p in range(1, 5)])
    stock = {p: 25 for p in range(1, 5)}
    moves = [(s["order_timestamp"], 0, s["product_id"], s["quantity"]) for s in sales] + [(r["restocked_at"], 1, r["product_id"], r["stock_quantity"]) for r in levels]
    for _, kind, product, amount in sorted(moves, key=lambda m: (m[0], m[1], m[3])):
        stock[product] = amount if kind else max(0, stock[product] - amount)
    found = inventory.stock_after_movements(
        products, spark.createDataFrame([tuple(s.values()) for s in sales], LINE), spark.createDataFrame([tuple(r.values()) for r in levels], LEVEL)
    )
    assert dict(rows(found, "product_id", "stock_quantity")) == stock


ORDER = "shop string, total_amount decimal(12,2), item_count int, order_timestamp timestamp"


def random_orders(seed, n=300):
    rng = random.Random(seed)
    # Gaps of minutes and of hours, and a minute of its own size now and then.
    found = []
    for _ in range(n):
        minute = rng.choice([rng.randrange(0, 50), rng.randrange(90, 130), rng.randrange(300, 330)])
        amount = rng.choice([rng.randrange(100, 9_000), 1_000_000 if rng.random() < 0.05 else 77]) / 100
        found.append({"shop": rng.choice(["a", "b", None]), "total_amount": amount, "item_count": 1, "order_timestamp": at(minute + rng.random() * 0.9)})
    return found


@pytest.mark.parametrize("by, cut, restart", [(None, [300], False), ("shop", [70, 200, 300], True)])
def test_trailing_stream_equals_the_batch(spark, tmp_path, by, cut, restart):
    orders = random_orders(6)
    if restart:
        # Roughly in order, so that minutes close in several batches, with rows up to half an hour late.
        orders.sort(key=lambda o: o["order_timestamp"] + timedelta(minutes=random.Random(str(o)).randrange(30)))
    build = lambda: keyed.trailing_stream(read(spark, tmp_path / "in", ORDER), delay="40 minutes" if restart else "9 hours", series=by)
    query = Query(spark, tmp_path, build, "append")
    end = [{"shop": "end", "total_amount": 1, "item_count": 1, "order_timestamp": at(m)} for m in (2000, 4000)]
    start = 0
    try:
        for n, stop in enumerate(cut):
            land(tmp_path / "in", n, orders[start:stop])
            query.settle(restart)
            start = stop
        for n, mark in enumerate(end):
            land(tmp_path / "in", 100 + n, [mark])
            query.settle()
    finally:
        query.stop()
    batches = {batch for batch, some in query.out if any(r.window_start < at(1000) for r in some)}
    assert len(batches) > 1 or not restart
    whole = spark.read.schema(ORDER).json(str(tmp_path / "in")).filter(F.col("order_timestamp") < F.lit(at(1000)))
    whole = whole.withColumn("series", F.coalesce(by, F.lit("null")) if by else F.lit("all"))
    minutes = metrics.minute_sales(whole, by=["series"])
    tests = {(r.series, r.window_start): r for r in series.trailing_zscore(minutes, ["series"]).collect()}
    sales = {(r.series, r.window_start): r for r in series.rolling_sales(minutes, ["series"]).collect()}
    got = {(r.series or "null", r.window_start): r for r in query.rows() if r.window_start < at(1000)}
    assert got.keys() == tests.keys() and len(got) == sum(r.window_start < at(1000) for r in query.rows())
    assert any(r.z is not None and r.z > 3 for r in got.values())
    for key, r in got.items():
        test, sale = tests[key], sales[key]
        assert (r.revenue, r.order_count, r.n_history) == (test.revenue, test.order_count, test.n_history)
        assert (r.revenue_5m, r.orders_5m, r.revenue_1h, r.orders_1h) == (sale.revenue_5m, sale.orders_5m, sale.revenue_1h, sale.orders_1h)
        for column in ("mean_revenue", "std_revenue", "z"):
            value, want = r[column], test[column]
            assert (value is None) == (want is None) and (want is None or value == pytest.approx(want, rel=1e-6, abs=1e-6)), (key, column)
