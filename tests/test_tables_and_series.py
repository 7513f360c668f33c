"""Shaping, merges, inventory, measures and series, with their invariants."""

import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA, T0, at, money, product_frame, rows, sales_frame
from retailpulse.config import CatalogParams
from retailpulse.operators import basket, calendar, inventory, merge, metrics, series, shape, star
from retailpulse.plans.measures import MEASURES, evaluate, star_model
from retailpulse.sources import catalog, events, tables

LINE_DDL = "order_id string, product_id int, quantity int, unit_price decimal(10,2)"
ORDER_DDL = (
    "order_id string, customer_id string, order_timestamp timestamp, total_amount decimal(12,2), "
    "item_count int, status string"
)


def orders_frame(spark, n, seed=0, minutes=30):
    rng = random.Random(seed)
    data = [
        (f"o{i}", "c", at(rng.uniform(0, minutes)), money(rng.randint(1, 9999) / 100), rng.randint(1, 5), "CREATED")
        for i in range(n)
    ]
    return spark.createDataFrame(data, ORDER_DDL)


# --- payloads -------------------------------------------------------------------

GOOD = {
    "order_id": "a", "customer_id": "c", "order_timestamp": "2024-01-01T10:00:00.123+00:00",
    "total_amount": 12.345, "item_count": 3,
    "items": [{"product_id": 1, "quantity": 3, "unit_price": 4.0, "product_name": "x", "category": "y", "line_total": 99}],
}


def decode(spark, *texts):
    raw = spark.createDataFrame([(t,) for t in texts], "json string").withColumn(
        "arrived_at", F.lit(T0).cast("timestamp")
    )
    return events.decode(raw)


def test_decode_rounds_defaults_and_quarantines(spark):
    no_items = {**GOOD, "order_id": "b", "items": None}
    empty = {**GOOD, "order_id": "d", "items": []}
    broken = ['{"order_id": "x", "customer_id"', "nonsense", json.dumps({**GOOD, "order_id": None})]
    decoded = decode(spark, json.dumps(GOOD), json.dumps(no_items), json.dumps(empty), *broken)
    good = events.accepted(decoded)
    assert rows(good, "order_id", "total_amount") == [(k, money("12.35")) for k in "abd"]
    assert events.quarantined(decoded).count() == 3
    assert rows(shape.order_headers(good), "status") == [("CREATED",)] * 3
    lines = shape.with_line_total(shape.order_lines(good)).collect()
    assert [(r.order_id, r.product_id, r.line_total) for r in lines] == [("a", 1, money("12.00"))]


def test_encode_round_trip(spark):
    decoded = events.accepted(decode(spark, json.dumps(GOOD)))
    messages = events.encode(decoded)
    assert messages.first().key == "a"
    again = events.accepted(events.decode(messages.select(
        F.col("value").alias("json"), F.lit(None).cast("timestamp").alias("arrived_at")
    )))
    assert again.drop("arrived_at").collect() == decoded.drop("arrived_at").collect()


# --- shaping ----------------------------------------------------------------------

def test_nest_makes_one_document_of_any_order(spark):
    data = [("big", i % 40, 1 + i % 3, money("2.50")) for i in range(12_000)]
    data += [("copies", 7, 1, money("1.00"))] * 500 + [("small", 1, 2, money("3.00"))]
    lines = spark.createDataFrame(data, LINE_DDL)
    nested = shape.nest_orders(lines, ["product_id", "quantity", "unit_price"])
    sizes = {d.order_id: len(d["items"]) for d in nested.collect()}
    assert nested.count() == 3 and sizes == {"big": 12_000, "copies": 500, "small": 1}
    assert rows(shape.order_lines(nested)) == rows(lines)
    (small,) = [d for d in nested.collect() if d.order_id == "small"]
    assert (small.total_amount, small.item_count) == (money("6.00"), 2)


def test_trailing_is_inclusive(spark):
    frame = sales_frame(spark, [(0, 1, 1), (5, 2, 1), (6, 3, 1)])
    assert rows(shape.trailing(frame, "window_start", at(10), 5), "revenue") == [(money("2.00"),), (money("3.00"),)]


def test_fit_widths(spark):
    frame = spark.createDataFrame([("n" * 600, None)], "name string, image_url string")
    row = shape.fit_widths(frame).first()
    assert (len(row.name), row.image_url) == (490, "")


# --- merges --------------------------------------------------------------------------

def test_additive_merge_is_independent_of_the_split(spark):
    orders = orders_frame(spark, 300)
    whole = metrics.minute_sales(orders)
    split = F.pmod(F.hash("order_id"), F.lit(3))
    parts = [metrics.minute_sales(orders.filter(split == i)) for i in range(3)]
    left = merge.merge_minute_sales(merge.merge_minute_sales(parts[0], parts[1]), parts[2])
    right = merge.merge_minute_sales(parts[2], merge.merge_minute_sales(parts[1], parts[0]))
    columns = ["window_start", "revenue", "order_count", "item_count", "avg_order_value"]
    assert rows(left, *columns) == rows(right, *columns) == rows(whole, *columns)


def test_catalog_merge_rules(spark):
    stored = product_frame(spark, [(1, 7, 3), (2, None, None)])
    incoming = product_frame(spark, [(1, 100, 20), (2, 100, 20), (3, 100, 20)]).withColumn("price", F.lit(9).cast("decimal(10,2)"))
    refreshed = rows(merge.merge_catalog(stored, incoming), "product_id", "price", "stock_quantity", "reorder_threshold")
    assert refreshed == [(1, money("9.00"), 7, 3), (2, money("9.00"), 100, 20), (3, money("9.00"), 100, 20)]
    seeded = rows(merge.merge_catalog(stored, incoming, merge.RESTOCK), "product_id", "stock_quantity", "reorder_threshold")
    assert seeded == [(1, 100, 3), (2, 100, None), (3, 100, 20)]
    once = merge.merge_catalog(stored, incoming)
    assert rows(merge.merge_catalog(once, incoming)) == rows(once)


def test_catalog_documents(spark, tmp_path):
    documents = [
        {"id": 1, "title": "A", "price": 9.99, "category": "x", "description": "d", "image": "i", "rating": {"rate": 3.9, "count": 120}},
        {"id": 2, "title": "B", "price": 5, "category": "y"},
    ]
    (tmp_path / "p.json").write_text(json.dumps(documents))
    loaded = catalog.product_documents(spark, str(tmp_path / "p.json"))
    assert rows(catalog.categories(loaded)) == [("x",), ("y",)]
    first = catalog.hydrate(loaded)
    got = rows(first, "product_id", "stock_quantity", "reorder_threshold", "popularity_weight", "rating_count", "image_url")
    # 80 + 12 * sqrt(120) = 211.4; 1 + log10(121) = 3.08; a missing rating counts as one.
    assert got == [(1, 211, 42, money("3.08"), 120, "i"), (2, 92, 18, money("1.30"), 0, "")]
    assert rows(tables.catalog_scan(first), "product_id") == [(1,), (2,)]
    assert tables.catalog_scan(first, "elsewhere").count() == 0
    assert tables.find_product(first, 2).first().name == "B"
    assert tables.find_product(first, 3).count() == 0
    sold = first.withColumn("stock_quantity", F.lit(1))
    again = catalog.hydrate(loaded, sold.select(*first.columns), CatalogParams())
    assert rows(again, "stock_quantity") == [(1,), (1,)]


def test_carts(spark, tmp_path):
    carts = [{"id": 1, "products": [{"productId": 1, "quantity": 12}, {"productId": 2}]}, {"id": 2}, {"id": 3, "products": [{"quantity": 1}] * 10}]
    (tmp_path / "c.json").write_text(json.dumps(carts))
    sizes, quantities = basket.cart_histograms(catalog.cart_documents(spark, str(tmp_path / "c.json")))
    assert rows(sizes) == [(0, 1), (2, 1), (8, 1)]
    assert rows(quantities) == [(1, 11), (8, 1)]
    assert rows(basket.or_default(sizes, basket.DEFAULT_SIZES)) == rows(sizes)
    assert rows(basket.or_default(sizes.filter("false"), basket.DEFAULT_QUANTITIES)) == [(1, 70), (2, 20), (3, 7), (4, 2), (5, 1)]


def test_tables_on_disk(spark, tmp_path):
    root = str(tmp_path)
    tables.reset_tables(spark, root, ["order_items", "products"])
    frame = spark.createDataFrame([("a", 1, 2, money("3.00"), money("6.00"))], LINE_DDL + ", line_total decimal(12,2)")
    tables.append_parquet(frame, root, "order_items")
    tables.append_parquet(frame, root, "order_items")
    read = {name: tables.read_table(spark, root, name) for name in ("order_items", "products")}
    assert rows(tables.row_counts(read)) == [("order_items", 2), ("products", 0)]
    tables.register_bi_tables(spark, root, ["order_items"])
    assert spark.sql("SELECT sum(line_total) s FROM order_items").first().s == money("12.00")
    tables.reset_tables(spark, root, ["order_items"])
    assert tables.read_table(spark, root, "order_items").count() == 0


# --- inventory ----------------------------------------------------------------------

def sales_of(spark, n, products=4, seed=1, minutes=3000):
    rng = random.Random(seed)
    data = [
        # Product 1 takes most of the sales.
        (i, rng.choice([1] * 6 + list(range(1, products + 1))), rng.randint(1, 3), at(rng.choice([rng.uniform(0, minutes), 5])))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "event_id bigint, product_id int, quantity int, order_timestamp timestamp"), data


@pytest.mark.parametrize("crowded", [1_000_000, 100, 3])
def test_running_stock_matches_a_loop_and_the_decrement(spark, monkeypatch, crowded):
    """Low limits make busy days and minutes crowded ones."""
    monkeypatch.setattr(series, "TIE_RANGE", 50 if crowded == 3 else 1_000_000)
    products = product_frame(spark, [(i, 300, 10) for i in range(1, 5)])
    sales, data = sales_of(spark, 800)
    got = {r.event_id: r.stock_after for r in inventory.running_stock(products, sales, "order_timestamp", "event_id").collect()}
    stock, expected = {i: 300 for i in range(1, 5)}, {}
    for event, product, quantity, _ in sorted(data, key=lambda r: (r[3], r[0])):
        stock[product] = max(0, stock[product] - quantity)
        expected[event] = stock[product]
    assert got == expected
    assert dict(rows(inventory.apply_sales(products, sales), "product_id", "stock_quantity")) == stock


def test_unknown_products_are_set_aside(spark):
    products = product_frame(spark, [(1, 5, 10)])
    sales = spark.createDataFrame([(1, 9), (2, 4)], "product_id int, quantity int")
    assert rows(inventory.unknown_products(products, sales)) == [(2, 4)]
    assert rows(inventory.sale_movements(products, sales)) == [(1, "SALE", -9, 0)]


# --- series ----------------------------------------------------------------------------

def test_trailing_window_across_blocks(spark):
    rng = random.Random(4)
    points = sorted(rng.sample(range(0, 4000), 700))
    frame = sales_frame(spark, [(m, 1 + m % 17, 1) for m in points])
    for current, span in ((False, 1740), (True, 240)):
        got = series.trailing_window(
            frame, [], "window_start", span, current, {"n": F.count("*"), "s": F.sum("revenue")}, block_seconds=3600
        )
        for r in got.collect():
            m = (r.window_start - T0).total_seconds() / 60
            inside = [p for p in points if m - span / 60 <= p <= m and (current or p != m)]
            assert r.n == len(inside)
            assert (r.s or 0) == sum(1 + p % 17 for p in inside)


@pytest.mark.parametrize("crowded", [1_000_000, 100, 3])
def test_previous_value_across_hours(spark, monkeypatch, crowded):
    monkeypatch.setattr(series, "TIE_RANGE", 7 if crowded == 3 else 1_000_000)
    rng = random.Random(8)
    data = [(i, rng.choice("xy"), at(rng.choice([rng.uniform(0, 900), 70])), float(i)) for i in range(300)]
    frame = spark.createDataFrame(data, "id bigint, k string, t timestamp, v double")
    got = {r.id: r.p for r in series.previous_value(frame, ["k"], "t", "id", "v", "p").collect()}
    last, expected = {}, {}
    for i, k, _, v in sorted(data, key=lambda r: (r[2], r[0])):
        expected[i] = last.get(k)
        last[k] = v
    assert got == expected


def test_latest_row_and_reference_lines(spark):
    frame = sales_frame(spark, [(0, 1, 1), (9, 5, 1), (4, 3, 1)])
    assert rows(series.latest_row(frame, "window_start", ["revenue"])) == [(money("5.00"),)]
    assert rows(series.with_reference_lines(frame), "avg_revenue", "min_revenue", "max_revenue") == [
        (3.0, money("1.00"), money("5.00"))
    ] * 3


def test_share_adds_up(spark):
    items = orders_frame(spark, 200, minutes=300).select(
        "order_id", "order_timestamp", F.pmod(F.hash("order_id"), F.lit(3)).alias("product_id"),
        F.col("item_count").alias("quantity"), F.lit(money("1.10")).alias("unit_price"),
    )
    products = product_frame(spark, [(i, 1, 1) for i in range(3)]).withColumn("category", F.col("product_id").cast("string"))
    totals = star.category_share(items, products).groupBy("bin").agg(F.sum("share").alias("s"))
    assert all(r.s == pytest.approx(1) for r in totals.collect())
    units = metrics.product_minute_sales(items).agg(F.sum("units_sold")).first()[0]
    assert units == items.agg(F.sum("quantity")).first()[0]


def test_calendar(spark):
    days = calendar.date_dimension(spark, "2024-03-01 12:00:00").orderBy("date").collect()
    assert (str(days[0].date), str(days[-1].date), len(days)) == ("2023-01-01", "2024-03-31", 456)
    assert (days[0].month, days[0].month_num, days[0].weekday) == ("Jan 2023", 202301, "Sun")


# --- measures ------------------------------------------------------------------------------

def small_model(spark, orders, alerts=None):
    items = orders.select("order_id", F.lit(1).alias("product_id"), F.col("item_count").alias("quantity"), F.lit(money("2.00")).alias("unit_price"))
    alerts = alerts or spark.createDataFrame(
        [], "alert_type string, severity string, detected_at timestamp, resolved boolean"
    )
    return star_model(orders, items, product_frame(spark, [(1, 50, 10)]), metrics.minute_sales(orders), alerts)


def test_measures_are_consistent(spark):
    orders = orders_frame(spark, 120)
    row = evaluate(small_model(spark, orders), list(MEASURES), at(30)).first()
    assert row.average_order_value * row.order_count == pytest.approx(float(row.total_revenue))
    assert row.total_revenue == row.total_revenue_today and row.total_revenue_yesterday is None
    assert row.revenue_vs_yesterday_pct is None
    assert row.units_sold == row.units_sold_today
    assert row.active_alerts is None and row.low_stock_count is None
    assert row.stock_coverage_days == pytest.approx(50 / row.units_sold)


def test_blank_measures_without_data(spark):
    row = evaluate(small_model(spark, orders_frame(spark, 5).filter("false")), list(MEASURES), at(30)).first()
    assert row.revenue_trend_arrow == "▶" and row.revenue_trend_color == "#27AE60"
    assert row.total_revenue is None and row.order_count is None and row.average_order_value is None


def test_day_borders_of_today(spark):
    start = T0.replace(hour=0)
    stamps = [start - timedelta(days=1), start - timedelta(milliseconds=1), start, start + timedelta(hours=23, minutes=59)]
    data = [(f"o{i}", "c", t, money(10 ** i), 1, None) for i, t in enumerate(stamps)]
    model = small_model(spark, spark.createDataFrame(data, ORDER_DDL))
    row = evaluate(model, ["total_revenue_today", "total_revenue_yesterday", "orders_today"], T0).first()
    assert (row.total_revenue_today, row.total_revenue_yesterday, row.orders_today) == (money("1100.00"), money("11.00"), 2)


def test_measures_by_group_match_the_total(spark):
    orders = orders_frame(spark, 90).withColumn("status", F.when(F.hash("order_id") % 2 == 0, "A").otherwise("B"))
    parts = evaluate(small_model(spark, orders), ["total_revenue", "order_count"], at(30), by=["status"]).collect()
    whole = evaluate(small_model(spark, orders), ["total_revenue", "order_count"], at(30)).first()
    assert sum(p.total_revenue for p in parts) == whole.total_revenue
    assert sum(p.order_count for p in parts) == whole.order_count


def test_catalog_merge_adds_columns_and_keeps_one_row_per_id(spark):
    stored = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "product_id int, name string, stock_quantity int")
    incoming = spark.createDataFrame(
        [(2, "B", 1, "x"), (3, "c", 2, "y"), (3, "c2", 2, "y"), (None, "none", 0, "z")],
        "product_id int, name string, stock_quantity int, image_url string",
    )
    merged = merge.merge_catalog(stored, incoming)
    assert rows(merged, "product_id", "name", "stock_quantity", "image_url") == [
        (1, "a", 5, None), (2, "B", 6, "x"), (3, "c2", 2, "y")
    ]


def test_distinct_counts_over_two_columns_are_refused(spark, monkeypatch):
    from retailpulse.plans import measures

    other = measures.Base("orders", "distinct", lambda: F.col("customer_id"))
    monkeypatch.setitem(measures.MEASURES, "customers", other)
    orders = spark.createDataFrame([("o", "c", at(0))], "order_id string, customer_id string, order_timestamp timestamp")
    with pytest.raises(ValueError, match="distinct"):
        measures.evaluate({"orders": orders}, ["order_count", "customers"], at(1))


def test_look_back_follows_the_measures():
    from retailpulse.plans import measures

    assert measures.lookback_minutes("sales_metrics") == 60
    assert measures.lookback_minutes("sales_metrics", ["revenue_last_5_min", "revenue_prior_5_min"]) == 10
    assert measures.lookback_minutes("alerts", ["revenue_last_5_min"]) == 0


def test_catalog_versions(spark, tmp_path, monkeypatch):
    from retailpulse.schemas import PRODUCT_DOCUMENT

    def documents(*prices):
        return spark.createDataFrame([(k, f"p{k}", p, "c", "d", "i", (4.5, 100)) for k, p in enumerate(prices, 1)], PRODUCT_DOCUMENT)

    table = catalog.CatalogTable(spark, str(tmp_path / "catalog"))
    assert table.version() == 0 and table.read() is None
    assert table.refresh(documents(1.0, 2.0)) == 1
    first = rows(table.read())
    table.replace(table.read().withColumn("stock_quantity", F.lit(7)))
    # Prices follow the documents, stock stays; a repeated refresh changes nothing.
    assert table.refresh(documents(1.5, 2.0, 3.0)) == 3
    third = rows(table.read(), "product_id", "price", "stock_quantity")
    assert third == [(1, money("1.50"), 7), (2, money("2.00"), 7), (3, money("3.00"), first[0][table.read().columns.index("stock_quantity")])]
    whole = rows(table.read())
    table.refresh(documents(1.5, 2.0, 3.0))
    assert rows(table.read()) == whole and table.version() == 4
    overwrite = catalog.CatalogTable._overwrite
    for broken in ("versions", "names"):
        def fails(self, df, kind, version, broken=broken):
            if kind == broken:
                raise OSError("lost")
            overwrite(self, df, kind, version)

        monkeypatch.setattr(catalog.CatalogTable, "_overwrite", fails)
        with pytest.raises(OSError):
            table.refresh(documents(9.0))
        monkeypatch.setattr(catalog.CatalogTable, "_overwrite", overwrite)
        assert rows(table.read()) == whole and table.version() == 4
    table.refresh(documents(9.0))
    assert rows(table.read(), "product_id", "price") == [(1, money("9.00")), (2, money("2.00")), (3, money("3.00"))]


def test_ingestion_lag_takes_the_exact_percentile_of_a_large_group(spark):
    """60,000 distinct lags and 40 rows without an arrival: ranks are those of the sorted lags."""
    n = 60_000
    sent = F.timestamp_seconds(F.lit(1_700_000_000))
    numbered = spark.range(n, numPartitions=7).select((F.col("id") * 7919 % n).alias("k"))
    known = numbered.select(sent.alias("sent"), F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("k") * F.col("k")).alias("came"))
    lost = spark.range(40).select(sent.alias("sent"), F.lit(None).cast("timestamp").alias("came"))
    (row,) = metrics.ingestion_lag(known.union(lost), "sent", "came", F.to_date("sent").alias("day")).collect()
    lags = [k * k for k in range(n)]
    assert (row.n_events, row.max_lag_ms, row.p95_lag_ms) == (n + 40, lags[-1], lags[n * 95 // 100 - 1])
    assert row.avg_lag_ms == sum(lags) / n
    (none,) = metrics.ingestion_lag(lost, "sent", "came", "sent").collect()
    assert (none.n_events, none.avg_lag_ms, none.max_lag_ms, none.p95_lag_ms) == (40, None, None, None)
