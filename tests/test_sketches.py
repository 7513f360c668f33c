"""Distinct counts and quantiles from merged minutes against the exact figures."""

import random
from datetime import timedelta

from pyspark.sql import functions as F

from conftest import T0, at, rows
from retailpulse.operators import sketches

ORDERS = "order_id string, order_timestamp timestamp, arrived_at timestamp"


def orders(n, seed=1, ids=400):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        moment = T0 + timedelta(seconds=rng.randrange(7200))
        out.append((f"o{rng.randrange(ids)}", moment, moment + timedelta(milliseconds=rng.randrange(100_000))))
    return out


def test_small_groups_are_exact_however_they_are_cut(spark):
    data = orders(150)
    whole = sketches.order_sketches(spark.createDataFrame(data, ORDERS), "order_timestamp", "arrived_at")
    parts = [sketches.order_sketches(spark.createDataFrame(data[k::3], ORDERS), "order_timestamp", "arrived_at") for k in range(3)]
    cut = sketches.merged(parts[0].union(parts[1]).union(parts[2]), *sketches.WINDOW)
    hour = F.date_trunc("hour", "window_start").alias("hour")
    found = [rows(sketches.lag_summary(df, hour)) for df in (whole, cut)]
    assert found[0] == found[1] and len(found[0]) == 2
    for start, n, events, p50, p95, p99 in found[0]:
        own = [(i, round((b - a).total_seconds() * 1000)) for i, a, b in data if start <= a < start + timedelta(hours=1)]
        lags = sorted(x for _, x in own)
        assert (n, events) == (len({i for i, _ in own}), len(own))
        for got, share in ((p50, 0.5), (p95, 0.95), (p99, 0.99)):
            assert abs(lags.index(got) - share * len(lags)) <= 1


def test_large_groups_stay_within_their_errors(spark):
    n = 60_000
    rows_ = spark.range(n).select(
        F.concat(F.lit("o"), F.col("id") % 20_000).alias("order_id"),
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=(F.col("id") % 3600).cast("decimal(18,6)"))).alias("order_timestamp"), "id",
    )
    rows_ = rows_.withColumn("arrived_at", F.col("order_timestamp") + F.make_dt_interval(secs=(F.col("id") * 7919 % n / 1000).cast("decimal(18,6)")))
    minutes = sketches.order_sketches(rows_, "order_timestamp", "arrived_at")
    (r,) = sketches.lag_summary(minutes, F.date_trunc("day", "window_start").alias("day")).collect()
    assert r.n_events == n and abs(r.order_count - 20_000) <= 3 * sketches.DISTINCT_ERROR * 20_000
    for got, share in ((r.p50_lag_ms, 0.5), (r.p95_lag_ms, 0.95), (r.p99_lag_ms, 0.99)):
        assert abs(got / n - share) <= 2 * sketches.RANK_ERROR


def test_missing_ids_and_arrivals_and_empty_tables(spark):
    data = [(None, at(0), at(1)), ("a", at(0), None), ("b", at(1), None), (None, None, at(3))]
    found = sketches.order_sketches(spark.createDataFrame(data, ORDERS), "order_timestamp", "arrived_at")
    got = rows(sketches.lag_summary(found, "window_start"), "window_start", "order_count", "n_events", "p50_lag_ms")
    assert got == sorted([(at(0), 1, 1, 60_000), (at(1), 1, 0, None)], key=repr)
    assert sketches.order_sketches(spark.createDataFrame([], ORDERS), "order_timestamp", "arrived_at").count() == 0
