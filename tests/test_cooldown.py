"""The cooldown replay against a plain loop."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import at
from retailpulse.operators import cooldown
from retailpulse.operators.cooldown import emitted_times, suppress_repeats


def frame(spark, data):
    return spark.createDataFrame(data, "alert_id bigint, entity_id string, detected_at timestamp")


def loop(data, minutes):
    kept, last = set(), {}
    for _, key, when in sorted(data, key=lambda r: (r[1], r[2], r[0])):
        if key not in last or when - last[key] >= timedelta(minutes=minutes):
            last[key] = when
            kept.add((key, when))
    return kept


def found(df):
    return {(r.entity_id, r.detected_at) for r in df.collect()}


@pytest.mark.parametrize("seed,fan", [(1, 64), (2, 2), (3, 3), (4, 2)])
def test_random_histories(spark, monkeypatch, seed, fan):
    """Small fans make many short spans, so chains cross span borders often."""
    monkeypatch.setattr(cooldown, "FAN", fan)
    rng = random.Random(seed)
    data = [
        (i, rng.choice("aaab"), at(rng.choice([rng.uniform(0, 600), rng.randint(0, 600), rng.uniform(0, 60)])))
        for i in range(1500)
    ]
    assert found(emitted_times(frame(spark, data), ["entity_id"], "detected_at", 5)) == loop(data, 5)


def test_regular_alerts_and_exact_gap(spark):
    data = [(i, "k", at(i)) for i in range(0, 400)]
    expected = {("k", at(i)) for i in range(0, 400, 5)}
    assert found(emitted_times(frame(spark, data), ["entity_id"], "detected_at", 5)) == expected


def test_long_gaps_and_copies(spark):
    data = [(i, "k", at(100_000 * (i % 7))) for i in range(70)]
    kept = suppress_repeats(frame(spark, data), ["entity_id"], "detected_at", 5, "alert_id")
    assert sorted(r.alert_id for r in kept.collect()) == list(range(7))


def test_cut_into_batches_gives_the_same(spark):
    rng = random.Random(9)
    data = [(i, rng.choice("ab"), at(i / 3 + rng.random())) for i in range(600)]
    data.sort(key=lambda r: r[2])
    whole = loop(data, 5)
    first, second = data[:217], data[217:]
    a = emitted_times(frame(spark, first), ["entity_id"], "detected_at", 5)
    last = a.groupBy("entity_id").agg({"detected_at": "max"}).toDF("entity_id", "last_at")
    b = emitted_times(frame(spark, second), ["entity_id"], "detected_at", 5, last)
    assert found(a) | found(b) == whole


def test_a_busy_key_of_a_million_alerts(spark):
    n, step = 1_000_000, 173_000  # two days of one key, six alerts a second
    start = 1_709_294_400_000_000
    alerts = spark.range(n).select(
        F.lit("LOW_STOCK").alias("alert_type"), F.timestamp_micros(F.lit(start) + F.col("id") * step).alias("detected_at")
    )
    found = cooldown.emitted_times(alerts, ["alert_type"], "detected_at", 5)
    got = sorted(r[0] for r in found.select(F.unix_micros("detected_at")).collect())
    hop = -(-5 * 60_000_000 // step)
    assert got == [start + k * step for k in range(0, n, hop)]
