"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from retailpulse.plans.catalogue import REGISTRY  # noqa: E402
from retailpulse.session import build_session  # noqa: E402

HEADLINE = [
    "a1_minute_sales",
    "a2_product_minute_sales",
    "a10_revenue_by_category",
    "a11_category_share",
    "a15_order_assembly",
    "c3_catalog_refresh",
    "d1_zscore_spike_hourly",
    "d2_isolation_forest_daily",
    "j2_star_join",
    "j4_additive_merge",
    "j6_stock_decrement",
    "j8_rules_and_metrics",
    "k8_rule_severity",
    "m_all_in_one_row",
    "m_by_day",
    "o2_top_sellers",
    "s2_decode_payload",
    "t10_alert_cooldown",
    "t11_ingestion_lag",
    "v1_kpi_cards",
    "v2_revenue_per_minute",
    "v7_product_detail",
    "w1_trailing_zscore",
    "w3_running_stock",
    "w5_rolling_sales",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def stream_replay(spark, folder: str) -> tuple[float, int]:
    """Drain all events as order documents through the streaming ingest."""
    from retailpulse.plans.tables_queries import order_documents
    from retailpulse.sources import events
    from retailpulse.sources.testbed import Testbed
    from retailpulse.streaming import ingest
    from retailpulse.streaming.store import Store

    root = tempfile.mkdtemp(prefix="bench-stream-")
    tables = Testbed(spark, folder)
    messages = events.encode(order_documents(tables)).select("value")
    messages.repartition(8).write.text(f"{root}/in")
    decoded = events.decode(events.file_events(spark, f"{root}/in"))
    handler = ingest.batch_handler(Store(spark, f"{root}/out", order_part="day"), lambda: tables.products)
    seconds = timed(
        lambda: ingest.start(decoded, handler, f"{root}/checkpoint", drain=True).awaitTermination()
    )
    return seconds, tables.events.agg(F.count("*")).first()[0]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "retailpulse-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    times: dict[str, float] = {}
    for name in HEADLINE:
        if only and name not in only:
            continue

        def run(name=name):
            REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()

        run()
        times[name] = round(statistics.median(timed(run) for _ in range(3)), 3)
    if not only:
        seconds, n = stream_replay(spark, folder)
        times["stream_replay"] = round(seconds, 3)
        extra = {"stream_rows_per_second": round(n / seconds)}
    else:
        extra = {}
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": scale, **extra
    }))
    spark.stop()


if __name__ == "__main__":
    main()
