"""One evaluation of the detectors and rules over the stored tables.

Call it from any scheduler; every call takes its clock and a run number, and a
repeated run replaces its own alerts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.config import DEFAULTS, Params
from retailpulse.functions.clock import Clock, before, moment
from retailpulse.operators.alerts import KPI_KEY, SPIKE_KEY, suppress_recent, unify
from retailpulse.operators.anomaly import detect, spike_alerts
from retailpulse.operators.cooldown import suppress_repeats
from retailpulse.operators.kpi import judge, lookback_minutes, metric_values, violation_alerts
from retailpulse.streaming.store import MAIN, MONITOR, Store


def new_alerts(
    sales: DataFrame, products: DataFrame, rules: DataFrame, history: DataFrame, as_of: Clock,
    params: Params = DEFAULTS,
) -> DataFrame:
    """Spike and KPI alerts due at ``as_of`` that no cooldown holds back."""
    spikes = spike_alerts(detect(sales, as_of, params=params.anomaly), as_of)
    violations = violation_alerts(judge(metric_values(sales, products, rules, as_of), rules), as_of)
    return unify(
        suppress_recent(spikes, history, SPIKE_KEY, as_of, params.cooldown.spike),
        suppress_recent(violations, history, KPI_KEY, as_of, params.cooldown.kpi),
    )


def evaluate_once(
    store: Store, products: DataFrame, rules: DataFrame, as_of: Clock, run: int, params: Params = DEFAULTS
) -> None:
    """Append the alerts due now, against the stock left after all stored sales.

    ``products`` is the catalog. Runs are numbered apart from the ingest's batches
    by storing them as negative batch ids."""
    longest_cooldown = max(params.cooldown.spike, params.cooldown.kpi)
    history = store.alerts.raised(since=before(as_of, longest_cooldown)).filter((F.col("run") != MONITOR) | (F.col("batch_id") != -run))
    lookback = F.greatest(F.lit(params.anomaly.forest_minutes), lookback_minutes(rules))
    sales = store.sales_metrics(since=before(as_of, lookback))
    due = new_alerts(sales, store.products(products), rules, history, as_of, params)
    part = F.date_format(moment(as_of), "yyyy-MM-dd")
    store.write_batch(-run, MONITOR, [(store.alerts, due.withColumn("part", part))])


def alert_stream_step(
    store: Store, candidates: DataFrame, keys: list[str], minutes: int, batch_id: int, run: str = MAIN
) -> DataFrame:
    """Cooldown over one micro-batch of candidate alerts.

    Continues from the last alert emitted per key by earlier batches, so the
    result does not depend on how the stream was cut into batches. ``run`` and
    ``batch_id`` name the batch under which the result is stored: its own alerts of
    an earlier attempt do not hold it back.
    """
    earliest = candidates.agg(F.min("detected_at")).scalar()
    history = store.alerts.raised(before=batch_id, since=before(earliest, minutes), run=run)
    last = history.groupBy(*keys).agg(F.max("detected_at").alias("last_at"))
    ranked = candidates.withColumn("_tie", F.xxhash64(*candidates.columns))
    return suppress_repeats(ranked, keys, "detected_at", minutes, "_tie", last).drop("_tie")
