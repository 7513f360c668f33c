"""Isolation forest over bounded frames (Liu, Ting, Zhou, ICDM 2008).

A frame is at most 24 hours of minute rows of one series, so it fits one task;
many frames run in parallel. Python only grows the random trees; ensemble
score, contamination offset and decision are column expressions.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from retailpulse.config import AnomalyParams
from retailpulse.session import send_with_task, shuffle_width

send_with_task(__name__)

EULER_GAMMA = 0.5772156649015329


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype="float64")
    many = np.maximum(n, 3.0)
    depth = 2.0 * (np.log(many - 1.0) + EULER_GAMMA) - 2.0 * (many - 1.0) / many
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, depth))


def _total_depths(x: np.ndarray, trees: int, size: int, rng: np.random.Generator) -> np.ndarray:
    """Depth of every row summed over all trees.

    All trees grow together, one level at a time: a node is a number, and the
    sampled points and the scored rows carry the node they have reached.
    """
    n = len(x)
    limit = int(np.ceil(np.log2(max(size, 2))))
    stride = 2 ** (limit + 1)
    picks = np.concatenate([rng.choice(n, size=size, replace=False) for _ in range(trees)])
    point_node = np.repeat(np.arange(trees), size) * stride
    rows = np.tile(np.arange(n), trees)
    row_node = np.repeat(np.arange(trees), n) * stride
    total = np.zeros(n)
    for depth in range(limit + 1):
        order = np.argsort(point_node, kind="stable")
        nodes, first, count = np.unique(point_node[order], return_index=True, return_counts=True)
        values = x[picks[order]]
        low = np.minimum.reduceat(values, first, axis=0)
        high = np.maximum.reduceat(values, first, axis=0)
        movable = high > low
        leaf = (count <= 1) | ~movable.any(axis=1) | (depth == limit)
        # One of the features that still vary, and a cut inside its range.
        feature = np.argmax(np.where(movable, rng.random(movable.shape), -1.0), axis=1)
        at = np.arange(len(nodes))
        cut = low[at, feature] + rng.random(len(nodes)) * (high[at, feature] - low[at, feature])

        # Strictly below the maximum, so that both sides keep a sampled point.
        cut = np.minimum(cut, np.nextafter(high[at, feature], low[at, feature]))

        reached = np.searchsorted(nodes, row_node)
        done = leaf[reached]
        np.add.at(total, rows[done], depth + _average_path(count[reached[done]]))

        def descend(where, node, index):
            right = x[index, feature[where]] > cut[where]
            tree, position = node // stride * stride, node % stride
            return tree + 2 * position + 1 + right

        rows, row_node, reached = rows[~done], row_node[~done], reached[~done]
        row_node = descend(reached, row_node, rows)
        where = np.searchsorted(nodes, point_node)
        inner = ~leaf[where]
        picks, point_node, where = picks[inner], point_node[inner], where[inner]
        point_node = descend(where, point_node, picks)
        if not len(rows):
            break
    return total


def _mean_depths(
    features: list[str], time: str, trees: int, subsample: int, seed: int
) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # Sorted rows and a fixed seed: the result does not depend on how
        # Spark happened to deliver the frame.
        frame = frame.sort_values(time, kind="stable")
        x = frame[features].to_numpy(dtype="float64")
        size = min(subsample, len(x))
        total = _total_depths(x, trees, size, np.random.default_rng(seed))
        usual = float(_average_path(size)) or 1.0
        return frame.assign(mean_depth=total / trees, usual_depth=usual)

    return run


def forest_scores(
    metrics: DataFrame, frame: list[str], features: list[str], time: str, params: AnomalyParams
) -> DataFrame:
    """Rows with their forest ``score`` and ``decision`` (negative = outlier)."""
    numeric: list[Column] = [F.col(name).cast("double").alias(name) for name in features]
    rows = metrics.select(*frame, time, *numeric)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    # Frames cost CPU rather than bytes: keep them spread over the tasks.
    spread = rows.repartition(shuffle_width(metrics.sparkSession), *frame)
    depths = spread.groupBy(*frame).applyInPandas(
        _mean_depths(features, time, params.trees, params.subsample, params.seed),
        f"{fields}, mean_depth double, usual_depth double",
    )
    scored = depths.withColumn("score", -F.pow(F.lit(2.0), -F.col("mean_depth") / F.col("usual_depth")))
    # Contamination: the share of rows that lie below the offset.
    offset = F.percentile("score", F.lit(params.contamination)).over(W.partitionBy(*frame))
    return scored.withColumn("decision", F.col("score") - offset)
