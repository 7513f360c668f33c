"""Session settings the jobs rely on."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def send_with_task(module: str) -> None:
    """Ship a module's functions inside the tasks that call them.

    Executors then need numpy and pandas, but not this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def build_session(
    app: str = "retailpulse",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A UTC session with adaptive execution on.

    On a cluster leave ``shuffle_partitions`` unset and size it through
    ``spark-submit``; adaptive execution coalesces small partitions and splits
    skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Streaming state (recent order ids, open minutes) off the JVM heap.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        # A batch then uploads what it changed, not its whole state.
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on, for sessions made elsewhere.

    Every minute, hour and day boundary is UTC. Skewed joins are split even
    where this costs another shuffle: one product or order may hold a large
    share of all rows.
    """
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("name a folder that all executors share: pass a path or start Spark with spark.checkpoint.dir")
    return folder


def shuffle_width(spark: SparkSession) -> int:
    """The configured number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
