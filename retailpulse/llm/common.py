"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    Where the session names none, a run within one process (tests, local runs) takes a
    scratch folder; on a cluster that is an error, for executors would not share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        root = context.getCheckpointDir()
        if root is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("start Spark with spark.checkpoint.dir, a folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="retailpulse-"))
            root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again.

    What follows starts from files that outlive any executor, and the work before
    it is not repeated.
    """
    folder = folder or shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def held_out(folds: int, column: str = "doc_id") -> Column:
    """Whether a row is in the fold that nothing is learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == 0, F.lit(False))


def spare(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def packed(docs: DataFrame, columns: list[str]) -> DataFrame:
    """(own_id, own_mark, row): identity of each document and its ``columns`` in one struct.

    Joins need no care for the names of a document's own columns then. Rows equal in
    id and text have the same identity.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    return docs.select(F.col("doc_id").cast("long").alias("own_id"), F.xxhash64(text).alias("own_mark"), row)


def text_bytes(column: str = "text") -> Column:
    """UTF-8 of a text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def slices(texts: list[str], chars: int = 2_000_000) -> Iterator[list[str]]:
    """Runs of consecutive texts of about so many characters."""
    some, held = [], 0
    for text in texts:
        some.append(text)
        held += len(text)
        if held >= chars:
            yield some
            some, held = [], 0
    if some:
        yield some


def once_per_worker(key: tuple, make: Callable):
    """What ``make`` returns, kept for later tasks of the same Python worker."""
    kept = sys.modules.setdefault("_retailpulse_worker", types.ModuleType("_retailpulse_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
