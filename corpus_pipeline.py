"""The corpus pipeline: documents in, clean and encoded documents out.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept,
written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpulse.llm import decontamination, line_chunks, near_copies, piece_transducer, toxicity
from retailpulse.llm.common import spare, stored, table

#: Texts that are at least so likely toxic are rejected.
REJECTED = 0.5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the kernel machine, fitted on the labelled ones, does not reject."""
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = spare(docs, "toxic_score")
    scored = toxicity.scored(docs, machine, out=score)
    return scored.where(F.col(score) < REJECTED).drop(score)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages taken out; a document that was nothing else goes. n_chars follows the text."""
    removed = spare(docs, "n_removed")
    found = line_chunks.without_repeats(docs, out=removed)
    kept = found.where((F.col(removed) == 0) | F.col("text").rlike(r"\S"))
    changed = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)).drop(removed)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are at least 0.8 similar."""
    return near_copies.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    items = spare(docs, "items")
    found = decontamination.judged(docs, table(spark, sf_dir, "benchmark"), out=items)
    return found.where(F.size(items) == 0).drop(items)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ids and n_ids; decoding the ids gives the text back."""
    coded = piece_transducer.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.withColumn("n_ids", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("encoding", encoded),
]

#: Hash functions, a trained machine and a tokenizer: not expressible in SQL, see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
