"""The registered queries of this folder: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpulse.llm import (
    centroids, cross_polytope, decontamination, lattice_lm, license_index, line_chunks, piece_transducer, secrets, simhash_pivots,
    toxicity, url_filter, vector_codes, wavelet,
)
from retailpulse.llm.common import held_out, stored, table
from retailpulse.llm.license_sql import license_sql
from retailpulse.llm.vector_sql import centroid_sql, code_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op9_simhash_pivots")
def op9_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_pivots.near_duplicates(table(spark, sf_dir, "documents"))
    text = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("doc_id", text, "component_id")


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query("op1_wavelet_tokens")
def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return wavelet.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


@query("op4_piece_transducer")
def op4_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and checksum of its ids, and whether decoding them restores the text.

    The checksum is over the ids as little-endian 32-bit numbers; word marks in a text
    come back as blanks.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_transducer.digest(docs, model)


@query("op10_toxicity_kernel")
def op10_toxicity_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs, machine).withColumn("held_out", held_out(toxicity.FOLDS))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op7_secret_novelty")
def op7_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"), number("novel"),
    )


@query("op2_lattice_likelihood")
def op2_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return lattice_lm.score(docs, public_tokenizers.path("piece_bpe_32k.model"), class_column="lang")


@query("op5_line_chunks")
def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines taken out, and size and checksum of the text left."""
    found = line_chunks.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    left = F.coalesce("text", F.lit(""))
    return found.select(
        "doc_id", "n_removed", F.length(left).cast("long").alias("chars_left"),
        F.crc32(left.cast("binary")).alias("text_crc32"),
    )


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it repeats a benchmark item, how many, and which."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.judged(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").cast("long").alias("n_items"),
        F.array_join(F.col("items").cast("array<string>"), ",").alias("items"),
    )


@query("op8_cross_polytope")
def op8_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cross_polytope.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


@query("op11_license_index", license_sql())
def op11_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_index.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("licenses", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["start"])

    def joined(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("licenses")).alias("labels"),
        F.coalesce(F.array_max(F.transform("licenses", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )


#: A label's rows are dealt to so many tasks where its total is joined to them.
LABEL_SALTS = 16


@query("op12_hilbert_codes", code_sql())
def op12_hilbert_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    hexes = F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    rows = found.rows.select("vec_id", "label", hexes.alias("code"), "error")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(LABEL_SALTS)).cast("int"))
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    sums = sums.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    joined = rows.join(sums, (F.col("salt") == F.col("part")) & F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(found.checksum()).alias("codebooks_sha256"))


@query("op13_zone_centroids", centroid_sql())
def op13_zone_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    rows = stored(found.rows)
    # One row a cluster.
    sums = {r.cluster: r.d for r in rows.groupBy("cluster").agg(F.try_sum("distance").alias("d")).collect()}
    whole = None if None in sums.values() or sum(sums.values()) >= 1 << 63 else sum(sums.values())
    known = [(k, sums[k], whole, text) for k, text in enumerate(found.checksums()) if k in sums]
    facts = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
