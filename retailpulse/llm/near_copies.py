"""Near-copies by SimHash pivots and the exact similarity of their word shingles.

Texts as sets of five-word shingles are near-copies if they share at least 0.8 of
all their shingles (Jaccard). SimHash fingerprints, wide enough for that similarity, are
searched by their distances to pivots (``simhash_pivots``): one of 64 keys of pivot
coordinates, then the Hamming distance. At exactly 0.8 one pair in 200 has no such key, at
0.85 one in 3,000. So that these are not lost, pairs that share one of 40 keys of five
minima are candidates, too; a pair at 0.8 lacks all of those once in eight million times.
Groups of candidates are then compared pair by pair with their shingles, which decides
alone what is a near-copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.llm.common import packed, stored, text_bytes
from retailpulse.llm.graph import components
from retailpulse.llm.simhash_pivots import merged, wide_links, wide_print

WORDS = 5
SIMILARITY = 0.8
KEYS, MINIMA = 40, 5
#: Rows and shingles of one group that one task compares; larger groups are cut into pairs of such parts.
PART_ROWS, PART_SHINGLES = 512, 1_000_000

_RANDOM = np.random.default_rng(9)
FACTORS = _RANDOM.integers(0, 1 << 31, KEYS * MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _RANDOM.integers(0, 1 << 32, KEYS * MINIMA, dtype=np.uint32)


def shingles(found: list[bytes], words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text's words; fewer words are one shingle, none are none."""
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined)], np.uint64)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e]) for s, e in zip((ends - lengths).tolist(), ends[words - 1:].tolist())]
    return np.unique(np.array(hashes, np.uint64))


def block_keys(own: np.ndarray) -> list[int]:
    """Keys of a set of shingles, each of MINIMA smallest values under hash functions of its own."""
    low = np.full(KEYS * MINIMA, np.iinfo(np.uint32).max, np.uint32)
    short = (own >> np.uint64(32)).astype(np.uint32)
    for part in range(0, len(short), 1024):
        values = short[None, part:part + 1024] * FACTORS[:, None] + SHIFTS[:, None]
        np.minimum(low, values.min(axis=1), out=low)
    rows = low.reshape(KEYS, MINIMA)
    return [xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(rows)]


def prints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, mark, node, keys, print) of every row; node is a hash of the text's words, mark one of the text.

    Words are runs of other bytes than ASCII white space, A-Z lower-cased; print is the
    wide SimHash of the shingles. Texts without words share node zero and have no keys.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys, wide = [], [], []
            for text in batch["data"]:
                found = text.as_py().lower().split()
                own = shingles(found, words)
                nodes.append(xxhash.xxh64_intdigest(b" ".join(found)) if found else 0)
                keys.append(np.array(block_keys(own) if found else [], np.uint64).view(np.int64))
                wide.append(wide_print(own).tobytes())
            arrays = [
                batch["doc_id"], batch["mark"], pa.array(np.array(nodes, np.uint64).view(np.int64)),
                pa.array(keys, pa.list_(pa.int64())), pa.array(wide, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "mark", "node", "keys", "print"])

    mark = F.xxhash64(text_bytes()).alias("mark")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark, text_bytes().alias("data"))
    return chosen.mapInArrow(run, "doc_id long, mark long, node long, keys array<long>, print binary")


def minima_links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) from each of ``nodes`` (node, keys) to the smallest one it shares a key with."""
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    firsts = keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    links = keyed.join(firsts, "key").where("node > first")
    return links.select(F.col("first").alias("a"), F.col("node").alias("b"))


def candidates(rows: DataFrame) -> DataFrame:
    """(node, root) of the nodes of ``rows`` (node, keys, print) that have a candidate, by chains of candidates."""
    some = rows.where(F.size("keys") > 0).groupBy("node").agg(F.first("keys").alias("keys"), F.first("print").alias("print"))
    nodes = stored(some)
    return components(wide_links(nodes).union(minima_links(nodes)))


def shingle_sets(docs: DataFrame, reps: DataFrame, words: int = WORDS) -> DataFrame:
    """(root, node, n, own) of ``reps`` (node, root, own.doc_id, own.mark): the shingles of that row's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(x.as_py().lower().split(), words) for x in batch["data"]]
            arrays = [batch["root"], batch["node"], pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["root", "node", "n", "own"])

    texts = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.xxhash64(text_bytes()).alias("own_mark"), text_bytes().alias("data"))
    same = F.col("own_id").eqNullSafe(F.col("own.doc_id")) & (F.col("own_mark") == F.col("own.mark"))
    chosen = texts.join(reps, same).select("root", "node", "data").dropDuplicates(["root", "node"])
    return chosen.mapInArrow(run, "root long, node long, n long, own binary")


def in_parts(sets: DataFrame, part_rows: int, part_shingles: int) -> DataFrame:
    """(root, lo, hi, node, own): large groups become pairs of parts, so that every two rows of a group meet."""
    sizes = sets.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / part_rows, F.sum("n") / part_shingles)).cast("int").alias("parts"))
    rows = sets.join(sizes, "root").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.select("root", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "node", "own")


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Label of each set: the first of its component of sets that are at least so similar."""
    labels = np.arange(len(sets))
    sizes = np.array([len(x) for x in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    held = np.zeros(codes.max() + 1, bool)
    for k in range(len(sets) - 1):
        if (labels == labels[0]).all():
            break
        own = codes[starts[k]:starts[k] + sizes[k]]
        held[own] = True
        shared = np.add.reduceat(held[codes[starts[k + 1]:]].astype(np.int64), starts[k + 1:] - starts[k + 1])
        held[own] = False
        near = k + 1 + np.flatnonzero(shared / (sizes[k] + sizes[k + 1:] - shared) >= similarity)
        merged(labels, np.full(len(near), k), near)
    return labels


def verified(rows: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join the nodes of each run (root, lo, hi) as their similar pairs would."""
    by = ["root", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            labels = similar(sets, similarity)
            linked = np.flatnonzero(labels != np.arange(len(labels)))
            left = np.array(nodes, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(left[linked]), pa.array(left[labels[linked]])], names=["a", "b"])

        now, nodes, sets = None, [], []
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in by), batch["node"].to_pylist(), batch["own"]):
                if row[:3] != now:
                    if len(nodes) > 1:
                        yield flush()
                    now, nodes, sets = row[:3], [], []
                nodes.append(row[3])
                sets.append(np.frombuffer(row[4].as_py(), np.uint64))
        if len(nodes) > 1:
            yield flush()

    ordered = rows.repartition(*by).sortWithinPartitions(*by, "node")
    return ordered.mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY,
                part_rows: int = PART_ROWS, part_shingles: int = PART_SHINGLES) -> DataFrame:
    """(doc_id, mark, root) of every row of ``docs`` (doc_id, text, anything else); root names its component.

    Rows link if the sets of their shingles of ``words`` words are at least
    ``similarity`` (0.8 or more) similar. Texts of the same words link, also texts
    without words (null texts among them). Repeated rows are kept. An empty table gives
    an empty one.
    """
    if not SIMILARITY <= similarity <= 1:
        raise ValueError(f"similarity must lie between {SIMILARITY} and 1")
    rows = stored(prints(docs, words))
    found = candidates(rows)
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "mark")
    reps = rows.groupBy("node").agg(F.min(order).alias("own")).join(found, "node")
    sets = stored(shingle_sets(docs, reps, words))
    roots = components(verified(in_parts(sets, part_rows, part_shingles), similarity))
    joined = rows.join(roots, "node", "left")
    return joined.select("doc_id", "mark", F.coalesce("root", "node").alias("root"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-copies: of each component the smallest doc_id stays.

    Ties (equal ids) go to the lowest hash of the text, and of repeated rows one stays.
    All columns are kept as they are; a null doc_id stays only where no other is.
    """
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "mark")
    first = near_copies(docs).groupBy("root").agg(F.min(order).alias("first"))
    chosen = first.select(F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_of")).distinct()
    rows = packed(docs, docs.columns).withColumn("own_mark", F.xxhash64(text_bytes("row.text")))
    same = F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own_mark") == F.col("_of"))
    kept = rows.join(chosen, same, "left_semi").dropDuplicates(["own_id", "own_mark"])
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
