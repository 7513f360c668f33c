"""SimHash near-duplicates found through distances to pivot fingerprints.

The pivots are the zero fingerprint and one fingerprint for each of 32 two-bit
fields. The distances of a fingerprint x to them tell, for each field, how many of
its bits are set: (d(x, zero) + 2 - d(x, field)) / 2.

The fields lie in six blocks. Two fingerprints that differ in at most three bits
agree on three whole blocks, so they agree on the coordinates of one of the 20
choices of three blocks: an equality key loses no link. Pairs with equal keys are
discarded when any pivot coordinate differs by more than the radius, and the
survivors are verified by their Hamming distance.

Texts that share four fifths of their shingles differ in 4 to 18 of 64 bits, too many
for such blocks. They take WIDE fingerprints of hash functions of their own: each has a
key for the pivot coordinates of every eight of its fields, so that 64 keys are
independent, and the distance is that of the next CHECKED fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.llm.common import packed, stored, text_bytes
from retailpulse.llm.graph import components

RADIUS = 3
FIELDS = 32
PIVOTS = np.array([0] + [3 << (2 * f) for f in range(FIELDS)], dtype=np.uint64)
BLOCKS = np.array_split(np.arange(FIELDS), RADIUS + 3)
CHOICES = list(combinations(range(len(BLOCKS)), 3))
#: Rows of one key that one task compares; larger keys are cut into pairs of such parts.
PART_ROWS = 4096

WIDE, WIDE_FIELDS, CHECKED, WIDE_ROWS = 16, 8, 2, 1024
#: Bits of the checked fingerprints in which linked texts may differ: at similarity 0.8, 19 or 20 are expected, of others 64.
WIDE_RADIUS = 32
SALTS = np.random.default_rng(11).integers(0, 1 << 64, WIDE, dtype=np.uint64)
#: The eight bits of each byte, lowest first, one to a byte.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of ``text``, repeats included.

    Words are runs of other bytes than ASCII white space, A-Z lower-cased. A text of
    fewer words has one shingle; a text without words has fingerprint zero. A bit is 1
    if it is set in more than half of the hashes.
    """
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = (ends - np.fromiter(map(len, found), np.int64, len(found))).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[s:e], seed) for s, e in zip(starts, ends[words - 1:].tolist())], dtype="<u8"
    )
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[part:part + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, mark, fp) of every row; fp holds the 64 bits as a long, mark is a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), words, seed) for x in batch["data"]]
            fp = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["mark"], pa.array(fp)], names=["doc_id", "mark", "fp"])

    mark = F.xxhash64(text_bytes()).alias("mark")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark, text_bytes().alias("data"))
    return chosen.mapInArrow(run, "doc_id long, mark long, fp long")


def pivot_distances(fps: np.ndarray) -> np.ndarray:
    """One row per fingerprint, one column per pivot."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int16)


def block_keys(distances: np.ndarray) -> np.ndarray:
    """One key per fingerprint and choice of three blocks, from pivot coordinates alone."""
    ones = (distances[:, :1] + 2 - distances[:, 1:]).astype(np.int64) // 2
    keys = np.empty((len(distances), len(CHOICES)), np.int64)
    for number, choice in enumerate(CHOICES):
        fields = np.concatenate([BLOCKS[b] for b in choice])
        keys[:, number] = ones[:, fields] @ (3 ** np.arange(len(fields), dtype=np.int64)) * len(CHOICES) + number
    return keys


def keyed(fps: DataFrame) -> DataFrame:
    """(key, fp): 20 keys for each row of ``fps`` (fp)."""
    def run(batches):
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False)
            for part in range(0, len(fp), 2048):
                some = fp[part:part + 2048]
                keys = block_keys(pivot_distances(some.view(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(some, keys.shape[1]))], names=["key", "fp"]
                )

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def merged(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Give linked rows the smaller label, in place, until nothing changes."""
    while len(left):
        a, b = labels[left], labels[right]
        low = np.minimum(a, b)
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        np.minimum.at(labels, left, low)
        np.minimum.at(labels, right, low)
        while True:
            shorter = labels[labels]
            if np.array_equal(shorter, labels):
                break
            labels[:] = shorter
        open_ = labels[left] != labels[right]
        left, right = left[open_], right[open_]


def links_of_runs(runs: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """Label of each row: the first row of its component within its run of equal keys.

    Rows of a run lie together. Pairs that earlier links already joined are not
    compared again; the others pass the pivot test and then the exact one.
    """
    labels = np.arange(len(fps))
    unsigned = fps.view(np.uint64)
    distances = pivot_distances(unsigned)
    left = np.arange(len(fps))
    for shift in range(1, len(fps)):
        left = left[left < len(fps) - shift]
        left = left[runs[left] == runs[left + shift]]
        if not len(left):
            break
        new = left[labels[left] != labels[left + shift]]
        for part in range(0, len(new), 65536):
            i = new[part:part + 65536]
            j = i + shift
            near = np.abs(distances[i] - distances[j]).max(axis=1) <= radius
            i, j = i[near], j[near]
            near = np.bitwise_count(unsigned[i] ^ unsigned[j]) <= radius
            merged(labels, i[near], j[near])
    return labels


def bucket_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that join the fingerprints of each run (key, lo, hi) as their pairs would."""
    def run(batches):
        def flush(table):
            keys = np.stack([table[c].to_numpy() for c in ("key", "lo", "hi")])
            new = np.concatenate([[0], (np.diff(keys, axis=1) != 0).any(axis=0)]).cumsum() if table.num_rows else []
            fps = np.ascontiguousarray(table["fp"].to_numpy())
            labels = links_of_runs(np.asarray(new), fps, radius)
            linked = labels != np.arange(len(labels))
            return pa.RecordBatch.from_arrays([pa.array(fps[linked]), pa.array(fps[labels[linked]])], names=["a", "b"])

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            last = [table[c][table.num_rows - 1].as_py() for c in ("key", "lo", "hi")] if table.num_rows else None
            if last is None:
                continue
            same = np.logical_and.reduce([table[c].to_numpy() == v for c, v in zip(("key", "lo", "hi"), last)])
            cut = table.num_rows - int(same[::-1].argmin() if not same.all() else len(same))
            if cut:
                yield flush(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield flush(rest)

    by = ["key", "lo", "hi"]
    ordered = rows.repartition(*by).sortWithinPartitions(*by, "fp")
    return ordered.mapInArrow(run, "a long, b long")


def in_parts(rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(key, fp, lo, hi): keys of one row go; large keys become pairs of parts of bounded size.

    Every two rows of a key meet in the run of their two parts, so no pair is lost,
    and no run holds much more than twice ``part_rows`` rows.
    """
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(sizes, "key").withColumn("parts", F.ceil(F.col("n") / part_rows).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.select("key", "fp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = RADIUS, part_rows: int = PART_ROWS) -> DataFrame:
    """(doc_id, mark, fp, root, component_id) of every row of ``docs`` (doc_id, text, anything else).

    Rows link if their fingerprints differ in at most ``radius`` (3 or fewer) bits;
    component_id is the smallest doc_id reachable, root the component's smallest
    fingerprint as a long, mark a hash of the text. Null texts count as empty; texts
    without words have fingerprint zero and link like any other. Repeated rows are
    kept and share a component. A null doc_id is kept and is never the smallest
    unless all are null. Rows with equal fingerprints are one node of the search,
    however many they are. An empty table gives an empty one.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"radius must lie between 0 and {RADIUS}")
    prints = stored(fingerprints(docs, words))
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    links = bucket_links(in_parts(keyed(nodes), part_rows), radius)
    roots = nodes.join(components(links).withColumnRenamed("node", "fp"), "fp", "left")
    roots = roots.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = roots.join(least, "root").select("fp", "root", "component_id")
    return prints.join(labels, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def wide_print(own: np.ndarray) -> np.ndarray:
    """WIDE SimHashes of 64 bits of a set of shingles (their 64-bit hashes)."""
    ones = np.zeros(WIDE * 64, np.int64)
    for part in range(0, len(own), 255):
        mixed = (own[part:part + 255, None] ^ SALTS) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        # Sums of 255 bits fit into their byte.
        ones += _SPREAD.take(mixed.view(np.uint8)).sum(axis=0, dtype=np.uint64).view(np.uint8)
    return np.packbits(ones * 2 > len(own), bitorder="little").view("<u8")


def wide_keyed(nodes: DataFrame) -> DataFrame:
    """(key, node, c0, c1): for each row of ``nodes`` (node, print) its keys, each with the fingerprints that are checked."""
    tables = FIELDS // WIDE_FIELDS
    weights = 3 ** np.arange(WIDE_FIELDS, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch["node"].to_numpy(zero_copy_only=False)
            prints = np.frombuffer(b"".join(batch["print"].to_pylist()), "<u8").reshape(len(node), WIDE)
            for word in range(WIDE):
                distances = pivot_distances(prints[:, word])
                ones = (distances[:, :1] + 2 - distances[:, 1:]).astype(np.int64) // 2
                codes = ones.reshape(len(node), tables, WIDE_FIELDS) @ weights
                keys = codes * (WIDE * tables) + word * tables + np.arange(tables)
                checked = [np.repeat(prints[:, (word + k) % WIDE].view(np.int64), tables) for k in range(1, CHECKED + 1)]
                arrays = [keys.ravel(), np.repeat(node, tables), *checked]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["key", "node", "c0", "c1"])

    return nodes.select("node", "print").mapInArrow(run, "key long, node long, c0 long, c1 long")


def labels_of_run(checked: list[np.ndarray], radius: int) -> np.ndarray:
    """Label of each row: the first row of its component of rows that differ in at most ``radius`` bits."""
    n = len(checked[0])
    labels = np.arange(n)
    for start in range(0, n - 1, 64):
        end = min(start + 64, n)
        distance = sum(np.bitwise_count(c[start:end, None] ^ c[None, start:]) for c in checked)
        near = (distance <= radius) & (labels[start:end, None] != labels[None, start:])
        left, right = np.nonzero(near)
        merged(labels, start + left, start + right)
    return labels


def wide_links(nodes: DataFrame, radius: int = WIDE_RADIUS, part_rows: int = WIDE_ROWS) -> DataFrame:
    """Links (a, b) between the nodes of ``nodes`` (node, print) that share a key and are within the radius.

    Of the links within a key a spanning forest is given. Large keys become pairs of
    parts of bounded size.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = {c: batch[c].to_numpy(zero_copy_only=False) for c in batch.schema.names}
            if rest is not None:
                table = {c: np.concatenate([rest[c], table[c]]) for c in table}
            starts = np.flatnonzero(np.logical_or.reduce([np.diff(table[c]) != 0 for c in by])) + 1
            bounds = [0, *starts.tolist()]
            yield from linked(table, bounds)
            rest = {c: v[bounds[-1]:] for c, v in table.items()}
        if rest is not None:
            yield from linked(rest, [0, len(rest["node"])])

    def linked(table, bounds):
        a, b = [], []
        unsigned = [table[c].view(np.uint64) for c in ("c0", "c1")]
        for start, end in zip(bounds, bounds[1:]):
            if end - start > 1:
                labels = labels_of_run([u[start:end] for u in unsigned], radius)
                joined = np.flatnonzero(labels != np.arange(len(labels)))
                a.append(table["node"][start:end][joined])
                b.append(table["node"][start:end][labels[joined]])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])

    by = ["key", "lo", "hi"]
    rows = wide_keyed(nodes)
    # Few keys are large: no more than the rows by part_rows.
    large = rows.groupBy("key").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts")).where("parts > 1")
    rows = rows.join(F.broadcast(large), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node", "c0", "c1")
    # By node, so that all keys of a group of near copies lead to the same few smallest nodes.
    ordered = rows.repartition(*by).sortWithinPartitions(*by, "node")
    return ordered.mapInArrow(run, "a long, b long")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the smallest doc_id stays.

    Ties (equal ids) go to the lowest hash of the text, and of repeated rows one stays.
    All columns are kept as they are; a null doc_id stays only where no other is.
    """
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "mark")
    first = near_duplicates(docs).groupBy("root").agg(F.min(order).alias("first"))
    chosen = first.select(F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_of")).distinct()
    same = F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own_mark") == F.col("_of"))
    kept = packed(docs, docs.columns).join(chosen, same, "left_semi").dropDuplicates(["own_id", "own_mark"])
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
