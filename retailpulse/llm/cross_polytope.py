"""Near-duplicate embeddings by cross-polytope hashing, with exact cosine on what meets.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its
hash is the coordinate of largest magnitude with its sign, two rotations to a table. A
vector lies in its own bucket of every table and probes the next likely ones, those
whose coordinates are nearly as large. Pairs in a bucket, of which one lies there, are
verified by their cosine in double precision.

Equal vectors are one class, so copies never meet. Large buckets are cut into pairs of
parts. A pair may meet several times; its first meeting counts, so tasks return sums
of links and a spanning forest, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.llm.common import stored
from retailpulse.llm.graph import components
from retailpulse.llm.simhash_pivots import merged

THRESHOLD = 0.95
TABLES = 8
PROBES = 4
SEED = 20240301
#: Rows of one bucket that one task compares; larger buckets are cut into pairs of such parts.
PART_ROWS = 2048


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows; their length is a power of two."""
    n, size = x.shape
    step = 1
    while step < size:
        y = x.reshape(n, size // (2 * step), 2, step)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, size)
        step *= 2
    return x / np.sqrt(size)


def buckets(x: np.ndarray, tables: int, probes: int, seed: int) -> np.ndarray:
    """(rows, tables, 1 + probes) bucket codes of unit vectors: the own one, then the probed ones."""
    width = 1 << max(1, int(np.ceil(np.log2(max(2, x.shape[1])))))
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    random = np.random.default_rng([seed, width])
    out = np.empty((len(x), tables, 1 + probes), np.int64)
    depth = min(3, 2 * width)
    for table in range(tables):
        codes, losses = [], []
        for _ in range(2):
            y = x
            for _ in range(3):
                y = hadamard(y * random.choice([-1.0, 1.0], width))
            signed = np.concatenate([y, -y], axis=1)
            order = np.argsort(-signed, axis=1, kind="stable")[:, :depth]
            best = np.take_along_axis(signed, order, axis=1)
            codes.append(order)
            losses.append((best[:, :1] - best) ** 2)
        pairs = [(a, b) for a in range(depth) for b in range(depth)]
        loss = np.stack([losses[0][:, a] + losses[1][:, b] for a, b in pairs], axis=1)
        code = np.stack([codes[0][:, a] * (2 * width) + codes[1][:, b] for a, b in pairs], axis=1)
        near = np.argsort(loss, axis=1, kind="stable")[:, : 1 + probes]
        found = np.take_along_axis(code, near, axis=1)
        # Where fewer exist, the own bucket is repeated.
        out[:, table] = np.pad(found, ((0, 0), (0, 1 + probes - found.shape[1])), mode="edge") if found.shape[1] <= probes else found
    return out


def unit_rows(data: list[bytes], kind: str) -> np.ndarray:
    x = np.stack([np.frombuffer(d, kind) for d in data]).astype(np.float64)
    # Large and small components alike: scaled first, so that squares stay finite.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.square(x).sum(axis=1, keepdims=True))


def classes_of(vectors: DataFrame, id_column: str, column: str) -> tuple[DataFrame, str]:
    """(id, node, dims, data) of every row and the kind of number; node is null for vectors that link with nothing."""
    kind = "<f4" if dict(vectors.dtypes)[column] == "array<float>" else "<f8"

    def run(batches):
        for batch in batches:
            out = []
            for value in batch["v"].to_pylist():
                ok = value is not None and len(value) and None not in value
                x = np.array(value, kind) if ok else None
                out.append(x.tobytes() if ok and np.isfinite(x).all() and x.any() else None)
            dims = pa.array([None if d is None else len(d) // int(kind[2]) for d in out], pa.int32())
            yield pa.RecordBatch.from_arrays([batch["id"], dims, pa.array(out, pa.binary())], names=["id", "dims", "data"])

    chosen = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{column}`").alias("v"))
    if kind == "<f8":
        chosen = chosen.withColumn("v", F.col("v").cast("array<double>"))
    read = chosen.mapInArrow(run, "id long, dims int, data binary")
    # Minus zero is zero: both give the same direction, and rows that differ in it alone still meet.
    return read.withColumn("node", F.when(F.col("data").isNotNull(), F.xxhash64("dims", "data"))), kind


def placed(nodes: DataFrame, kind: str, tables: int, probes: int, seed: int) -> DataFrame:
    """(bucket, role, node, size, codes, data): role 0 in the own bucket, 1 where it is only probed."""
    def run(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                some = batch.slice(part, 500)
                dims = some["dims"].to_numpy()
                for d in np.unique(dims):
                    rows = np.flatnonzero(dims == d)
                    data = some["data"].take(pa.array(rows))
                    codes = buckets(unit_rows(data.to_pylist(), kind), tables, probes, seed)
                    spread = codes * tables + np.arange(tables)[None, :, None]
                    spread = spread * 65536 + int(d) % 65536
                    flat = spread.reshape(len(rows), -1)
                    who = np.repeat(np.arange(len(rows)), flat.shape[1])
                    role = np.tile(np.tile([0] + [1] * probes, tables), len(rows)).astype(np.int8)
                    at = flat.ravel()
                    # A probe of the own bucket says nothing new.
                    keep = (role == 0) | (at != np.repeat(spread[:, :, :1].repeat(1 + probes, axis=2).reshape(len(rows), -1), 1).ravel())
                    take = pa.array(who[keep])
                    own = [flat[r].astype("<i8").tobytes() for r in range(len(rows))]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(at[keep]), pa.array(role[keep]), some["node"].take(pa.array(rows)).take(take),
                        some["size"].take(pa.array(rows)).take(take), pa.array(own, pa.binary()).take(take), data.take(take),
                    ], names=["bucket", "role", "node", "size", "codes", "data"])

    return nodes.select("node", "size", "dims", "data").mapInArrow(
        run, "bucket long, role byte, node long, size long, codes binary, data binary"
    )


def in_parts(rows: DataFrame, part_rows: int) -> DataFrame:
    """``rows`` with lo, hi, own: large buckets as pairs of parts, buckets without a pair left out."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if(F.col("role") == 0).alias("lying")).where("n > 1 AND lying > 0")
    sizes = sizes.select("bucket", F.ceil(F.col("n") / part_rows).cast("int").alias("parts"))
    rows = rows.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("other", "parts")


def first_meeting(a: np.ndarray, b: np.ndarray, tables: int) -> np.ndarray:
    """The smallest bucket in which pairs of code rows (pairs, tables, 1 + probes) meet."""
    never = np.iinfo(np.int64).max
    in_a = np.where((b == a[:, :, :1]).any(axis=2), a[:, :, 0], never)
    in_b = np.where((a == b[:, :, :1]).any(axis=2), b[:, :, 0], never)
    return np.minimum(in_a, in_b).min(axis=1)


def compared(rows: DataFrame, kind: str, threshold: float, tables: int) -> DataFrame:
    """(a, b, n): n more links of node a (b null), and links (a, b) that join what is linked (n null)."""
    by = ["bucket", "lo", "hi"]

    def of_run(table: pa.Table):
        n = table.num_rows
        x = unit_rows(table["data"].to_pylist(), kind)
        role, own = table["role"].to_numpy(), table["own"].to_numpy()
        node, size = table["node"].to_numpy(), table["size"].to_numpy()
        codes = np.stack([np.frombuffer(c, "<i8") for c in table["codes"].to_pylist()]).reshape(n, tables, -1)
        bucket, split = table["bucket"][0].as_py(), table["lo"][0].as_py() != table["hi"][0].as_py()
        labels, links = np.arange(n), np.zeros(n, np.int64)
        for start in range(0, n, 512):
            cosine = x[start:start + 512] @ x.T
            near = cosine >= threshold
            i, j = np.nonzero(near)
            i = i + start
            # Both lists hold their rows in the same order, so each pair is seen once.
            ok = (i < j) & ((role[i] == 0) | (role[j] == 0))
            if split:
                ok &= own[i] != own[j]
            i, j = i[ok], j[ok]
            for part in range(0, len(i), 20_000):
                p, q = i[part:part + 20_000], j[part:part + 20_000]
                first = first_meeting(codes[p], codes[q], tables) == bucket
                np.add.at(links, p[first], size[q[first]])
                np.add.at(links, q[first], size[p[first]])
                merged(labels, p, q)
        counted, linked = np.flatnonzero(links), np.flatnonzero(labels != np.arange(n))
        a = np.concatenate([node[counted], node[linked]])
        b = pa.array([None] * len(counted) + node[labels[linked]].tolist(), pa.int64())
        more = pa.array(links[counted].tolist() + [None] * len(linked), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, more], names=["a", "b", "n"])

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            keys = np.stack([table[c].to_numpy() for c in by])
            cuts = [0, *(np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    yield of_run(table.slice(a, b - a))
            rest = table.slice(cuts[-1])
        if rest is not None and rest.num_rows > 1:
            yield of_run(rest)

    ordered = rows.repartition(*by).sortWithinPartitions(*by)
    return ordered.mapInArrow(run, "a long, b long, n long")


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    column: str = "embedding",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    probes: int = PROBES,
    seed: int = SEED,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(id, n_links, component_id) of every row of ``vectors``.

    Vectors of equal length link if they meet in a bucket and their cosine is at least
    ``threshold``. n_links counts the other rows linked directly, component_id is the
    smallest id reachable. Vectors that are null, empty, zero, or hold null or
    non-finite components link with nothing and are their own component. Repeated rows
    are kept and link with each other; a null id is never the smallest unless all are
    null. An empty table gives an empty one.
    """
    rows, kind = classes_of(vectors, id_column, column)
    rows = stored(rows.select("id", "node", "dims", "data"))
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min("id").alias("least"), F.count("*").alias("size"), F.first("dims").alias("dims"), F.first("data").alias("data")
    )
    nodes = stored(nodes)
    parts = in_parts(placed(nodes, kind, tables, probes, seed), part_rows)
    found = stored(compared(parts, kind, threshold, tables))
    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"))
    labels = nodes.select("node", "least", "size").join(links, "node", "left").join(roots, "node", "left")
    labels = labels.select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    smallest = labels.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = labels.join(smallest, "root").select("node", "n_links", "component_id")
    joined = rows.select("id", "node").join(labels, "node", "left")
    alone = F.col("node").isNull()
    return joined.select(
        "id", F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
