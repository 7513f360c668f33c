"""Integer vectors in blocks along a Hilbert curve, and exact k-means rounds over the blocks.

A block holds neighbours on the curve with their smallest and largest component per
dimension (its box) and the sum of its vectors. The distances from a box to all
centres bound those of its vectors: a centre farther at best than another one is at
worst cannot be nearest to any of them. Only the others are compared, in whole numbers;
a block with one such centre gives its stored sum at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpulse.llm.common import stored
from retailpulse.session import shuffle_width

#: Components beyond are held to this, so that squared distances of up to 4,096 dimensions fit 64 bits.
LIMIT = 1 << 24
#: Sums of squares below this are exact in doubles.
EXACT = 1 << 53
#: Bits of a curve position, over all dimensions.
KEY_BITS = 256
BLOCK_ROWS = 128
#: Vectors that are placed on the curve at a time.
SLICE = 4096


def finite(column: str) -> Column:
    """Whether a vector has components, none of them null, infinite or not a number."""
    def sound(x):
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    v = F.col(f"`{column}`")
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(F.forall(v, sound), F.lit(False))


def scaled(column: str, scale: int) -> Column:
    """floor(scale * x) of every component, held to ``LIMIT``."""
    def whole(x):
        return F.least(F.greatest(F.floor(x.cast("double") * F.lit(float(scale))), F.lit(-LIMIT)), F.lit(LIMIT)).cast("int")

    return F.transform(F.col(f"`{column}`"), whole)


def curve_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of rows of ``bits``-bit numbers, as bytes that sort alike."""
    axes = np.ascontiguousarray(x.T).astype(np.int64)
    dims, n = axes.shape
    for bit in reversed(range(1, bits)):
        low = (1 << bit) - 1
        for k in range(dims):
            set_ = (axes[k] >> bit) & 1 == 1
            swap = np.where(set_, 0, (axes[0] ^ axes[k]) & low)
            axes[0] ^= np.where(set_, low, swap)
            if k:
                axes[k] ^= swap
    for k in range(1, dims):
        axes[k] ^= axes[k - 1]
    flips = np.zeros(n, np.int64)
    for bit in reversed(range(1, bits)):
        flips ^= np.where((axes[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    axes ^= flips
    planes = [(axes >> bit) & 1 for bit in reversed(range(bits))]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as rows of whole numbers."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def ranges(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Smallest and largest components of every part; at most parts x dimensions rows reach the driver."""
    def run(batches):
        low, high = {}, {}
        for batch in batches:
            parts = batch["part"].to_numpy()
            for p in np.unique(parts).tolist():
                x = matrix(batch["v"].filter(pa.array(parts == p)))
                low[p] = np.minimum(low.get(p, x[0]), x.min(axis=0))
                high[p] = np.maximum(high.get(p, x[0]), x.max(axis=0))
        for p in low:
            n = len(low[p])
            yield pa.RecordBatch.from_arrays(
                [pa.array([p] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(low[p]), pa.array(high[p])],
                names=["part", "pos", "low", "high"],
            )

    found = rows.select("part", "v").mapInArrow(run, "part int, pos int, low long, high long")
    found = found.groupBy("part", "pos").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    out: dict[int, list] = {}
    for r in sorted(found.collect(), key=lambda r: r.pos):
        out.setdefault(r.part, []).append((r.low, r.high))
    return {p: tuple(np.array(x, np.int64) for x in zip(*pairs)) for p, pairs in out.items()}


def in_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(part, ids, data, low, high, sums) of ``rows`` (part int, id long, v array<int> of one length a part), stored.

    Rows are dealt to tasks by ranges of the curve; equal vectors, however many, are
    spread by a salt. ``data`` has a block's vectors as little-endian 32-bit numbers,
    the others are arrays over its dimensions. An empty table gives an empty one.
    """
    spans = ranges(rows)

    def keyed(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                some = batch.slice(start, SLICE)
                parts = some["part"].to_numpy()
                for p in np.unique(parts).tolist():
                    own = some.filter(pa.array(parts == p))
                    x = matrix(own["v"])
                    bits = max(1, min(8, KEY_BITS // x.shape[1]))
                    low, high = spans[p]
                    cell = (x - low) * (1 << bits) // (high - low + 1)
                    keys = [k.tobytes() for k in curve_keys(cell, bits)]
                    data = [v.tobytes() for v in x.astype("<i4")]
                    yield pa.RecordBatch.from_arrays(
                        [own["part"], pa.array(keys, pa.binary()), own["salt"], own["id"], pa.array(data, pa.binary())],
                        names=["part", "key", "salt", "id", "data"],
                    )

    def block(part, ids, data):
        x = np.frombuffer(b"".join(data), "<i4").reshape(len(ids), -1).astype(np.int64)
        columns = [pa.array([part], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([b"".join(data)], pa.binary())]
        columns += [pa.array([v.tolist()], pa.list_(pa.int64())) for v in (x.min(axis=0), x.max(axis=0), x.sum(axis=0))]
        return pa.RecordBatch.from_arrays(columns, names=["part", "ids", "data", "low", "high", "sums"])

    def cut(batches):
        part, ids, data = None, [], []
        for batch in batches:
            for p, i, d in zip(*(batch[c].to_pylist() for c in ("part", "id", "data"))):
                if ids and (p != part or len(ids) == block_rows):
                    yield block(part, ids, data)
                    ids, data = [], []
                part = p
                ids.append(i)
                data.append(d)
        if ids:
            yield block(part, ids, data)

    salted = rows.select("part", "id", "v", F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    placed = salted.mapInArrow(keyed, "part int, key binary, salt long, id long, data binary")
    order = ["part", "key", "salt"]
    placed = placed.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
    kinds = "part int, ids array<long>, data binary, low array<long>, high array<long>, sums array<long>"
    return stored(placed.select("part", "id", "data").mapInArrow(cut, kinds))


def shortlist(low: np.ndarray, high: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Numbers of the centres that may be nearest to a vector of the box, ascending."""
    least = np.square(np.maximum(np.maximum(low - centres, centres - high), 0)).sum(axis=1)
    most = np.square(np.maximum(np.abs(centres - low), np.abs(centres - high))).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(rows, centres), exact."""
    most = max(np.abs(x).max(), np.abs(centres).max())
    if 4 * x.shape[1] * int(most) ** 2 < EXACT:
        a, c = x.astype(np.float64), centres.astype(np.float64)
        return (np.square(a).sum(axis=1)[:, None] - 2 * (a @ c.T) + np.square(c).sum(axis=1)).astype(np.int64)
    return np.stack([np.square(x - c).sum(axis=1) for c in centres], axis=1)


def nearest(x: np.ndarray, low: np.ndarray, high: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centre; of equally near ones the smallest number."""
    some = shortlist(low, high, centres)
    found = squared_distances(x, centres[some])
    best = found.argmin(axis=1)
    return some[best], found[np.arange(len(x)), best]


def _blocks_of(batch: pa.RecordBatch):
    """(part, data, low, high, sums) of every block of a batch."""
    boxes = zip(*(batch[c] for c in ("part", "data", "low", "high", "sums")))
    for part, data, *arrays in boxes:
        yield part.as_py(), data, *(a.values.to_numpy() for a in arrays)


def _vectors(data: pa.BinaryScalar, dims: int) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), "<i4").reshape(-1, dims).astype(np.int64)


def rounds_of(blocks: DataFrame, centres: dict[int, np.ndarray], rounds: int) -> dict[int, np.ndarray]:
    """``centres`` of each part after so many rounds of assigning all vectors and taking floors of means.

    Centres without vectors stay. Tasks return one sum for each centre that they met,
    so what is shuffled and brought to the driver grows with the centres alone.
    """
    for _ in range(rounds):
        now = centres

        def run(batches, centres=now):
            totals = {p: np.zeros((len(c), c.shape[1] + 1), np.int64) for p, c in centres.items()}
            for batch in batches:
                for part, data, low, high, sums in _blocks_of(batch):
                    dims, total = len(low), totals[part]
                    some = shortlist(low, high, centres[part])
                    if len(some) == 1:
                        total[some[0], :dims] += sums
                        total[some[0], dims] += len(data.as_buffer()) // (4 * dims)
                    else:
                        x = _vectors(data, dims)
                        entry = some[squared_distances(x, centres[part][some]).argmin(axis=1)]
                        np.add.at(total, entry, np.pad(x, ((0, 0), (0, 1)), constant_values=1))
            for p, total in totals.items():
                met = np.flatnonzero(total[:, -1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p] * len(met), pa.int32()), pa.array(met, pa.int32()), pa.array(total[met].tolist(), pa.list_(pa.int64()))],
                    names=["part", "entry", "total"],
                )

        found = blocks.select("part", "data", "low", "high", "sums").mapInArrow(run, "part int, entry int, total array<long>")
        found = found.select("part", "entry", F.posexplode("total").alias("pos", "x")).groupBy("part", "entry", "pos").agg(F.sum("x").alias("x"))
        totals = {p: np.zeros((len(c), c.shape[1] + 1), np.int64) for p, c in centres.items()}
        for r in found.collect():
            totals[r.part][r.entry, r.pos] = r.x
        centres = {}
        for p, total in totals.items():
            n = total[:, -1:]
            centres[p] = np.where(n > 0, total[:, :-1] // np.maximum(n, 1), now[p])
    return centres


def assigned(blocks: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """(part, id, entry, distance) of every vector."""
    def run(batches):
        for batch in batches:
            for ids, (part, data, low, high, _) in zip(batch["ids"], _blocks_of(batch)):
                entry, distance = nearest(_vectors(data, len(low)), low, high, centres[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(entry), part), pa.int32()), ids.values, pa.array(entry, pa.int32()), pa.array(distance, pa.int64())],
                    names=["part", "id", "entry", "distance"],
                )

    return blocks.mapInArrow(run, "part int, id long, entry int, distance long")
