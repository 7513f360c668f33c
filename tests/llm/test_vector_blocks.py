"""Vector codes (op12) and centroids (op13) against plain loops, and the blocks below them."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailpulse.llm import centroids, hilbert_blocks, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def vectors(n, dims, seed, copies=0):
    """Rows around a few centres; a third may be copies of one vector."""
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(k, [m + rng.gauss(0, 0.2) for m in middles[k % 5]], k % 3 or None) for k in range(n)]
    return rows + [(n + k, rows[0][1], 1) for k in range(copies)]


def odd_vectors(dims):
    nan, inf = float("nan"), float("inf")
    return [
        (900, None, 1), (901, [], 1), (902, [nan] * dims, None), (903, [inf] + [0.0] * (dims - 1), 2), (904, [None] + [1.0] * (dims - 1), 2),
        (905, [0.0] * dims, None), (905, [0.0] * dims, None), (None, [1.0] * dims, 1), (906, [1.0] * (dims - 1), 1), (907, [1e300] * dims, 1),
        (908, [-1e300] * dims, 1), (909, [1.0] * (dims + 4), 1),
    ]


def whole(rows, scale, dims, parts=1):
    kept = []
    for i, v, label in rows:
        if v and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            top = hilbert_blocks.LIMIT
            kept.append((i, tuple(int(max(-top, min(top, np.floor(scale * x)))) for x in v), label))
    return kept


def lloyd(points, centres, rounds):
    """Nearest centre and distance of every point, all compared; the centres at the end."""
    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for p in points:
            members.setdefault(nearest(p)[1], []).append(p)
        centres = [tuple(sum(x) // len(members[k]) for x in zip(*members[k])) if k in members else c for k, c in enumerate(centres)]
    return [nearest(p) for p in points], centres


def test_the_curve_visits_every_cell_and_moves_to_a_neighbour():
    for dims, bits in ((2, 4), (3, 3), (5, 2), (4, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = [k.tobytes() for k in hilbert_blocks.curve_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_short_lists_hold_the_nearest_centre():
    rng = np.random.default_rng(3)
    for spread in (1, 30, 400):
        centres = rng.integers(-200, 200, (40, 6))
        centres[7] = centres[3]
        x = rng.integers(-200, 200, 6) + rng.integers(0, spread, (50, 6))
        every = ((x[:, None] - centres) ** 2).sum(axis=2)
        entry, distance = hilbert_blocks.nearest(x, x.min(axis=0), x.max(axis=0), centres)
        assert entry.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()


def test_large_components_are_compared_exactly():
    top = hilbert_blocks.LIMIT
    x, c = np.array([[top, -top, top - 1]], np.int64), np.array([[-top, top, -top], [top, -top, top]], np.int64)
    assert hilbert_blocks.squared_distances(x, c).tolist() == [[4 * top * top * 2 + (2 * top - 1) ** 2, 1]]


@pytest.mark.parametrize("block_rows", [1, 7, 128])
def test_blocks_hold_every_vector_once(spark, block_rows):
    rows = [(p, k, [k * 7 % 31, k % 5, p]) for p in range(2) for k in range(60)] + [(0, 1000 + k, [1, 1, 0]) for k in range(60)]
    found = hilbert_blocks.in_blocks(spark.createDataFrame(rows, "part int, id long, v array<int>"), block_rows).collect()
    seen = []
    for b in found:
        x = np.frombuffer(b.data, "<i4").reshape(len(b.ids), -1)
        assert 1 <= len(b.ids) <= block_rows
        assert (b.low, b.high, b.sums) == (x.min(axis=0).tolist(), x.max(axis=0).tolist(), x.sum(axis=0).tolist())
        seen += [(b.part, i, v) for i, v in zip(b.ids, x.tolist())]
    assert sorted(seen) == sorted(rows)


@pytest.mark.parametrize("odd", [False, True])
def test_clusters_are_those_of_a_plain_loop(spark, odd):
    rows = vectors(150, 8, 1, copies=60) + (odd_vectors(8) if odd else [])
    kept = whole(rows, 256, 8)
    rank = {i: hashlib.sha256(f"2:{i}".encode()).hexdigest() for i, _, _ in kept if i is not None}
    order = sorted(kept, key=lambda r: (r[0] is None, rank.get(r[0], ""), r[1]))
    want, middles = lloyd([v for _, v, _ in kept], [v for _, v, _ in order[:12]], 5)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"cluster": F.lit("own"), "row": F.lit("own row"), "id": F.lit("own id")})
    found = centroids.cluster(df, clusters=12, dims=8)
    got = [(r.vec_id, r.cluster, r.distance, r.label, r.row, r.id) for r in found.rows.collect()]
    assert sorted(got, key=repr) == sorted([(i, k, d, label, "own row", "own id") for (i, _, label), (d, k) in zip(kept, want)], key=repr)
    assert [tuple(c) for c in found.centroids.tolist()] == middles
    assert found.rows.columns == ["vec_id", "label", "row", "id", "cluster", "distance"]


@pytest.mark.parametrize("odd", [False, True])
def test_codes_are_those_of_a_plain_loop(spark, odd):
    rows = vectors(150, 12, 2, copies=60) + (odd_vectors(12) if odd else [])
    kept = whole(rows, 1024, 12)
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:20]
    codes, errors, books = [[] for _ in kept], [0] * len(kept), {}
    for p in range(4):
        found, books[p] = lloyd([v[3 * p:3 * p + 3] for _, v, _ in kept], [v[3 * p:3 * p + 3] for _, v, _ in order], 4)
        for k, (d, entry) in enumerate(found):
            codes[k].append(entry)
            errors[k] += d
    done = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).withColumn("codes", F.lit("own")), entries=20)
    got = done.rows.collect()
    assert sorted([(r.vec_id, r.codes, r.error, r.label) for r in got], key=repr) == sorted(
        [(i, c, e, label) for (i, _, label), c, e in zip(kept, codes, errors)], key=repr
    )
    assert {p: [tuple(x) for x in b.tolist()] for p, b in done.codebooks.items()} == books
    by_id = {i: v for i, v, _ in kept}
    for r in got:
        if r.vec_id is not None:
            assert sum((a - b) ** 2 for a, b in zip(done.restored(r.codes), by_id[r.vec_id])) == r.error


def test_empty_tables_and_fewer_rows_than_centres(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert centroids.cluster(empty).rows.count() == 0 and vector_codes.compress(empty).rows.count() == 0
    assert vector_codes.compress(spark.createDataFrame(odd_vectors(5)[:5], SCHEMA)).rows.count() == 0
    two = spark.createDataFrame(vectors(2, 64, 4), SCHEMA)
    assert sorted(r.distance for r in centroids.cluster(two).rows.collect()) == [0, 0]
    done = vector_codes.compress(two)
    assert sorted(r.error for r in done.rows.collect()) == [0, 0] and len(done.codebooks[0]) == 2
