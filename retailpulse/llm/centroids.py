"""Centroid clustering over zone maps: blocks of vectors along a Hilbert curve with their boxes.

Box distances leave each block the centroids that may be nearest to one of its vectors;
these are compared exactly, in whole numbers (``hilbert_blocks``).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.llm.common import stored
from retailpulse.llm.hilbert_blocks import assigned, finite, in_blocks, rounds_of, scaled

SCALE = 256
DIMS = 64
CLUSTERS = 40
ROUNDS = 5
SEED = 2


@dataclass(frozen=True)
class Clustering:
    """``rows`` with their clusters, and the centroids (clusters x dimensions)."""

    rows: DataFrame
    centroids: np.ndarray

    def checksums(self) -> list[str]:
        """SHA-256 of each centroid's components, comma-joined."""
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids.tolist()]


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    column: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    dims: int = DIMS,
    seed: int = SEED,
    out: str = "cluster",
    distance: str = "distance",
) -> Clustering:
    """Cluster (int) and squared distance to its centroid (long) of the ``vectors`` with ``dims`` components.

    Components become floor(scale * x), held to 2**24 in size. Centroids start as the
    vectors with the smallest SHA-256 of "seed:id" (null ids last, then by vector; fewer
    rows give fewer centroids); repeated rows are rows of their own. Vectors that are
    null, of another length, or hold null or non-finite components are dropped. Kept
    rows keep all columns but the vector; columns named ``out`` and ``distance`` are
    replaced. An empty table gives an empty one without centroids.
    """
    others = [c for c in vectors.columns if c not in (column, out, distance)]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")
    kept = vectors.where(finite(column) & (F.size(F.col(f"`{column}`")) == dims))
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{id_column}`").cast("long").cast("string")).cast("binary"), 256)
    kept = stored(kept.select(F.monotonically_increasing_id().alias("id"), rank.alias("rank"), row, scaled(column, scale).alias("v")))
    starts = kept.orderBy(F.col("rank").asc_nulls_last(), "v").limit(clusters).select("v").collect()
    if not starts:
        empty = kept.select("row.*", F.lit(None).cast("int").alias(out), F.lit(None).cast("long").alias(distance))
        return Clustering(empty, np.zeros((0, dims), np.int64))
    blocks = in_blocks(kept.select(F.lit(0).alias("part"), "id", "v"))
    centroids = rounds_of(blocks, {0: np.array([r.v for r in starts], np.int64)}, rounds)
    found = assigned(blocks, centroids).drop("part")
    joined = kept.select("id", "row").join(found, "id")
    return Clustering(joined.select("row.*", F.col("entry").alias(out), F.col("distance").alias(distance)), centroids[0])
