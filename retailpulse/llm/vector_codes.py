"""Vector codes: each part of a vector becomes the number of its nearest codebook entry.

The parts of every position lie in blocks along a Hilbert curve (``hilbert_blocks``);
codebooks are learnt by rounds of exact integer k-means over the blocks, in which box
distances leave each block a short list of entries.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailpulse.llm.common import stored
from retailpulse.llm.hilbert_blocks import assigned, finite, in_blocks, rounds_of, scaled

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4


@dataclass(frozen=True)
class Compressed:
    """``rows`` with codes, and the codebook (entries x part length) of each part position."""

    rows: DataFrame
    codebooks: dict[int, np.ndarray]

    def checksum(self) -> str:
        """SHA-256 of all entries' components by part, entry and position, comma-joined."""
        numbers = [str(x) for p in sorted(self.codebooks) for x in self.codebooks[p].ravel().tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def restored(self, codes: list[int]) -> list[int]:
        """The integer vector that a row's ``codes`` stand for."""
        return [x for p, code in enumerate(codes) for x in self.codebooks[p][code].tolist()]


def compress(
    vectors: DataFrame,
    id_column: str = "vec_id",
    column: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    codes: str = "codes",
    error: str = "error",
) -> Compressed:
    """Codes (array<int>, one a part) and error (long, squared distance to what they stand for) of ``vectors``.

    Components become floor(scale * x), held to 2**24 in size. Codebooks start as the
    parts of the ``entries`` smallest ids, ascending (null ids last, then by vector;
    fewer rows give fewer entries); repeated rows are rows of their own. Dropped are
    vectors that are null, empty, hold null or non-finite components, cannot be cut
    into ``parts``, or differ in length from the first of the rest in that order.
    Kept rows keep all columns but the vector; columns named ``codes`` and ``error``
    are replaced. An empty table gives an empty one without codebooks.
    """
    others = [c for c in vectors.columns if c not in (column, codes, error)]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")
    kept = vectors.where(finite(column) & (F.size(F.col(f"`{column}`")) % parts == 0))
    kept = kept.select(
        F.monotonically_increasing_id().alias("id"), F.col(f"`{id_column}`").cast("long").alias("own"), row, scaled(column, scale).alias("v")
    )
    kept = stored(kept)
    ordered = kept.orderBy(F.col("own").asc_nulls_last(), "v").select("v")
    first = ordered.first()
    if first is None:
        return Compressed(kept.select("row.*", F.lit(None).cast("array<int>").alias(codes), F.lit(None).cast("long").alias(error)), {})
    dims = len(first.v)
    kept = kept.where(F.size("v") == dims)
    starts = np.array([r.v for r in ordered.where(F.size("v") == dims).limit(entries).collect()], np.int64)
    width = dims // parts
    books = {p: starts[:, p * width:(p + 1) * width] for p in range(parts)}
    cut = F.posexplode(F.array(*[F.slice("v", 1 + p * width, width) for p in range(parts)])).alias("part", "v")
    blocks = in_blocks(kept.select("id", cut))
    books = rounds_of(blocks, books, rounds)
    found = assigned(blocks, books).groupBy("id").agg(
        F.array(*[F.max(F.when(F.col("part") == p, F.col("entry"))) for p in range(parts)]).alias("codes"), F.sum("distance").alias("error")
    )
    joined = kept.select("id", "row").join(found, "id")
    rows = joined.select("row.*", F.col("codes").alias(codes), F.col("error").alias(error))
    return Compressed(rows, books)
