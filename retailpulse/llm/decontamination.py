"""Benchmark passages in documents: SimHash of item-sized windows, then exact similarity.

A window that is at least ``THRESHOLD`` similar to an item holds that share of the
item's shingles. So of evenly spaced shingles of an item, one more than may be missing
is enough to find every such window; it is laid over the document so that the shared
shingle sits where the item has it. Windows and items are fingerprinted, fingerprints
meet through blocks of bits (two fingerprints within the radius agree in one block up
to a few bits, all of which are listed for the items), and pairs within the radius
are verified by the weighted Jaccard similarity of their shingles, each weighing as
often as it occurs. DataFrame operations only.
"""

from __future__ import annotations

import string
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpulse.llm.common import packed, stored

WORDS = 5
THRESHOLD = 0.8
#: Fingerprints of windows 0.8 similar differ in about 10 of 64 bits; this is over three deviations more.
RADIUS = 20
BLOCKS = [(0, 9), (9, 9), (18, 9), (27, 9), (36, 9), (45, 9), (54, 10)]
#: Anchor shingles and block keys of the benchmark are broadcast up to so many rows (some 20 MB), else joined by shuffle.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    """Runs of other characters than ASCII white space, A-Z lower-cased."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def starts(words: Column) -> Column:
    """1, 2, ... for each shingle; a text of fewer words has one, one without words none."""
    last = F.greatest(F.size(words) - WORDS + 1, F.lit(1))
    return F.when(F.size(words) > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(text: Column) -> Column:
    """A hash of each run of five words, in order, from the words' hashes."""
    hashes = F.transform(words_of(text), lambda w: F.xxhash64(w))
    return bound(hashes, lambda h: F.transform(starts(h), lambda i: F.xxhash64(F.slice(h, i, WORDS))))


def shingles(words: Column, first: Column, n: Column) -> Column:
    """Texts of ``n`` shingles of ``words`` from the ``first`` (0, 1, ...)."""
    return F.when(n > 0, F.transform(
        F.sequence(first + 1, first + n), lambda i: F.array_join(F.slice(words, i, WORDS), " ")
    )).otherwise(F.array().cast("array<string>"))


def fingerprint(pieces: Column) -> Column:
    """SimHash: a bit is 1 if it is set in more than half of the shingles' hashes."""
    def bits(hashes):
        ones = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.size(F.filter(hashes, lambda h: F.getbit(h, b) == 1)))
        weighed = F.transform(ones, lambda count, b: F.when(
            count * 2 > F.size(hashes), F.expr("1L")).otherwise(F.expr("0L")))
        low = F.aggregate(F.reverse(weighed), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(x))
        return low

    return bound(F.transform(pieces, lambda s: F.xxhash64(s)), bits)


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the smaller counts over sum of the larger counts, over all shingles of both."""
    def count(side, value):
        return F.size(F.filter(side, lambda s: s == value))

    def similarity(values):
        low = F.aggregate(values, F.lit(0), lambda n, v: n + F.least(count(a, v), count(b, v)))
        return bound(low, lambda shared: shared / (F.size(a) + F.size(b) - shared))

    return bound(F.array_distinct(b), similarity)


def prepared(items: DataFrame) -> DataFrame:
    """(item_id, pieces, n, item_fp) of the items with words; one row per item and text."""
    found = items.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text")).alias("words"))
    found = found.where(F.size("words") > 0).distinct()
    n = F.greatest(F.size("words") - WORDS + 1, F.lit(1))
    found = found.select("item_id", "words", n.alias("n"))
    found = stored(found.select("item_id", "n", shingles(F.col("words"), F.lit(0), F.col("n")).alias("pieces"), shingle_hashes(F.array_join("words", " ")).alias("hashes")))
    return found.withColumn("item_fp", fingerprint(F.col("pieces")))


def hinted(df: DataFrame) -> DataFrame:
    """``df`` (stored), broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def anchors(items: DataFrame, threshold: float) -> DataFrame:
    """(hash, at, n): evenly spaced shingles, one more of each item than a similar window may lack."""
    needed = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    chosen = items.select("n", "hashes", needed.cast("int").alias("needed"))
    chosen = chosen.select("n", "hashes", F.explode(F.expr("transform(sequence(0, needed - 1), k -> k * n div needed)")).alias("at"))
    return chosen.select(F.get("hashes", F.col("at")).alias("hash"), F.col("at").cast("int").alias("at"), "n").distinct()


def block_keys(items: DataFrame, radius: int) -> DataFrame:
    """(item_id, n, item_fp, block, value): every block of an item's fingerprint with all changes that may matter."""
    changes = radius // len(BLOCKS)

    def altered(value: Column, width: int) -> Column:
        masks = [sum(1 << b for b in c) for k in range(changes + 1) for c in combinations(range(width), k)]
        return F.transform(F.array(*map(F.lit, masks)), lambda m: value.bitwiseXOR(m.cast("long")))

    rows = []
    for block, (shift, width) in enumerate(BLOCKS):
        value = F.shiftrightunsigned("item_fp", shift).bitwiseAND((1 << width) - 1)
        rows.append(F.struct(F.lit(block).alias("block"), altered(value, width).alias("values")))
    keys = items.select("item_id", "n", "item_fp", F.explode(F.array(*rows)).alias("b"))
    return keys.select("item_id", "n", "item_fp", F.col("b.block").alias("block"), F.explode("b.values").alias("value"))


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(doc_id, mark, item_id, start, similarity) of windows of ``docs`` that repeat an item.

    ``docs``: doc_id, text, anything else; ``items``: item_id, text. mark is a hash of
    the document's text; start counts words from 0; of all windows of a document on an
    item, the most similar (then first) is returned. Null and wordless texts and items
    match nothing. Items of fewer than five words match only texts of the same words.
    Repeated rows match alike and are returned once.
    """
    items = prepared(items)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    at = keyed.select("doc_id", "mark", F.posexplode(shingle_hashes(F.col("text"))).alias("pos", "hash"))
    found = at.join(hinted(stored(anchors(items, threshold))), "hash")
    # Windows over the edge of a document are moved inside when they are cut out.
    windows = found.groupBy("doc_id", "mark").agg(
        F.collect_set(F.struct(F.greatest(F.col("pos") - F.col("at"), F.lit(0)).alias("first"), "n")).alias("windows")
    )
    cut = keyed.alias("d").join(windows.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.mark") == F.col("w.mark")))
    cut = cut.select("d.doc_id", "d.mark", words_of(F.col("d.text")).alias("words"), "w.windows").distinct()
    cut = cut.select("doc_id", "mark", F.size("words").alias("size"), bound(F.col("words"), lambda words: F.transform(
        F.col("windows"), lambda w: F.struct(
            w["first"].alias("first"), w["n"].alias("n"),
            shingles(words, w["first"], F.least(w["n"], F.greatest(F.size(words) - WORDS + 1, F.lit(1)) - w["first"])).alias("own"),
        ))).alias("cut"))
    cut = cut.select("doc_id", "mark", F.inline("cut")).where(F.size("own") > 0)
    cut = cut.withColumn("fp", fingerprint(F.col("own")))
    values = [F.struct(F.lit(b).alias("block"), F.shiftrightunsigned("fp", s).bitwiseAND((1 << w) - 1).alias("value")) for b, (s, w) in enumerate(BLOCKS)]
    cut = stored(cut)
    probes = cut.select("doc_id", "mark", "first", "n", "fp", F.inline(F.array(*values)))
    keys = hinted(stored(block_keys(items, radius)))
    near = probes.join(keys, ["n", "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    near = near.select("doc_id", "mark", "first", "n", "item_id").distinct()
    pieces = items.select("item_id", "n", "pieces")
    pairs = near.join(pieces, ["item_id", "n"]).alias("p").join(
        cut.alias("c"), F.col("p.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("p.mark") == F.col("c.mark"))
        & (F.col("p.first") == F.col("c.first")) & (F.col("p.n") == F.col("c.n")))
    similarity = weighted_similarity(F.col("own"), F.col("pieces"))
    scored = pairs.select("p.doc_id", "p.mark", "item_id", F.col("p.first").alias("start"), similarity.alias("similarity"))
    scored = scored.where(F.col("similarity") >= threshold - 1e-12)
    best = scored.groupBy("doc_id", "mark", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("start"))).alias("best"))
    return best.select("doc_id", "mark", "item_id", (-F.col("best.start")).alias("start"), F.col("best.similarity").alias("similarity"))


def judged(docs: DataFrame, items: DataFrame, out: str = "items", **options) -> DataFrame:
    """``docs`` with ``out`` (array<long>, ascending): the benchmark items each repeats, empty for clean ones.

    All rows and other columns are kept; a column already named ``out`` is replaced.
    """
    found = matches(docs, items, **options).groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("item_id")).alias("found"))
    kept = [c for c in docs.columns if c != out]
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_mark") == F.col("mark"))
    joined = packed(docs, kept).join(found, same, "left")
    own = [F.col(f"row.`{c}`").alias(c) for c in kept]
    return joined.select(*own, F.coalesce("found", F.array().cast("array<long>")).alias(out))
