"""Repeated passages removed line by line, found through chunks of neighbouring lines.

A chunk is two neighbouring lines with words and the blank ones between them, or
one line of many words, so every place between two lines is a boundary: chunks that a
rolling hash bounds more widely lose passages shorter than the widest of them, and
these are to go, too. A cyclic hash over a chunk's blank lines
and the hashes of its lines make its key. A passage of two lines or more that an
earlier document (or earlier place) holds consists of chunks that it holds too, and
of every such chunk the lines go, after comparing their bytes; lines that repeat in
places of their own make no chunk and stay. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailpulse.llm.common import packed, stored

#: A single repeated line of so many words goes.
PASSAGE_WORDS = 50
#: What words lie between: ASCII white space.
WHITE = " \t\n\v\f\r"


def rotated(value: str, by: str) -> Column:
    """64-bit rotation to the left; ``by`` may be any whole number."""
    left = f"shiftleft({value}, cast(pmod({by}, 64) AS int))"
    right = f"shiftrightunsigned({value}, cast(64 - pmod({by}, 64) AS int))"
    return F.expr(f"CASE WHEN pmod({by}, 64) = 0 THEN {value} ELSE {left} | {right} END")


def marked(docs: DataFrame) -> DataFrame:
    """(_id, _mark, text); rows equal in both id and text count as one document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_mark"), "text")


def chunk_lines(docs: DataFrame) -> DataFrame:
    """(_id, _mark, s, n, key) of every chunk that would go if it repeats.

    Chunks start at line s and have n lines: two lines with words and the blank ones
    between, or one line of many words. Where blank lines stand before or after,
    a chunk is also given with those.
    """
    lines = marked(docs).select("_id", "_mark", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    words = F.length(F.translate(F.regexp_replace("line", f"[^{WHITE}]++", "x"), WHITE, ""))
    lines = lines.select("_id", "_mark", "pos", F.xxhash64("line").alias("h"), words.alias("words"))
    lines = lines.repartition("_id", "_mark").distinct()
    text = Window.partitionBy("_id", "_mark").orderBy("pos")
    wordy = F.when(F.col("words") > 0, F.col("pos"))
    # Every line goes with the blank ones before it; ``at`` is the line with words, null behind the last.
    lines = lines.withColumn("block", F.sum(F.when(F.col("words") > 0, 1).otherwise(0)).over(text) - F.when(F.col("words") > 0, 1).otherwise(0))
    turned = F.when(F.col("words") == 0, rotated("h", "pos")).otherwise(0)
    blocks = lines.withColumn("turned", turned).withColumn("wordy", wordy).groupBy("_id", "_mark", "block").agg(
        F.max("wordy").alias("at"), F.max("words").alias("words"), F.max(F.when(F.col("words") > 0, F.col("h"))).alias("h"),
        F.bit_xor("turned").alias("blanks"), F.count_if(F.col("words") == 0).cast("int").alias("gap"), F.max("pos").alias("last"),
    )
    blocks = blocks.withColumn("blanks", rotated("blanks", "-last - if(at IS NULL, 1, 0)"))
    order = Window.partitionBy("_id", "_mark").orderBy("block")
    after = {"gap_after": F.lead("gap", 1, 0).over(order), "blanks_after": F.lead("blanks", 1, 0).over(order)}
    before = {c: F.lag(d).over(order) for c, d in (("h_before", "h"), ("gap_before", "gap"), ("blanks_before", "blanks"))}
    blocks = blocks.withColumns(after | before).where("at IS NOT NULL")

    def chunks(first: Column, n: Column, key: Column, gap: Column, blanks: Column) -> list[Column]:
        """The chunk alone, with the blank lines before it, with those behind it, and with both."""
        lead, tail = F.when(gap > 0, gap), F.when(F.col("gap_after") > 0, F.col("gap_after"))
        found = []
        for x, y in ((False, False), (True, False), (False, True), (True, True)):
            more = (lead if x else F.lit(0)) + (tail if y else F.lit(0))
            parts = [key, gap if x else F.lit(0), blanks if x else F.lit(0), F.col("gap_after") if y else F.lit(0), F.col("blanks_after") if y else F.lit(0)]
            own = F.struct((first - (gap if x else F.lit(0))).cast("int").alias("s"), (n + more).cast("int").alias("n"), F.xxhash64(*parts).alias("key"))
            found.append(F.when(more.isNotNull(), own))
        return found

    pair = F.xxhash64(F.col("h_before"), F.col("gap"), F.col("blanks"), F.col("h"))
    pairs = chunks(F.col("at") - F.col("gap") - 1, F.col("gap") + 2, pair, F.col("gap_before"), F.col("blanks_before"))
    pairs = [F.when(F.col("h_before").isNotNull(), c) for c in pairs]
    single = [F.when(F.col("words") >= PASSAGE_WORDS, c) for c in chunks(F.col("at"), F.lit(1), F.xxhash64("h"), F.col("gap"), F.col("blanks"))]
    blocks = blocks.select("_id", "_mark", F.explode(F.filter(F.array(*pairs, *single), lambda c: c.isNotNull())).alias("c"))
    return blocks.select("_id", "_mark", "c.s", "c.n", "c.key")


def repeated_segments(chunks: DataFrame) -> DataFrame:
    """(_id, _mark, s, n, of): chunks that occur earlier, at ``of``.

    Earlier is by (null id last, id, hash of the text, line).
    """
    place = F.struct(F.col("_id").isNull().alias("absent"), "_id", "_mark", "s")
    segments = chunks.withColumn("place", place)
    firsts = segments.groupBy("key", "n").agg(F.min("place").alias("of"), F.max("place").alias("last"))
    firsts = firsts.where("of < last").drop("last")
    later = segments.join(firsts, ["key", "n"]).where("place > of")
    return later.select("_id", "_mark", "s", "n", "of")


def compared(docs: DataFrame, segments: DataFrame) -> DataFrame:
    """(_id, _mark, pos): lines of ``segments`` whose bytes equal those of the place they repeat."""
    offset = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("offset")
    pairs = segments.select("_id", "_mark", "s", "of", offset)
    pairs = pairs.select("_id", "_mark", (F.col("s") + F.col("offset")).alias("pos"), F.col("of._id").alias("of_id"),
                         F.col("of._mark").alias("of_mark"), (F.col("of.s") + F.col("offset")).alias("of_pos")).distinct()
    wanted = pairs.select("_id", "_mark", "pos").union(pairs.select("of_id", "of_mark", "of_pos")).distinct()
    wanted = wanted.groupBy("_id", "_mark").agg(F.collect_list("pos").alias("wanted"))
    texts = marked(docs).select(F.col("_id").alias("t_id"), F.col("_mark").alias("t_mark"), F.col("text").alias("_text"))
    # Texts are always dealt by document, so that a job costs the same per byte at every size.
    texts = texts.join(wanted.hint("merge"), F.col("t_id").eqNullSafe(F.col("_id")) & (F.col("t_mark") == F.col("_mark")))
    texts = texts.withColumn("lines", F.split("_text", "\n", -1))
    texts = texts.select("_id", "_mark", "lines", F.explode("wanted").alias("pos"))
    texts = texts.select("_id", "_mark", "pos", F.get("lines", F.col("pos")).alias("line"))
    texts = stored(texts.distinct())
    own = pairs.alias("p").join(texts.alias("t"), _same_line("p", "t", "_id", "_mark", "pos"))
    own = own.select("p.*", "t.line")
    other = texts.select(F.col("_id").alias("o_id"), F.col("_mark").alias("o_mark"), F.col("pos").alias("o_pos"), F.col("line").alias("o_line"))
    same = F.col("of_id").eqNullSafe(F.col("o_id")) & (F.col("of_mark") == F.col("o_mark")) & (F.col("of_pos") == F.col("o_pos"))
    return own.join(other, same).where("line = o_line").select("_id", "_mark", "pos").distinct()


def _same_line(left: str, right: str, *columns: str) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition &= F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return condition


def without_lines(lines: Column, gone: Column) -> Column:
    """The lines left, in one text; ``gone`` has the numbers of the others."""
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.array_join(F.transform(kept, lambda k: F.get(lines, k)), "\n")


def without_repeats(docs: DataFrame, out: str = "n_removed") -> DataFrame:
    """``docs`` (doc_id, text, anything else) with repeated passages taken out of ``text``, and ``out`` (long).

    ``out`` counts the lines taken out. A passage stays where it comes first (ids
    ascending, null ids last). Null texts stay null. Rows equal in id and text are one
    document and change alike. A passage is two or more neighbouring lines with words that
    are neighbours at one earlier place too, with the same blank lines between; blank
    lines around it go if that place has them all. A single repeated line goes only if
    it has at least ``PASSAGE_WORDS`` words. All rows and
    other columns are kept; a column already named ``out`` is replaced. An empty table
    gives an empty one.
    """
    repeated = compared(docs, stored(repeated_segments(stored(chunk_lines(docs)))))
    gone = stored(repeated.groupBy("_id", "_mark").agg(F.collect_list("pos").alias("gone")))
    kept = [c for c in docs.columns if c != out]
    rows = packed(docs, kept)
    joined = rows.join(gone.hint("merge"), F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own_mark") == F.col("_mark")), "left")
    joined = joined.withColumn("lines", F.when(F.col("gone").isNotNull(), F.split("row.text", "\n", -1)))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(without_lines(F.col("lines"), F.col("gone")))
    columns = [text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in kept]
    return joined.select(*columns, F.coalesce(F.array_size("gone"), F.lit(0)).cast("long").alias(out))
