"""Tables with the rows that break jobs: nulls, empty, very long, repeated, with clashing extra columns."""

EXTRA = ["fp", "mark", "root", "score", "spans", "ids", "keep", "items", "n_removed", "data", "chunk", "word", "held_out",
         "node", "size", "pos", "line", "_id", "_mark", "hash", "words", "first", "class"]
SENTENCE = "The quick brown fox jumps over the lazy dog near the river bank today"


def odd_texts():
    return [
        (1, SENTENCE), (2, SENTENCE), (2, SENTENCE), (3, None), (4, ""), (5, "   \n\t "), (6, "x"), (None, SENTENCE + " again"),
        (None, None), (7, "word " * 30_000), (8, "a" * 70_000), (9, "naïve café 東京 𝒳 \x00 <s> <|endoftext|>"), (10, "\n\n\n"),
        (11, SENTENCE.upper()), (12, "lines\nmore lines\n" * 200),
    ]


def frame(spark, rows, extra=True, schema="doc_id long, text string"):
    """``rows`` as a table; with ``extra`` columns named like those that operators make."""
    df = spark.createDataFrame(rows, schema)
    if extra:
        from pyspark.sql import functions as F

        taken = set(df.columns)
        df = df.withColumns({c: F.lit(f"own {c}") for c in EXTRA if c not in taken})
    return df
