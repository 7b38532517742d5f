"""Small tables with the awkward rows that every operator has to take."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(n, T.StringType()) for n in ("fp", "size", "root", "position", "node", "word", "score", "copies")),
    ]
)
LONG = "alpha beta gamma delta epsilon " * 60_000


def documents(spark, rows=None):
    """Nulls in each column, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    rows = rows if rows is not None else [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (2, "the quick brown fox jumps over the lazy dog", "en", None, 43),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n ", "en", "b", 4),
        (6, LONG, "en", "c", len(LONG)),
        (7, "Ünïcode wörds \U0001f600 don't stop now <|endoftext|> 12 345", "de", "a", 50),
        (8, "one", "en", "a", 3),
        (9, "one two", "en", "a", 7),
        (None, "no key here at all", "en", "a", 18),
        (None, None, None, None, None),
        (10, "THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG", "en", "a", 43),
    ]
    return spark.createDataFrame([(*r, *["x"] * 8) for r in rows], DOCUMENTS)
