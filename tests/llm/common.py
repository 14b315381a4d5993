"""Small tables that every operator must take."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns of names that operators use inside, and one with a dot.
CLASHING = ["id", "fp", "tokens", "epoch", "kept", "n_words", "score", "component_id", "a.b", "words", "label", "t", "y", "rep"]


def docs_frame(spark, rows, clash=True):
    """rows: (doc_id, text, source)."""
    df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)
    for c in CLASHING if clash else []:
        df = df.withColumn(c, F.lit("x"))
    return df


EDGE_ROWS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n ", None),
    (4, "one", "b"),
    (4, "one", "b"),
    (5, "word " * 60, "b"),
    (None, "a text without an id " + "and words " * 40, "c"),
    (6, "x" * 50_000, "a"),
    (7, " ".join(f"w{i}" for i in range(20_000)), "a"),
    (8, "Naïve café 日本語 😀 ﬁ \x00 end", "c"),
]
