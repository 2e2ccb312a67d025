"""Small tables with the awkward cases that every operator must take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, odd characters."""
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. " * 3, "en", "a", 0),
        (2, "the QUICK brown fox jumps over the lazy dog. " * 3, "en", "a", 0),
        (3, None, None, None, None),
        (4, "", "en", "a", 0),
        (5, "   \n\t ", "en", "a", 0),
        (6, "one", "en", "a", 0),
        (7, "long " * 30000 + "end", "en", "a", 0),
        (8, "é😀 ünï\x01cödé \x02 token = abcdef123456 mail a.b@c-d.org 10.0.0.1", "fr", "b", 0),
        (9, "before words " + passage + " after words", "en", "b", 0),
        (10, "other start " + passage + " other end", "en", "b", 0),
        (10, "other start " + passage + " other end", "en", "b", 0),
        (11, "x" * 20000, "en", "b", 0),
        (None, "a row without an id " + passage, "en", "b", 0),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(spark):
    """Columns with the names that operators use inside."""
    from pyspark.sql import functions as F

    out = awkward(spark)
    for name in ("id", "t", "k", "n", "fp", "node", "root", "a", "b", "kind", "found", "bin", "x"):
        out = out.withColumn(name, F.lit("clash"))
    return out
