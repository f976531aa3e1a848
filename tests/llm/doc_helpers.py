"""Builders of documents tables for the tests of the training-data operators."""

import random

#: Clashing and foreign column names: operators must neither use nor trip over them.
EXTRA = {"key": 1, "n": 2, "bucket": 3, "fp": 4, "digest": 5, "size": 6, "start": 7, "kept": 8, "cls": 9, "_ql_id": 10,
         "words": 11, "source_no": 12, "spans": 13, "html2": 14}

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows, extra=False):
    """(doc_id, text[, source]) rows as a documents table."""
    full = [(i, t, "en", (rest[0] if rest else "s"), len(t or "")) for i, t, *rest in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumns({k: F.lit(v) for k, v in EXTRA.items()})
    return df


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    r = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    a, b = prose(60), prose(80)
    return [(1, a, "x"), (2, a + " ", "x"), (3, a.replace(" ", "\n"), "y"), (None, a, "y"), (4, None, None), (5, "", "x"),
            (6, " \t\n", None), (7, b, "z"), (7, b, "z"), (8, b + " tail", "z"), (9, prose(30_000), "long"), (10, "one two", "é"),
            (11, "One Two", "é"), (None, None, None), (12, "x" * 20_000, "x"), (13, "\U0001f600 é " * 50, "\U0001f600")]
