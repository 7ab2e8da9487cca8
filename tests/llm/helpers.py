"""Small fixtures shared by the tests of the llm operators."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns whose names clash with what the operators use inside or return.
CLASH = ("n", "node", "row", "out", "text_", "score", "spans", "size", "target", "key", "uid", "gone", "bit", "hits")


def docs(spark, rows, clash=False):
    """documents rows (doc_id, text[, lang[, source]]); optionally with clashing columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s1",
             None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if clash:
        from pyspark.sql import functions as F
        for c in CLASH:
            df = df.withColumn(c, F.lit("x"))
    return df


def prose(seed, n, words=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "null id text here"), (5, "same row"), (5, "same row")]
