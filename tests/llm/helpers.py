"""Small documents tables and brute-force twins for the tests."""

import itertools
import re

from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: null, empty, blank, tiny, tied, repeated, non-ASCII, very long, null metadata
EDGE = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (4, "one", "en", "b", 3), (5, "one", "en", "c", 3), (5, "one", "en", "c", 3),
    (6, "Ünï cödé wörds hère", "de", None, 19), (7, "word " * 30_000, "en", "a", 150_000), (8, "word " * 30_000, None, "b", 150_000), (9, "ONE", "en", "b", 3),
    (None, "no id here but some text", "en", "a", 24), (10, "x" * 100_000, "en", "a", 100_000),
]


def documents(spark, rows, extra=False):
    """A documents table; with ``extra`` also columns whose names clash with
    those of results."""
    df = spark.createDataFrame(rows, DOC)
    if extra:
        from pyspark.sql import functions as F

        for c in ("size", "shard", "slot", "kept", "n", "node", "value", "key", "batch", "copies", "score", "label", "items"):
            df = df.withColumn(c, F.lit("clash"))
    return df


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def classes(n, linked):
    """Smallest number reachable from each of 0..n-1."""
    comp = list(range(n))

    def find(i):
        while comp[i] != i:
            comp[i] = comp[comp[i]]
            i = comp[i]
        return i

    for i, j in itertools.combinations(range(n), 2):
        if linked(i, j):
            a, b = sorted((find(i), find(j)))
            comp[b] = a
    return [find(i) for i in range(n)]
