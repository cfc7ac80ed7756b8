"""Quality classifier: interpolated modified Kneser-Ney n-gram model.

The model is over UTF-8 bytes (order 5, case kept), learned from all trusted
texts.  Counts, continuation counts, context totals and back-off weights are
tables that Spark shards by n-gram; the smoothed probabilities are joins of
them.  For scoring, the distinct n-grams of the corpus are joined once with
the count tables (long order first, then its back-offs).  If they are few
enough, by their count, they are broadcast and the texts stay where they
are; else every batch of documents lists its distinct n-grams and gets the
probabilities of these, so that no task holds the whole table.

A document's perplexity is that of its bytes.  It is rejected when it lies
above its language's limit: a quantile of the perplexities of trusted
documents that the model has not seen (one in ``FOLDS``), times a margin that
covers the scatter of short texts.

Null and empty texts have no perplexity and are rejected.  A language without
``least`` unseen trusted documents, and a null one, takes the limit over all.
Without any trusted text every document with text is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmart.llm import text as T
from histmart.session import materialize, temporary_tables

ORDER = 5
#: byte before a text's first one
START = 2
#: one trusted document in FOLDS is not learned from, and sets the limits
FOLDS = 5
#: bytes of the documents that are scored together
BATCH_BYTES = 48 << 20
#: n-grams (64 MB) and labelled ids (32 MB) that may be broadcast
BROADCAST_NGRAMS = 4_000_000
BROADCAST_LABELS = 4_000_000


def _keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The ORDER bytes up to each byte, packed big-endian into an int64."""
    n, pad = len(data), ORDER - 1
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(n) + pad * (doc + 1)
    padded = np.full(n + pad * (len(offsets) - 1), START, dtype=np.int64)
    padded[at] = data
    key = padded[at]
    for j in range(1, ORDER):
        key |= padded[at - j] << np.int64(8 * j)
    return key


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, _, data, offsets in T.text_chunks(b.column(0)):
            code, key = pd.factorize(_keys(data, offsets))
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(np.bincount(code, minlength=len(key)), pa.int64())], names=["g", "c"])


def _requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (batch, n-gram)."""
    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for lo, hi, data, offsets in T.text_chunks(b.column(1)):
            keys = _keys(data, offsets)
            of = np.repeat(ids[lo:hi], np.diff(offsets))
            for x in np.unique(ids[lo:hi]):
                key = pd.unique(keys[of == x])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), x), pa.int64()), pa.array(key, pa.int64())], names=["batch", "g"])


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, _, data, offsets in T.text_chunks(b.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(pd.unique(_keys(data, offsets)), pa.int64())], names=["g"])


def _sums(col: pa.Array, g: np.ndarray, lp: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Sum of log probabilities and number of bytes of every text; ``g`` is
    sorted and holds all n-grams of the texts."""
    total, length = [np.empty(0)], [np.empty(0, np.int64)]
    for _, _, data, offsets in T.text_chunks(col):
        code, key = pd.factorize(_keys(data, offsets))
        sums = np.zeros(len(data) + 1)
        if len(key):
            np.cumsum(lp[np.searchsorted(g, key)][code], out=sums[1:])
        total.append(sums[offsets[1:]] - sums[offsets[:-1]])
        length.append(np.diff(offsets))
    return pa.array(np.concatenate(total)), pa.array(np.concatenate(length), pa.int64())


def _score(docs: pa.Table, known: pa.Table) -> pa.Table:
    """One batch of documents with its own n-grams."""
    order = np.argsort(known["g"].to_numpy())
    g, lp = known["g"].to_numpy()[order], known["lp"].to_numpy()[order]
    sums = [_sums(c, g, lp) for c in docs["text"].chunks]
    out = docs.drop_columns(["text"])
    for i, name in enumerate(("lp", "n_bytes")):
        out = out.append_column(name, pa.chunked_array([x[i] for x in sums], pa.float64() if i == 0 else pa.int64()))
    return out


def _scorer(known, names: list[str]):
    """Any documents with all n-grams of the corpus, a broadcast (g, lp)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, lp = known.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + list(_sums(b.column("text"), g, lp)), names=[*names, "lp", "n_bytes"])
    return run


def _suffix(g: Column, n: int) -> Column:
    return g.bitwiseAND(F.lit((1 << (8 * n)) - 1))


def _discounts(tables: dict[int, DataFrame]) -> dict[int, tuple[float, float, float]]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more, from
    four numbers for each order."""
    one = [t.select(F.lit(n).alias("n"), *[F.when(F.col("c") == k, 1).otherwise(0).alias(f"n{k}") for k in (1, 2, 3, 4)]) for n, t in tables.items()]
    u = one[0]
    for x in one[1:]:
        u = u.unionAll(x)
    out = {n: (0.5, 1.0, 1.5) for n in tables}
    for r in u.groupBy("n").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in (1, 2, 3, 4)]).collect():
        n1, n2, n3, n4 = (r[f"n{k}"] for k in (1, 2, 3, 4))
        if n1 and n2:
            y = n1 / (n1 + 2 * n2)
            d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
            out[r["n"]] = tuple(min(max(x, 0.1), k - 0.05) for k, x in enumerate(d, 1))
    return out


def kneser_ney(trusted: DataFrame) -> tuple[dict[int, DataFrame], dict[int, DataFrame]]:
    """Tables of log probabilities (g, lp) and of log back-off weights (ctx,
    lw) for orders 1 to ORDER, from a DataFrame with a column ``text``."""
    tables = {ORDER: materialize(trusted.select("text").mapInArrow(_counts, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")), "ngrams")}
    for n in range(ORDER - 1, 0, -1):  # in how many longer n-grams it continues a context
        tables[n] = materialize(tables[n + 1].groupBy(_suffix(F.col("g"), n).alias("g")).agg(F.count("*").alias("c")), "ngrams")
    discount = _discounts(tables)
    probs: dict[int, DataFrame] = {}
    weights: dict[int, DataFrame] = {}
    for n in range(1, ORDER + 1):
        d1, d2, d3 = discount[n]
        off = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        t = tables[n].select("g", "c", off.alias("d"), F.shiftright("g", 8).alias("ctx"))
        ctx = materialize(t.groupBy("ctx").agg(F.sum("c").alias("s"), (F.sum("d") / F.sum("c")).alias("w")), "contexts")
        own = t.join(ctx, "ctx").select("g", ((F.col("c") - F.col("d")) / F.col("s")).alias("own"), "w", _suffix(F.col("g"), n - 1).alias("low"))
        if n == 1:
            p = own.select("g", (F.col("own") + F.col("w") / 256).alias("p"))
        else:
            p = own.join(probs[n - 1].select(F.col("g").alias("low"), F.exp("lp").alias("pl")), "low").select("g", (F.col("own") + F.col("w") * F.col("pl")).alias("p"))
        probs[n] = materialize(p.select("g", F.log("p").alias("lp")), "probabilities")
        weights[n] = ctx.select("ctx", F.log("w").alias("lw"))
    return probs, weights


def lookup(wanted: DataFrame, probs: dict[int, DataFrame], weights: dict[int, DataFrame]) -> DataFrame:
    """(g, lp) for every distinct n-gram g of length ORDER, seen or not: the
    longest known end of it, and the back-off weights of what is cut off."""
    left = wanted.select("g").withColumn("back", F.lit(0.0))
    found = []
    for n in range(ORDER, 0, -1):
        end = _suffix(F.col("g"), n)
        t = left.withColumn("end", end).join(probs[n].withColumnRenamed("g", "end"), "end", "left")
        t = materialize(t.drop("end"), "lookup") if n > 1 else t.drop("end")
        found.append(t.where("lp is not null").select("g", (F.col("back") + F.col("lp")).alias("lp")))
        rest = t.where("lp is null").select("g", "back", F.shiftright(_suffix(F.col("g"), n), 8).alias("ctx"))
        left = rest.join(weights[n], "ctx", "left").select("g", (F.col("back") + F.coalesce("lw", F.lit(0.0))).alias("back"))
    out = left.select("g", (F.col("back") - math.log(256)).alias("lp"))  # a byte never seen
    for f in found:
        out = out.unionAll(f)
    return out


def perplexity(documents: DataFrame, trusted: DataFrame) -> DataFrame:
    """documents (key, text, other columns) without text, with lp (sum of log
    probabilities) and n_bytes.

    The probabilities of the corpus' distinct n-grams are broadcast if they
    are at most BROADCAST_NGRAMS, else every batch of documents is sent those
    of its own n-grams; the result is the same.
    """
    probs, weights = kneser_ney(trusted)
    grams = documents.select("text").mapInArrow(_distinct, "g long").distinct()
    known = materialize(lookup(grams, probs, weights), "known")
    fields = [f for f in documents.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "lp double", "n_bytes long"])
    if known.count() <= BROADCAST_NGRAMS:
        t = known.toArrow()
        g, lp = t["g"].to_numpy(), t["lp"].to_numpy()
        order = np.argsort(g)
        table = documents.sparkSession.sparkContext.broadcast((g[order], lp[order]))
        return documents.mapInArrow(_scorer(table, [f.name for f in fields]), schema)
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    n, total = documents.agg(F.count("*"), F.sum(size)).first()
    per = max(1, int((n or 0) * BATCH_BYTES / max(1, total or 0)))
    # neighbours by key share a batch; an overfull range of keys is cut by a hash of the text
    docs = documents.withColumn("range", F.coalesce(F.floor(F.col("key") / per), F.lit(-1)).cast("long"))
    over = docs.groupBy("range").agg(F.sum(size).alias("b")).where(F.col("b") > 2 * BATCH_BYTES).select("range", F.ceil(F.col("b") / BATCH_BYTES).alias("cuts"))
    docs = docs.join(materialize(over, "overfull"), "range", "left")
    cut = F.when(F.col("cuts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("text", "key"), F.col("cuts")))
    docs = docs.withColumn("batch", F.when(F.col("cuts").isNull(), F.col("range")).otherwise(F.xxhash64("range", cut))).drop("range", "cuts")
    asked = docs.select("batch", "text").mapInArrow(_requests, "batch long, g long").distinct()
    slices = asked.join(known, "g").select("batch", "g", "lp")
    cols = [f.name for f in fields]
    return docs.groupBy("batch").cogroup(slices.groupBy("batch")).applyInArrow(
        lambda d, k: _score(d.select([*cols, "text"]), k), schema)


def classify(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             quantile: float = 0.995, margin: float = 1.05, scatter: float = 4.0, least: int = 20) -> DataFrame:
    """One row per document: id, lang, text_hash, n_bytes, perplexity, threshold, kept.

    Trusted are the documents that ``labels`` (id, quality) rates 1 in every
    row it has of them.  The limit of a language is the ``quantile`` of the
    log perplexities of its unseen trusted documents of 200 bytes or more,
    plus log(margin); a text of n bytes may exceed it by scatter / sqrt(n).
    """
    good = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_l")).agg(F.min("quality").alias("_q")).where("_q = 1").select("_l")
    docs = documents.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
                            F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    # labels are few beside documents: a broadcast, if so, spares the texts a shuffle
    good = F.broadcast(good) if good.count() <= BROADCAST_LABELS else good
    docs = docs.join(good, docs["key"] == good["_l"], "left").withColumn(
        "fold", F.when(F.col("_l").isNull(), -1).otherwise(F.pmod("text_hash", F.lit(FOLDS)).cast("int"))).drop("_l")
    with temporary_tables(docs.sparkSession):
        scored = materialize(perplexity(docs, docs.where("fold > 0")), "perplexity", keep=True)
    nll = -F.col("lp") / F.col("n_bytes")
    scored = scored.withColumn("nll", F.when(F.col("n_bytes") > 0, nll))
    unseen = scored.where("fold = 0 and n_bytes >= 200")
    by_lang = unseen.groupBy("lang").agg(F.count("*").alias("m"), F.percentile_approx("nll", quantile, 10000).alias("q")).where(f"m >= {least} and lang is not null").drop("m")
    any_lang = unseen.agg(F.percentile_approx("nll", quantile, 10000)).first()[0]  # one number
    limit = F.coalesce("q", F.lit(any_lang).cast("double")) + math.log(margin)
    out = scored.join(by_lang, "lang", "left").withColumn("limit", limit)
    ok = F.coalesce(F.col("nll") <= F.col("limit") + scatter / F.sqrt("n_bytes"), F.col("limit").isNull() & F.col("nll").isNotNull())
    return out.select(F.col("key").alias(id_col), "lang", "text_hash", "n_bytes", F.exp("nll").alias("perplexity"), F.exp("limit").alias("threshold"),
                      F.coalesce(ok, F.lit(False)).alias("kept"))
