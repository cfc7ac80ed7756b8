"""Mixing sources to target weights by cube-method balanced sampling.

Every source has a target of words.  The ratio target / size of a source is
the expected number of copies of each of its documents: its whole part is
taken surely, its fractional part is the document's inclusion probability.
The cube method's flight phase moves the probabilities of three documents at
a time along the null space of the two balancing constraints (documents and
words), so that both totals stay exact while one document after the other
becomes 0 or 1.  It runs in buckets of a source, each of which leaves a few
documents undecided: LANDING ones spread over the sizes and the flight's last
two.  These meet in fewer buckets at the next level, until one bucket a source
is left.  Of all choices among what it leaves, the landing takes the one with
the nearest totals.

Null sources are a source of their own (the last one), null and empty texts
have size 0 (taken 0 words), repeated rows are units of their own, and an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histmart.session import materialize, temporary_tables

#: documents of one flight; a bucket of these fits any task
BUCKET_ROWS = 20_000
#: documents that a flight leaves to the landing, besides its last two
LANDING = 12
_EPS = 1e-9


def source_targets(thin: DataFrame, share: float, weights: tuple[float, ...], most: float) -> DataFrame:
    """(source, source_no, source_size, n_docs, target): a row for each source.

    Sources by code point, null last, weigh ``weights`` in turn.  Together
    they get ``share`` of all sizes; what would be above ``most`` times a
    source's size is shared anew by weight among the others.  That is a common
    level L with target = least(most * size, weight * L), found by a running
    sum over the sources in the order in which they reach their limit.  The
    windows hold one row for each source.
    """
    s = thin.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    s = s.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod("source_no", F.lit(len(weights))) + 1).cast("int"))
    s = s.withColumn("weight", w).withColumn("limit", most * F.col("source_size").cast("double"))
    s = s.withColumn("reach", F.col("limit") / F.col("weight"))
    before = Window.orderBy("reach", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(0))
    total = F.sum("source_size").over(every) * F.lit(float(share))
    s = s.withColumn("level", (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
                     / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    first = F.min(F.when(F.col("reach") > F.col("level"), F.struct("reach", "source_no", "level"))).over(every)["level"]
    target = F.when(first.isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), F.col("weight") * first))
    return s.withColumn("target", target).select("source", "source_no", "source_size", "n_docs", "target")


def flight(pi: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> None:
    """Moves pi in place until at most two entries are neither 0 nor 1;
    sum(pi) and sum(pi * x) stay."""
    live: list[int] = []
    p, size = pi.tolist(), x.tolist()
    draws = iter(())
    for k in range(len(p)):
        if not _EPS < p[k] < 1 - _EPS:
            p[k] = float(round(p[k]))
            continue
        live.append(k)
        while len(live) == 3:
            i, j, m = live
            u = (size[m] - size[j], size[i] - size[m], size[j] - size[i])
            if u == (0, 0, 0):
                u = (1.0, -1.0, 0.0)
            up = down = float("inf")
            for a, b in zip(live, u, strict=True):
                if b > 0:
                    up, down = min(up, (1 - p[a]) / b), min(down, p[a] / b)
                elif b < 0:
                    up, down = min(up, p[a] / -b), min(down, (1 - p[a]) / -b)
            r = next(draws, None)
            if r is None:
                draws = iter(rng.random(4096).tolist())
                r = next(draws)
            step = up if r * (up + down) < down else -down
            for a, b in zip(live, u, strict=True):
                p[a] += step * b
            rest = [a for a in live if _EPS < p[a] < 1 - _EPS]
            for a in live:
                if a not in rest:
                    p[a] = float(round(p[a]))
            live = rest
    pi[:] = p


def landing(pi: np.ndarray, x: np.ndarray) -> None:
    """Decides the undecided entries, LANDING + 2 at most, in place: of the
    choices whose number is within two of the probabilities' sum, the one
    whose total of x is nearest to theirs."""
    open_ = np.flatnonzero((pi > 0) & (pi < 1))
    if not len(open_):
        return
    choice = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    words = np.abs(choice @ x[open_] - pi[open_] @ x[open_])
    rows = np.abs(choice.sum(1) - pi[open_].sum())
    words[rows > 2] = np.inf
    pi[open_] = choice[np.lexsort((rows, words))[0]]


def fly(pi: np.ndarray, x: np.ndarray, rng: np.random.Generator, last: bool) -> None:
    """Flight, but for at most LANDING entries, more of the first (the largest)
    than of the last.  These and the two that the flight leaves are the landing
    problem, of the next level or, in the last one, of this."""
    hold = LANDING if last else min(LANDING, len(pi) // 8)
    kept = np.unique(np.geomspace(1, len(pi), hold).astype(int) - 1) if len(pi) > hold else np.arange(len(pi))
    rest = np.setdiff1d(np.arange(len(pi)), kept)
    flown = pi[rest]
    flight(flown, x[rest], rng)
    pi[rest] = flown
    if last:
        landing(pi, x)


def _flyer(level: int, last: bool):
    def run(group: pa.Table) -> pa.Table:
        order = pc.sort_indices(group, [("size", "descending"), ("row_hash", "ascending")])
        g = group.take(order)
        pi = g["pi"].to_numpy().copy()
        x = g["size"].to_numpy().astype(np.float64)
        key = f"{level}:{g['source_no'][0].as_py()}:{g['bucket'][0].as_py()}".encode()
        fly(pi, x, np.random.default_rng(zlib.crc32(key)), last)
        return g.set_column(g.schema.get_field_index("pi"), "pi", pa.array(pi))
    return run


def mix(thin: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3, 1, 2), most: float = 2.0) -> DataFrame:
    """The mix of rows (row_key long, source, size long, other columns).

    Adds source_size, target (of the row's source), copies and taken = copies
    * size.  ``row_key`` need not be unique; rows that are alike in it, in
    size and in source are interchangeable.
    """
    with temporary_tables(thin.sparkSession):
        return materialize(_mix(materialize(thin, "mix-rows"), share, weights, most), "mix", keep=True)


def _mix(thin: DataFrame, share: float, weights: tuple[float, ...], most: float) -> DataFrame:
    sources = materialize(source_targets(thin, share, weights, most), "mix-sources")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    s = sources.withColumnRenamed("source", "of").withColumn("ratio", ratio)
    rows = thin.join(s, thin["source"].eqNullSafe(s["of"])).drop("of")
    sure = F.floor(F.col("ratio") + _EPS)
    rows = (rows.withColumn("sure", sure).withColumn("pi", F.greatest(F.lit(0.0), F.col("ratio") - F.col("sure")))
            .withColumn("pi", F.when(F.col("pi") < _EPS, 0.0).otherwise(F.col("pi")))
            .withColumn("row_hash", F.xxhash64("row_key", "size")).drop("ratio"))
    done = [rows.where("pi = 0 or size = 0").withColumn("pi", F.lit(0.0))]
    open_ = rows.where("pi > 0 and size > 0")
    most_rows = sources.agg(F.max("n_docs")).first()[0] or 0
    left, level = F.col("n_docs"), 0
    while most_rows:
        last = most_rows <= BUCKET_ROWS
        n = F.greatest(F.lit(1), F.ceil(left / BUCKET_ROWS)).cast("long")
        buckets = F.lit(0).cast("long") if last else F.pmod(F.xxhash64("row_hash", F.lit(level)), n)
        dealt = open_.withColumn("bucket", buckets)
        flown = materialize(dealt.groupBy("source_no", "bucket").applyInArrow(_flyer(level, last), dealt.schema).drop("bucket"), "mix-flight")
        done.append(flown.where("pi = 0 or pi = 1"))
        if last:
            break
        open_ = flown.where("pi > 0 and pi < 1")
        left, most_rows, level = (LANDING + 2) * n, (LANDING + 2) * -(-most_rows // BUCKET_ROWS), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = (F.col("sure") + F.col("pi")).cast("long")
    return out.withColumn("copies", copies).withColumn("taken", copies * F.col("size")).drop("sure", "pi", "row_hash", "source_no", "n_docs")


def word_count(text_col: str):
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The documents themselves, each as often as the mix takes it.

    A document of size 0 counts no words; it is left out unless its source
    takes every document at least once.  Rows are told apart by a 128-bit hash
    of all their columns.  Rows that agree in all of them are documents of
    their own to the mix; as they can't be told apart afterwards, one of them
    is given as often as all are taken.  So null and repeated ids, however
    many, are no group of their own.
    """
    columns = [F.col(f"`{c}`") for c in documents.columns]
    keyed = documents.select("*", F.xxhash64(*columns).alias("_k1"), F.xxhash64(F.lit(1), *columns).alias("_k2"))
    thin = keyed.select("_k1", "_k2", F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"))
    thin = thin.groupBy("_k1", "_k2", "source", "size").agg(F.count("*").alias("_n"))
    rows = thin.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).withColumn("row_key", F.xxhash64("_k1", "_k2", "_i")).drop("_i")
    taken = mix(rows, **how).where("copies > 0").groupBy("_k1", "_k2", "_n").agg(F.sum("copies").alias("_copies"))
    single = keyed.join(taken.where("_n = 1"), ["_k1", "_k2"])
    several = keyed.join(taken.where("_n > 1"), ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"])
    return (single.unionByName(several).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*columns))
