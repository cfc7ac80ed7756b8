"""Hierarchical language ID: family first, then one-versus-one linear SVMs.

A text is the square roots of its hashed byte n-gram frequencies (1 to 4
bytes of the lower-cased letters, other ASCII as one space), a vector of
length 1.  Linear support vector machines for every pair of families vote for
the family; machines for every pair of languages in that family vote for the
language.  Machines learn from a sample of at most ``sample`` texts for each
language (smallest hashes of the id) and are trained in parallel, one pair a
task; prediction reads every whole text.

A text that is null or has no letter is ``und`` with score 0, as is every
text if nothing can be learned.  Null and repeated ids are fine.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histmart.llm import text as T
from histmart.session import materialize, temporary_tables

#: Families of languages by ISO 639-1 code; others are families of their own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nl nn no nb sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu se",
    "celtic": "br cy ga gd",
    "turkic": "az kk ky tr tt ug uz",
    "indic": "bn gu hi mr ne pa sd si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "sinitic": "zh yue",
}
DIMS = 1 << 13
_D = np.uint32(DIMS - 1)
_COEF = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)
_FOLD = np.full(256, 32, dtype=np.uint8)
for _b in range(256):
    if 65 <= _b <= 90:
        _FOLD[_b] = _b + 32
    elif 97 <= _b <= 122 or _b >= 128:
        _FOLD[_b] = _b
_LETTER = np.array([97 <= b <= 122 for b in _FOLD], dtype=bool)
ROWS = 256


def family_of(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), lang)


def _grams(data: np.ndarray) -> list[np.ndarray]:
    """Bucket of the n-gram at each byte, for n = 1, 2, 3, 4."""
    d = data.astype(np.uint32) + np.uint32(1)
    out, acc = [], None
    for n in range(min(4, len(d))):
        part = d[n:] * _COEF[n]
        acc = part if acc is None else (acc[:-1] * np.uint32(31)) + part
        h = (acc ^ (acc >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out.append(((h ^ (h >> np.uint32(13))) & _D).astype(np.int64))
    return out


def features(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, vectors, has a letter) for runs of texts."""
    for lo, hi, raw, offsets in T.text_chunks(col):
        seen = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum(_LETTER[_FOLD[raw]], out=seen[1:])
        letter = seen[offsets[1:]] > seen[offsets[:-1]]
        for i in np.flatnonzero(~letter):  # letters outside ASCII
            body = raw[offsets[i]:offsets[i + 1]]
            if (body >= 128).any():
                letter[i] = any(map(str.isalpha, body.tobytes().decode("utf-8", "replace")))
        folded = _FOLD[raw]
        keep = folded != 32
        keep[1:] |= folded[:-1] != 32
        at = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum(keep, out=at[1:])
        edge = at[offsets]
        grams = _grams(folded[keep])
        for a in range(0, hi - lo, ROWS):
            z = min(a + ROWS, hi - lo)
            x = np.zeros((z - a, DIMS), dtype=np.float32)
            for r in range(a, z):
                if letter[r]:
                    n = np.concatenate([g[edge[r]:max(edge[r], edge[r + 1] - k)] for k, g in enumerate(grams)])
                    x[r - a] = np.bincount(n, minlength=DIMS)
            x /= np.maximum(x.sum(1, keepdims=True), 1)
            yield lo + a, lo + z, np.sqrt(x, out=x), letter[a:z]


def _sample_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, x, letter in features(b.column(1)):
            rows = np.flatnonzero(letter)
            at = [np.flatnonzero(x[r]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0)[lo:hi].take(pa.array(rows)), pa.array([a.tolist() for a in at], pa.list_(pa.int32())),
                 pa.array([x[r][a].tolist() for r, a in zip(rows, at, strict=True)], pa.list_(pa.float32()))], names=["lang", "at", "x"])


def train_svm(x: np.ndarray, y: np.ndarray, rounds: int = 250, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, both classes weighing the same,
    by accelerated gradient descent.  y is +1 or -1."""
    c = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = v = np.zeros(x.shape[1] + 1, dtype=np.float32)
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v[:-1] + v[-1])) * y * c
        grad = ridge * v
        grad[:-1] -= 2 * (slack @ x)
        grad[-1] -= 2 * slack.sum()
        w2 = v - grad / 4
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v = w2 + (t - 1) / t2 * (w2 - w)
        w, t = w2, t2
    return w[:-1], float(w[-1])


def _train(group: pa.Table) -> pa.Table:
    x = np.zeros((group.num_rows, DIMS), dtype=np.float32)
    for r, (at, v) in enumerate(zip(group["at"].to_pylist(), group["x"].to_pylist(), strict=True)):
        x[r, at] = v
    w, b = train_svm(x, group["side"].to_numpy().astype(np.float32))
    return pa.table({"pair": group["pair"].combine_chunks()[:1], "w": pa.array([w.tolist()], pa.list_(pa.float32())), "b": [b]})


def learn(labelled: DataFrame, sample: int = 300) -> dict:
    """The model from (id, text, lang): families, pairs, weights.

    ``sample`` bounds the texts used for each language.  What reaches the
    driver is the list of languages and a weight vector for each pair.
    """
    spark = labelled.sparkSession
    rows = labelled.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("id").alias("h"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(2.0 * sample) / F.col("n"))
    # a row for each language: with it the texts are thinned before they are shuffled
    thin = rows.join(F.broadcast(counts.select("lang", share.alias("share"))), "lang").where(F.pmod("h", F.lit(1 << 20)) < F.ceil(F.col("share") * (1 << 20)) + 64)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 20)), "h"))
    few = thin.withColumn("nth", nth).where(f"nth <= {sample}").select("lang", "text")
    vectors = materialize(few.mapInArrow(_sample_vectors, "lang string, at array<int>, x array<float>"), "lang-sample")
    langs = sorted(r["lang"] for r in vectors.select("lang").distinct().collect())
    families: dict[str, list[str]] = {}
    for x in langs:
        families.setdefault(family_of(x), []).append(x)
    names = sorted(families)
    pairs = [("family", a, b, families[a], families[b]) for a, b in combinations(names, 2)]
    pairs += [("lang", a, b, [a], [b]) for f in names for a, b in combinations(families[f], 2)]
    model = {"families": families, "names": names, "pairs": [p[:3] for p in pairs], "w": np.zeros((DIMS, 0), np.float32), "b": np.zeros(0)}
    if pairs:
        sides = spark.createDataFrame([(i, x, s) for i, p in enumerate(pairs) for s, side in ((1, p[3]), (-1, p[4])) for x in side], "pair int, lang string, side int")
        got = vectors.join(sides, "lang").groupBy("pair").applyInArrow(_train, "pair int, w array<float>, b double").collect()
        got.sort(key=lambda r: r["pair"])
        model["w"] = np.array([r["w"] for r in got], dtype=np.float32).T.copy()
        model["b"] = np.array([r["b"] for r in got])
    return model


def _vote(members: list[str], pairs: dict[tuple[str, str], np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the winner among members, and its confidence, for n texts."""
    if len(members) == 1:
        return np.zeros(n, dtype=np.int64), np.ones(n)
    votes, total = np.zeros((n, len(members))), np.zeros((n, len(members)))
    for i, j in combinations(range(len(members)), 2):
        m = pairs[(members[i], members[j])]
        votes[:, i] += m >= 0
        votes[:, j] += m < 0
        total[:, i] += m
        total[:, j] -= m
    best = np.argmax(votes + 1e-3 * np.tanh(total / len(members)), axis=1)
    return best, 1 / (1 + np.exp(-3 * total[np.arange(n), best] / (len(members) - 1)))


def _predictor(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, families = model["names"], model["families"]
        for b in batches:
            n = b.num_rows
            lang, family = np.full(n, "und", dtype=object), np.full(n, "und", dtype=object)
            score = np.zeros(n)
            for lo, hi, x, letter in features(b.column(1)) if names else ():
                margin = x @ model["w"] + model["b"]
                kinds = {kind: {(a, c): margin[:, i] for i, (k, a, c) in enumerate(model["pairs"]) if k == kind} for kind in ("family", "lang")}
                which, sure = _vote(names, kinds["family"], hi - lo)
                for f, name in enumerate(names):
                    best, own = _vote(families[name], kinds["lang"], hi - lo)
                    rows = np.flatnonzero((which == f) & letter)
                    lang[lo + rows] = np.array(families[name], dtype=object)[best[rows]]
                    family[lo + rows] = name
                    score[lo + rows] = (sure * own)[rows]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(family, pa.string()), pa.array(score)],
                                             names=["id", "lang_pred", "family_pred", "score"])
    return run


def predict(documents: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, family_pred, score) for every document."""
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(_predictor(model), "id long, lang_pred string, family_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str):
    """Whether a document is held out: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 300) -> DataFrame:
    """Learns from the documents that aren't held out, predicts all."""
    labelled = documents.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    with temporary_tables(documents.sparkSession):
        model = learn(labelled, sample)
    return predict(documents, model, id_col, text_col).withColumn("held_out", held_out(id_col))
