"""Removal of long repeated passages by recompression.

A text's words are renamed in rounds.  A round gives one name to each run of
an equal symbol, or to each pair of neighbours of which the first is a left
and the second a right symbol; sides are drawn from the name and the round.
A name is a 64-bit hash of what it stands for, so it is the same in every
task and every document: equal passages get equal symbols in their interior,
and only their ends depend on what stands around them.

Why no repeat is lost
---------------------
* For a window of ``size`` words let its interior be the symbols that follow
  from its own words, whatever stands around it.  A run round takes the first
  and the last run from it, a pair round the first symbol if that is a right
  one and the last if that is a left one.  The interior starts as the window
  itself, shrinks, and ends empty; it is the same for every occurrence.
* The window's *anchor* is the longest symbol (ties: by hash) of its last
  interior that isn't empty.  So two occurrences of a window have the same
  anchor at the same place, and a window whose anchor occurs only once in the
  corpus is no repeat.
* Windows at shared anchors are verified: they are counted by the anchor's
  name and a second 64-bit hash of all their words.

How the work is dealt
---------------------
Neighbouring windows have one anchor, so a text gives a row for some six
words.  Rows meet by the anchor's name.  What a task already sees twice is
known to be shared: one row of it goes to the name, the others bypass it, so
a name has at most one row a chunk of texts, however often it occurs.  Copies
of a text in a chunk count once in the same way.  Windows are dealt likewise
by name and hash.  Texts are known by 128 bits of their hash; they are
shuffled once for the anchors, those with a repeat once more.

Defined results: null and empty texts have no words; texts under ``size``
words have no window; equal texts repeat each other; repeated and null ids
are fine, as rows are told apart by nothing but the text.  A chunk of texts
holds a few MB, or one text, whose words take some 200 bytes each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histmart.llm import text as T
from histmart.llm.tables import release
from histmart.session import materialize, temporary_tables

#: rounds that name runs; the others name pairs
RUN_ROUNDS = frozenset({0, 8})
_U = np.uint64
_SIDES, _ORDER, _LEFT, _RIGHT, _RUN = _U(0x9D8A7F3C51E2B64D), _U(0x5851F42D4C957F2D), _U(0xD1342543DE82EF95), _U(0xAF251AF3B0F025B5), _U(0xB492B66FBE98F273)


def _run_round(name: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which symbols start a new one, the new names, and the new interiors."""
    start = np.ones(len(name), dtype=bool)
    start[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    run = np.cumsum(start) - 1
    length = np.bincount(run)
    new = name[start]
    new = np.where(length > 1, T.mix(new * _RUN + length.astype(np.uint64)), new)
    return start, new, run[lo] + 1, run[hi - 1]


def _pair_round(name: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray, t: int) -> tuple[np.ndarray, ...]:
    left = (T.mix(name ^ _U((int(_SIDES) * (2 * t + 1)) & 0xFFFFFFFFFFFFFFFF)) & _U(1)).astype(bool)
    pair = np.zeros(len(name), dtype=bool)
    pair[:-1] = left[:-1] & ~left[1:] & (doc[:-1] == doc[1:])
    start = np.ones(len(name), dtype=bool)
    start[1:] = ~pair[:-1]
    at = np.cumsum(start) - 1
    first = np.flatnonzero(pair)
    new = name.copy()
    new[first] = T.mix(name[first] * _LEFT + name[first + 1] * _RIGHT)
    lo = lo + ~left[lo]
    hi = hi - left[hi - 1]
    some = lo < hi
    return start, new[start], np.where(some, at[np.minimum(lo, len(at) - 1)], 0), np.where(some, at[hi - 1] + 1, 0)


def anchors(h: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name of the anchor, first window, number of windows) of the runs of
    neighbouring windows that have one anchor; ``h`` are word hashes."""
    n = len(h)
    window = np.flatnonzero(doc[:n - size + 1] == doc[size - 1:]) if n >= size else np.empty(0, np.int64)
    out_name, out_at = np.empty(len(window), np.uint64), np.empty(len(window), np.int64)
    name, first, live, lo, hi = h, np.arange(n), np.arange(len(window)), window, window + size
    t = 0
    while len(live):
        step = _run_round(name, doc, lo, hi) if t in RUN_ROUNDS else _pair_round(name, doc, lo, hi, t)
        start, new, new_lo, new_hi = step
        ends = new_lo >= new_hi
        if ends.any():
            a, b, of = lo[ends], hi[ends], live[ends]
            # longest first, then by hash
            order = (np.uint64(255) - np.minimum(np.diff(np.append(first, n)), 255).astype(np.uint64) << _U(56)) | (T.mix(name ^ _ORDER) >> _U(8))
            best = a.copy()
            for k in range(1, int((b - a).max())):
                more = np.flatnonzero(a + k < b)
                less = more[order[a[more] + k] < order[best[more]]]
                best[less] = a[less] + k
            out_name[of], out_at[of] = name[best], first[best]
        live, lo, hi = live[~ends], new_lo[~ends], new_hi[~ends]
        name, first, doc = new, first[start], doc[start]
        t += 1
    new = np.ones(len(window), dtype=bool)
    new[1:] = (out_at[1:] != out_at[:-1]) | (out_name[1:] != out_name[:-1]) | (window[1:] != window[:-1] + 1)
    edge = np.flatnonzero(new)
    return out_name[edge], window[edge], np.diff(np.append(edge, len(window)))


def _firsts(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of a structured or plain key: is it the first with its value, and how many have it."""
    _, at, of, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    first = np.zeros(len(key), dtype=bool)
    first[at] = True
    return first, n[of]


def _keys(b: pa.RecordBatch, lo: int, hi: int) -> np.ndarray:
    """The 128-bit keys of the texts of a chunk."""
    key = np.empty(hi - lo, dtype=[("a", np.int64), ("b", np.int64)])
    key["a"], key["b"] = b.column(0)[lo:hi].to_numpy(), b.column(1)[lo:hi].to_numpy()
    return key


#: ``at`` holds the first window, their number (31 bits), and in its lowest bit
#: whether the name is known to be shared
ANCHORS = "part long, name long, k1 long, k2 long, at long"


def _anchor_rows(size: int):
    """The anchors of every text.  ``part`` is the name for the one row of a
    name that meets those of other chunks, and the text's key for the others,
    which are known to be shared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in T.text_chunks(b.column(2)):
                start, end, doc = T.words(data, offsets)
                name, at, m = anchors(T.word_hashes(data, start, end, lower=False), doc, size)
                keys = _keys(b, lo, hi)
                first_copy, copies = _firsts(keys)
                once, seen = _firsts(name)
                of = doc[at] if len(at) else at
                known = (seen > 1) | (copies[of] > 1)
                keep = first_copy[of]  # of equal texts in the chunk the first one speaks
                # the first row of a name may be a later copy's only if the first copy has one too
                once, of, name, at, m, known = once[keep], of[keep], name[keep], at[keep], m[keep], known[keep]
                p0 = at - np.searchsorted(doc, of)
                name = name.view(np.int64)
                part = np.where(once, name, keys["a"][of])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(name), pa.array(keys["a"][of]), pa.array(keys["b"][of]), pa.array(p0 << 32 | m << 1 | known)],
                    names=["part", "name", "k1", "k2", "at"])
    return run


def _one_copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for equal texts of a batch, with their number."""
    for b in batches:
        first, copies = _firsts(_keys(b, 0, b.num_rows))
        kept = b.filter(pa.array(first))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(copies[first], pa.int64())], names=["k1", "k2", "text", "copies"])


#: ``at`` holds the window and, in its lowest bit, whether it is known to repeat
WINDOWS = "part long, name long, win long, k1 long, k2 long, at long"


def _window_rows(size: int):
    """Every window at a shared anchor, with the hash of its words; dealt like anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in T.text_chunks(b.column(2)):
                start, end, doc = T.words(data, offsets)
                h = T.word_hashes(data, start, end, lower=False)
                listed = b.column(4)[lo:hi]
                n, rows = np.diff(listed.offsets.to_numpy()), listed.flatten()
                at, name = rows.field(0).to_numpy(), rows.field(1).to_numpy()
                p0, m = at >> 32, (at & 0xFFFFFFFF) >> 1
                of = np.repeat(np.arange(hi - lo), n)
                run_of = np.repeat(np.arange(len(m)), m)
                p = p0[run_of] + (np.arange(len(run_of)) - np.repeat(np.cumsum(m) - m, m))
                at = np.searchsorted(doc, of)[run_of] + p
                win = np.zeros(len(at), dtype=np.uint64)
                for j in range(size):
                    win += h[at + j] * T._WORD_COEF[j % 64] * _U(2 * (j // 64) + 1)
                win = T.mix(win).view(np.int64)
                keys, copies = _keys(b, lo, hi), b.column(3)[lo:hi].to_numpy()
                both = np.empty(len(win), dtype=[("a", np.int64), ("b", np.int64)])
                both["a"], both["b"] = name[run_of], win
                once, seen = _firsts(both)
                of = of[run_of]
                known = (seen > 1) | (copies[of] > 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(once, win, keys["a"][of])), pa.array(name[run_of]), pa.array(win), pa.array(keys["a"][of]), pa.array(keys["b"][of]), pa.array(p << 1 | known)],
                    names=["part", "name", "win", "k1", "k2", "at"])
    return run


def _covered(n_words: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Mask of the words that windows with these starts cover."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:-1]) > 0


RESULT = "k1 long, k2 long, n_removed long, kept string, spans array<struct<first: int, end: int>>"


def _applied(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):  # a text at a time
                words = b.column(2)[i].as_py().encode("utf-8", "surrogatepass").split()
                gone = _covered(len(words), np.unique(b.column(3)[i].values.to_numpy()), size)
                turn = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                spans = [{"first": x, "end": y} for x, y in turn.reshape(-1, 2).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[i:i + 1], b.column(1)[i:i + 1], pa.array([int(gone.sum())], pa.int64()), pa.array([kept.decode("utf-8", "surrogatepass")], pa.string()),
                     pa.array([spans], pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))], names=["k1", "k2", "n_removed", "kept", "spans"])
    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words of a text, and the hash of them all."""
    for b in batches:
        n, sha = [], []
        for x in b.column(3).to_pylist():
            words = (x or "").encode("utf-8", "surrogatepass").split()
            n.append(len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(n, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "k1", "k2", "n_words", "whole_sha256"])


def _keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(35), text).alias("k2"), text.alias("text"))


def repeated_spans(documents: DataFrame, size: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text with a repeat: k1, k2 (its key), n_removed, kept
    (its words that stay, joined by one space), spans (runs of removed words
    by number, end exclusive).

    A word is removed if it is in a window of ``size`` words whose word
    sequence starts anywhere else as well.
    """
    docs = _keyed(documents, id_col, text_col).where("text is not null").select("k1", "k2", "text")
    with temporary_tables(docs.sparkSession):
        rows = docs.mapInArrow(_anchor_rows(size), ANCHORS)
        shared = rows.withColumn("n", F.count("*").over(Window.partitionBy("part", "name"))).where("at & 1 = 1 or n > 1")
        shared = shared.select("k1", "k2", (F.col("at") - F.col("at").bitwiseAND(F.lit(1))).alias("at"), "name")
        listed = materialize(shared.groupBy("k1", "k2").agg(F.collect_set(F.struct("at", "name")).alias("anchors")), "anchors")  # of one text
        release(docs.sparkSession)
        texts = docs.mapInArrow(_one_copy, "k1 long, k2 long, text string, copies long").join(listed, ["k1", "k2"])
        texts = materialize(texts, "texts-with-anchors")
        release(docs.sparkSession)
        rows = texts.mapInArrow(_window_rows(size), WINDOWS)
        repeated = rows.withColumn("n", F.count("*").over(Window.partitionBy("part", "name", "win"))).where("at & 1 = 1 or n > 1")
        starts = repeated.groupBy("k1", "k2").agg(F.collect_set(F.shiftright("at", 1).cast("int")).alias("starts"))  # of one text
        starts = materialize(starts, "repeated-windows")
        release(docs.sparkSession)
        found = texts.select("k1", "k2", "text").join(starts, ["k1", "k2"]).mapInArrow(_applied(size), RESULT).dropDuplicates(["k1", "k2"])
        return materialize(found, "repeats", keep=True)


def long_repeats(documents: DataFrame, size: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_removed, spans, kept_sha256 (of the
    words that stay, joined by one space)."""
    found = repeated_spans(documents, size, id_col, text_col).withColumn("sha", F.sha2("kept", 256)).drop("kept")
    thin = _keyed(documents, id_col, text_col).mapInArrow(_whole, "doc_id long, k1 long, k2 long, n_words long, whole_sha256 string")
    out = thin.join(found, ["k1", "k2"], "left")
    return out.select(F.col("doc_id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                      "spans", F.coalesce("sha", "whole_sha256").alias("kept_sha256"))


def without_repeats(documents: DataFrame, size: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with the words that stay as the text of those with a repeat."""
    found = repeated_spans(documents, size, id_col, text_col).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("kept").alias("__kept"))
    text = F.col(text_col).cast("string")
    on = (F.xxhash64(text) == F.col("__k1")) & (F.xxhash64(F.lit(35), text) == F.col("__k2"))
    out = documents.join(found, on, "left")
    return out.withColumn(text_col, F.coalesce("__kept", text)).drop("__k1", "__k2", "__kept")


def brute_force(texts: list[str | None], size: int = 35) -> list[tuple[int, int, str]]:
    """n_words, n_removed, kept_sha256 of every text."""
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    count: dict[tuple[bytes, ...], int] = {}
    for w in words:
        for i in range(len(w) - size + 1):
            count[tuple(w[i:i + size])] = count.get(tuple(w[i:i + size]), 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if count[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return out
