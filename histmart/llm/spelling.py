"""Grouping of spelling variants by pivotal grams (one edit).

Words are maximal runs of Latin letters.  In one global order of bigrams,
rarest first, a word's *prefix* is its three rarest bigram occurrences, with
all ties of the third.  Its two *pivots* are the disjoint bigrams of that
prefix that the fewest words hold, chosen by dynamic programming over
positions.

Why no near word is lost
------------------------
* One edit destroys one of two disjoint pivots at most.  Of two near words
  let r be the one whose prefix ends first in the global order.  A pivot of r
  that survives comes no later than that end, so it is in the other word's
  prefix.  So the pivots of each word are looked up among the prefixes of the
  words whose prefix doesn't end before its own.
* A surviving pivot tells on which side of it the edit lies: the word is
  unchanged from its start up to the pivot, or from the pivot to its end.  The
  lookup key is that side with its position.  A side of under ``SIDE``
  letters is short and would make long lists, so it is drawn out: either the
  edit comes after the first ``SIDE`` letters, which are then the key, or it
  lies within them, and the key is the side and what follows these letters at
  the other word's length.
* Every candidate is verified by its edit distance, so neither a missing rule
  nor a chance meeting of keys changes the result.

Defined results: null and empty texts have no words; a null id counts as an
empty one in the hash that thins letters out; repeated rows count as often as
they stand there; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.session import materialize, temporary_tables

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: distinct words that a task counts before it gives them on
HELD_WORDS = 200_000
#: letters of a lookup key on the side that has no edit, at least
SIDE = 6
#: bigrams of a word's prefix (one edit destroys two at most)
PREFIX = 3


def runs(text: str | None) -> list[str]:
    """Maximal runs of letters, A-Z lower-cased."""
    return _RUN.findall((text or "").translate(_LOWER))


def thinned(doc_id: object, run: str, every: int) -> str:
    """The run, without one of its letters if ``every`` divides its hash."""
    if not every:
        return run
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode("utf-8", "surrogatepass"))
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counts(every: int, least: int):
    def out(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for w, n in Counter(runs(text)).items():
                    w = thinned(doc_id, w, every)
                    if len(w) >= least:
                        total[w] += n
                if len(total) >= HELD_WORDS:
                    yield out(total)
                    total = Counter()
        yield out(total)
    return run


def count_words(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 0, least: int = 5, often: int = 3) -> DataFrame:
    """(word, n): words of at least ``least`` letters that occur ``often`` times or more.

    With ``every``, a run of a document loses one letter where ``every``
    divides crc32 of "<id>:<run>" (which plants misspellings).
    """
    texts = documents.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    counted = texts.mapInArrow(_counts(every, least), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def prefix_and_pivots(word: str, held_by: dict[str, int]) -> tuple[list[int], list[int], tuple[int, str]]:
    """Positions of the prefix' bigrams and of the pivots, and the bigram, as
    (words that hold it, bigram), with which the prefix ends."""
    grams = sorted((held_by[word[i:i + 2]], word[i:i + 2], i) for i in range(len(word) - 1))
    last = grams[min(PREFIX, len(grams)) - 1][:2]
    at = sorted((i, n) for n, g, i in grams if (n, g) <= last)
    # cheapest choice of one and of two disjoint bigrams among those up to here
    one: list[tuple[int, tuple[int, ...]]] = []
    two = (math.inf, ())
    for k, (i, n) in enumerate(at):
        before = [one[j] for j in range(k) if at[j][0] + 2 <= i]
        if before:
            two = min(two, (before[-1][0] + n, before[-1][1] + (i,)))
        one.append(min(one[-1], (n, (i,))) if one else (n, (i,)))
    return [i for i, _ in at], list(two[1]), last


def lookup_keys(word: str, at: list[int], pivots: bool) -> list[str]:
    """Keys under which a word is listed (by its prefix), or looked up (by its
    pivots, for the other word being one shorter, as long, or one longer)."""
    size = len(word)
    found = set()
    for mirrored in (False, True):
        w = word[::-1] if mirrored else word
        side = "<" if mirrored else ">"
        for i in at:
            whole = (size - i) if mirrored else i + 2  # letters up to the pivot's end
            if whole >= SIDE:
                found.add(f"{side}{w[:whole]}")
                continue
            if size >= SIDE:
                found.add(f"{side}{w[:SIDE]}")
            # an edit within the first SIDE letters: what follows them in the other word starts d later here
            for d in (-1, 0, 1) if pivots else (0,):
                found.add(f"{side}{w[:whole]}:{size + d}:{w[SIDE - d:]}")
    return sorted(found)


def _keyed(held_by: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, words, pivot, ends = [], [], [], []
            for w in b.column(0).to_pylist():
                prefix, pivots, (n, g) = prefix_and_pivots(w, held_by)
                for of, at in ((False, prefix), (True, pivots)):
                    for k in lookup_keys(w, at, of):
                        keys.append(k)
                        words.append(w)
                        pivot.append(of)
                        ends.append(f"{n:012d}{g}")
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(words, pa.string()), pa.array(pivot, pa.bool_()), pa.array(ends, pa.string())],
                                             names=["key", "word", "pivot", "ends"])
    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), both ways: words that differ by exactly one inserted, deleted
    or replaced letter.  ``words`` has distinct ``word`` of five letters or more."""
    grams = words.select(F.explode(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))")).alias("g"), "word").distinct()
    held_by = {r["g"]: r["n"] for r in grams.groupBy("g").agg(F.count("*").alias("n")).collect()}  # 90 letters: 8100 bigrams at most
    keyed = materialize(words.select("word").mapInArrow(_keyed(held_by), "key string, word string, pivot boolean, ends string"), "spelling-keys")
    a = keyed.where("pivot").select("key", F.col("word").alias("a"), F.col("ends").alias("ea"))
    b = keyed.where("not pivot").select("key", F.col("word").alias("b"), F.col("ends").alias("eb"))
    met = a.join(b, "key").where("a <> b and ea <= eb and abs(length(a) - length(b)) <= 1")
    near = met.where(F.levenshtein("a", "b", 1) == 1).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = materialize(near, "near-words")
    return near.unionAll(near.select(F.col("b").alias("a"), F.col("a").alias("b")))


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of (word, n).

    ``form`` is the near word of largest n (ties: least in code-point order)
    if it has ``ratio`` times the word's n or more; ``root`` follows forms to
    the last.  n grows by the ratio with each form, so a chain is as short as
    the logarithm of the largest n and is followed in doubled steps.
    """
    if ratio < 2:
        raise ValueError("a form has at least twice the count of its word")
    with temporary_tables(words.sparkSession):
        words = materialize(words.select("word", "n"), "words")
        pairs = near_pairs(words)
        counted = pairs.join(words.select(F.col("word").alias("b"), F.col("n").alias("nb")), "b")
        best = counted.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("m"), F.col("b").alias("b"))).alias("best"))
        found = words.join(best.withColumnRenamed("a", "word"), "word", "left")
        is_form = -F.col("best.m") >= ratio * F.col("n")
        found = materialize(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                         F.when(is_form, F.col("best.b")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")), "forms")
        steps = found.where("form is not null").select("word", F.col("form").alias("root"))
        largest = words.agg(F.max("n")).first()[0] or 1
        for _ in range(max(1, math.ceil(math.log2(math.log(largest, ratio) + 1)))):
            on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
            steps = materialize(steps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        out = found.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))
        return materialize(out.select("word", "form", "root", "n", "n_near", "form_n"), "variants", keep=True)


def brute_force(counts: dict[str, int], ratio: int = 2) -> dict[str, tuple[str | None, str, int, int, int | None]]:
    """word -> (form, root, n, n_near, form_n), by comparing every two words."""
    def near(a: str, b: str) -> bool:
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out = {}
    for w, n in counts.items():
        of = [x for x in counts if near(w, x)]
        form = min(of, key=lambda x: (-counts[x], x), default=None)
        form = form if form is not None and counts[form] >= ratio * n else None
        out[w] = [form, None, n, len(of), counts[form] if form else None]
    for w, row in out.items():
        at = w
        while out[at][0]:
            at = out[at][0]
        row[1] = at
    return {w: tuple(row) for w, row in out.items()}
