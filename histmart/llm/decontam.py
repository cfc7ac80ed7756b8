"""Benchmark decontamination: one Aho-Corasick automaton over the normalised
benchmark windows scans every normalised text once.

Normalising lower-cases A-Z and keeps the words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by one space, so that an
occurrence of " w1 ... wn " in " text words " is a run of whole words.  It is
done on UTF-8 bytes: all bytes from 0x80 belong to words.  Positions in the
normalised text map back to the original through the words' own offsets.

Null and empty texts have no words.  Items without words, and items with a
null id, are left out.  Repeated items count once.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.session import delete_table, materialize, temporary_tables

#: bytes that aren't part of a word become a space; A-Z become a-z
_WORD_BYTE = [48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)]
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if _WORD_BYTE[b] else 32 for b in range(256))
_RUN = re.compile(rb"[^ ]+")
#: UTF-8 bytes of benchmark windows in one automaton; a larger benchmark is scanned for in several rounds
AUTOMATON_BYTES = 32 << 20
#: windows of one Arrow batch
WINDOW_ROWS = 10_000

SCHEMA = ("doc_id long, n_words long, n_hit long, items array<string>, "
          "spans array<struct<start: long, end: long>>")


def normalise(text: str | None) -> bytes:
    """The words of a text, joined by one space."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split())


def item_windows(text: str | None, size: int) -> list[str]:
    """Windows of ``size`` consecutive words; a shorter item is one window."""
    w = normalise(text).split()
    if not w:
        return []
    return sorted({b" ".join(w[i:i + size]).decode("latin-1") for i in range(max(1, len(w) - size + 1))})


def build_automaton(windows: dict[str, tuple[str, ...]]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for text, items in windows.items():
        a.add_word(f" {text} ", (text.count(" ") + 1, items))
    a.make_automaton()
    return a


def _hits(words: list[bytes], auto: ahocorasick.Automaton, runs: list[list[int]], items: set[str]) -> list[list[int]]:
    """Merged runs [first, last] of hit words, the given ones included; adds to items."""
    starts = None
    runs = [list(r) for r in runs]
    for end, (n, its) in auto.iter((b" " + b" ".join(words) + b" ").decode("latin-1")):
        if starts is None:  # position of each word in the normalised text
            starts, at = [], 1
            for w in words:
                starts.append(at)
                at += len(w) + 1
        last = bisect_right(starts, end) - 1  # the match ends at the space after this word
        items.update(its)
        runs.append([last - n + 1, last])
        if len(runs) > 4096:  # long texts full of hits
            runs = _merged(runs)
    return _merged(runs)


def _merged(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _spans(raw: bytes, runs: list[list[int]]) -> list[dict]:
    """Runs of words as code points of the original text."""
    where = [m.span() for m in _RUN.finditer(raw.translate(_NORMAL))] if runs else []
    out, at, points = [], 0, 0
    for a, b in runs:
        edges = []
        for k in (where[a][0], where[b][1]):
            points += len(raw[at:k].decode("utf-8", "surrogatepass"))
            at = k
            edges.append(points)
        out.append({"start": edges[0], "end": edges[1]})
    return out


_INDEX = pa.list_(pa.list_(pa.int64()))
_STEP = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("items", pa.list_(pa.string())), ("runs", _INDEX)])
_LAST = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                   ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
STEP_SCHEMA = "doc_id long, text string, items array<string>, runs array<array<long>>"


def _scanner(windows: dict[str, tuple[str, ...]], last: bool):
    """Adds the hits of one automaton; the last one turns runs into results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = build_automaton(windows) if windows else None
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                raw = (b.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass")
                words = raw.translate(_NORMAL).split()
                items, runs = (set(b.column(2)[i].as_py()), b.column(3)[i].as_py()) if b.num_columns > 2 else (set(), [])
                runs = _hits(words, auto, runs, items) if auto else runs
                ids = sorted(items)
                rows.append((len(words), sum(y - x + 1 for x, y in runs), ids, _spans(raw, runs)) if last else (ids, runs))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            head = [b.column(0).cast(pa.int64())] + ([] if last else [b.column(1)])
            schema = _LAST if last else _STEP
            yield pa.RecordBatch.from_arrays(head + [pa.array(c, schema.field(len(head) + i).type) for i, c in enumerate(cols[:len(schema) - len(head)])], schema=schema)
    return run


def _windower(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0), b.column(1), strict=True):
                found = item_windows(text.as_py(), size)
                for i in range(0, len(found), WINDOW_ROWS):
                    part = found[i:i + WINDOW_ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(part), pa.string()), pa.array(part, pa.string())], names=["item", "win"])
    return run


def _windows(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(win, items): the benchmark's distinct windows."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("item is not null")
    return items.mapInArrow(_windower(size), "item string, win string").groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _window_parts(windows: DataFrame) -> Iterator[dict[str, tuple[str, ...]]]:
    """The windows in parts of about AUTOMATON_BYTES, one at least.

    They stream to the driver one partition at a time, and one part is held
    and sent to the tasks (by Spark, so no task reads a file), so its size is
    bounded whatever the benchmark's is.
    """
    part: dict[str, tuple[str, ...]] = {}
    held, parts = 0, 0
    for win, items in windows.toLocalIterator():
        if held >= AUTOMATON_BYTES:
            yield part
            part, held, parts = {}, 0, parts + 1
        part[win] = tuple(items)
        held += len(win)
    if part or not parts:
        yield part


def decontaminate(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (ids as strings, sorted), spans.

    A document word inside any occurrence of a window of an item is hit;
    ``spans`` are the runs of hit words, in code points of the original text.
    A benchmark above AUTOMATON_BYTES takes a round for each part of it: one
    automaton scans the texts and what it finds is written with them as a
    table, which the next round reads and which is deleted when that is done.
    """
    out = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with temporary_tables(out.sparkSession):
        parts = _window_parts(materialize(_windows(benchmark, item_col, item_text, window), "windows"))
        part, following, step = next(parts), next(parts, None), None
        while following is not None:
            done, step = step, materialize(out.mapInArrow(_scanner(part, False), STEP_SCHEMA), "decontamination")
            if done is not None:
                delete_table(done)
            out, part, following = step, following, next(parts, None)
        out = out.mapInArrow(_scanner(part, True), SCHEMA)
        if step is not None:
            out = materialize(out, "decontaminated", keep=True)
    return out.withColumnRenamed("doc_id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The result columns of the query."""
    return found.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def brute_force(text: str | None, items: dict[str, str | None], size: int = 10) -> tuple[int, int, int, str]:
    """n_words, n_hit, n_items, items_sha256 by comparing every run of words."""
    words = normalise(text).split()
    hit, found = set(), set()
    for item, t in items.items():
        w = normalise(t).split()
        for i in range(max(1, len(w) - size + 1) if w else 0):
            win = w[i:i + size]
            for j in range(len(words) - len(win) + 1):
                if words[j:j + len(win)] == win:
                    hit.update(range(j, j + len(win)))
                    found.add(item)
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
