"""Repair of conversation structure by a cost DP and prefix-doubling path ranking.

A conversation's rows, in order, are kept, given another role, or deleted, and
empty turns are inserted, so that role initials read ``(s?(ua)+)?``.  A node
is a place between rows together with what has been given out so far (nothing,
``s``, ``..u``, ``..a``); an arc is one edit.  The DP gives each node the least
cost to the end; arcs that keep to it are optimal.

Of the cheapest repairs the one of ASCII-least audit (edits' initials) counts.
Each node ranks its audit of length one by its least optimal arc and points to
that arc's end (an initial fixes the role, so it leads to one node).  A round
ranks audits of twice the length by the pair of ranks of a node and of the one
it points to, and doubles the pointers, until every path has ended.  The path
is read off through the doubled pointers: its t-th node by the bits of t.

Conversations of any length
---------------------------
Rows are numbered by a range sort and the counts of its pieces, and cut into
blocks of ``BLOCK`` rows.  A block's costs from each of its four states to
each at its end are a min-plus matrix; matrices and, after that, exit states
are combined over the blocks of a conversation in doubling joins.  So one
conversation may hold a third of all rows.  Its text passes one task only to
be hashed for the report, as a sorted stream.

Defined results: rows are ordered by turn (nulls first), then role and text;
rows equal in all of these are one row with a count, whose further ones are
duplicates; a null conversation is a conversation; null roles and texts count
as one space; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histmart.session import materialize, temporary_tables

#: rows of one block of a conversation
BLOCK = 4096
#: costs
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: where a given-out user or assistant turn leads from each state
_TURN = np.array([USER, USER, ASSISTANT, USER])
#: where keeping a row of initial s, u, a, other leads from each state; -1: it may not be kept
_KEEP = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
#: least cost from each state after the last row
_END = np.array([0, 2 * INSERT, INSERT, 0])
_FAR = 1 << 40
_EDITS = np.array(["", "D", "I", "K", "R"])  # in ASCII order
_SPACE = " \t\n\x0b\x0c\r"


def _forced(code: np.ndarray) -> np.ndarray:
    return (code & 4) > 0


def _with_inserts(d: np.ndarray) -> np.ndarray:
    """Costs (.., state, ..) when turns may be inserted first."""
    out = d.copy()
    for s in (USER, ASSISTANT, SYSTEM, NOTHING):
        source = d if s in (USER, ASSISTANT) else out
        out[:, s] = np.minimum(d[:, s], INSERT + source[:, _TURN[s]])
    return out


def _row_costs(code: np.ndarray, s: int, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cost to the end by deleting, keeping, reroling rows from state s."""
    may, late = ~_forced(code), UNFINISHED * ((code & 8) > 0)
    shape = (-1,) + (1,) * (after.ndim - 2)
    to = _KEEP[s][code & 3]
    keep = np.where((may & (to >= 0)).reshape(shape), late.reshape(shape) + after[np.arange(len(code)), to], _FAR)
    rerole = np.where(may.reshape(shape), (late + REROLE).reshape(shape) + after[:, _TURN[s]], _FAR)
    return DELETE + after[:, s], keep, rerole


def costs(code: np.ndarray, length: np.ndarray, exits: np.ndarray) -> np.ndarray:
    """Least cost from every node of every block to the end.  ``exits`` are the
    costs at the blocks' ends, (block, state, ..); rows of the result are the
    places of the blocks, one more than a block has rows."""
    base = np.cumsum(length + 1) - (length + 1)
    row0 = np.cumsum(length) - length
    out = np.empty((int((length + 1).sum()), *exits.shape[1:]), dtype=np.int64)
    out[base + length] = exits
    order = np.argsort(-length, kind="stable")
    sorted_length = length[order]
    for j in range(int(length.max(initial=0))):
        b = order[:np.searchsorted(-sorted_length, -j, side="left")]  # blocks of more than j rows
        at = length[b] - 1 - j
        after, c = out[base[b] + at + 1], code[row0[b] + at]
        out[base[b] + at] = _with_inserts(np.stack([np.minimum.reduce(_row_costs(c, s, after)) for s in range(4)], axis=1))
    return out


def least_paths(code: np.ndarray, length: np.ndarray, exits: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Costs of the nodes, and for each node (place * 4 + state) its edit and
    the doubled pointers along its ASCII-least optimal path."""
    dist = costs(code, length, exits)
    base = np.cumsum(length + 1) - (length + 1)
    place = np.arange(len(dist))
    ends = np.zeros(len(dist), dtype=bool)
    ends[base + length] = True
    rows = np.flatnonzero(~ends)
    to_next = np.minimum(place + 1, len(dist) - 1)
    edit, target = np.zeros((len(dist), 4), dtype=np.int64), np.tile(place[:, None] * 4, 4) + np.arange(4)
    may_insert = ~ends
    may_insert[(base + length)[last]] = True
    for s in range(4):
        delete, keep, rerole = _row_costs(code, s, dist[to_next[rows]])
        kept_to = _KEEP[s][code & 3]
        for e, cost, to in ((4, rerole, np.full(len(rows), _TURN[s])), (3, keep, kept_to), (1, delete, np.full(len(rows), s))):
            if e == 1:  # between the two in the alphabet: inserting
                ok = may_insert & (dist[:, s] == INSERT + dist[:, _TURN[s]])
                edit[ok, s], target[ok, s] = 2, place[ok] * 4 + _TURN[s]
            ok = cost == dist[rows, s]
            edit[rows[ok], s], target[rows[ok], s] = e, to_next[rows[ok]] * 4 + to[ok]
    edit, rank, point = edit.ravel(), edit.ravel(), target.ravel()
    pointers = [point]
    while (edit[point] != 0).any():  # audits of twice the length
        _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[point], return_inverse=True)
        point = point[point]
        pointers.append(point)
    return dist, edit, pointers


def _paths(starts: np.ndarray, edit: np.ndarray, pointers: list[np.ndarray], most: int) -> np.ndarray:
    """The nodes of the paths from ``starts`` (rows), by the bits of the step."""
    out = np.empty((len(starts), most + 1), dtype=np.int64)
    for t in range(most + 1):
        low = t & -t
        out[:, t] = pointers[min(low.bit_length(), len(pointers)) - 1][out[:, t - low]] if t else starts
    return out


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return col.flatten().to_numpy(zero_copy_only=False), np.diff(col.offsets.to_numpy())


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, b, m: least costs from state to state over a block (row by row);
    over the last one to the end, in the first column."""
    for b in batches:
        code, length = _lists(b.column(2))
        last = b.column(4).to_numpy(zero_copy_only=False)
        # at the end nothing is inserted: the next block's first place does that
        exits = np.where(np.eye(4, dtype=bool), 0, _FAR)[None].repeat(b.num_rows, 0)
        exits[last] = _FAR
        exits[last, :, 0] = _END
        m = np.minimum(costs(code, length, exits)[np.cumsum(length + 1) - (length + 1)], _FAR)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(m.reshape(-1, 16)), pa.list_(pa.int64()))], names=["conv", "b", "m"])


def _exit_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, b, f: the state in which the least path from each state leaves the block."""
    for b in batches:
        code, length = _lists(b.column(2))
        exits, _ = _lists(b.column(5))
        _, edit, pointers = least_paths(code, length, exits.reshape(-1, 4), b.column(4).to_numpy(zero_copy_only=False))
        first = (np.cumsum(length + 1) - (length + 1))[:, None] * 4 + np.arange(4)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(pointers[-1][first] % 4), pa.list_(pa.int64()))], names=["conv", "b", "f"])


EDIT_ROWS = "conv string, b long, step long, edit string, times long, i long, role string, cost long"


def _edit_rows(size: int):
    """The edits of every block from its entry state, in order.  Inserted rows
    have no i; role is null for rows that keep theirs and for deleted ones.
    The first edit of a conversation carries the cost of all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, length = _lists(b.column(2))
            extra, _ = _lists(b.column(3))
            last, entry = b.column(4).to_numpy(zero_copy_only=False), b.column(6).to_numpy()
            exits, _ = _lists(b.column(5))
            dist, edit, pointers = least_paths(code, length, exits.reshape(-1, 4), last)
            base, row0 = np.cumsum(length + 1) - (length + 1), np.cumsum(length) - length
            conv, number = b.column(0), b.column(1).to_numpy()
            most = 3 * int(length.max(initial=0)) + 3  # an edit a row, and two inserted turns before each
            for k in range(0, b.num_rows, max(1, (1 << 20) // most)):
                some = np.arange(k, min(b.num_rows, k + max(1, (1 << 20) // most)))
                path = _paths(base[some] * 4 + entry[some], edit, pointers, most)
                e = edit[path]
                of, step = np.nonzero(e)
                node, e = path[of, step], e[of, step]
                block = some[of]
                row = row0[block] + node // 4 - base[block]
                more = np.flatnonzero((e != 2) & (extra[np.minimum(row, len(extra) - 1)] > 0))  # rows with copies, which are deleted
                again = np.sort(np.concatenate([np.arange(len(e)), more]), kind="stable")
                copy = np.zeros(len(again), dtype=bool)
                copy[1:] = again[1:] == again[:-1]
                made = np.where(copy, 1, e[again])
                of = block[again]
                given = np.where(_TURN[node[again] % 4] == USER, "user", "assistant")
                cost = np.where((number[of] == 0) & (step[again] == 0) & ~copy, dist.ravel()[node[again]], 0)
                yield pa.RecordBatch.from_arrays(
                    [conv.take(pa.array(of)), pa.array(number[of]), pa.array(2 * step[again] + copy), pa.array(_EDITS[made]),
                     pa.array(np.where(copy, extra[np.minimum(row[again], len(extra) - 1)], 1)),
                     pa.array(number[of] * size + node[again] // 4 - base[of], pa.int64(), mask=made == 2),
                     pa.array(given, pa.string(), mask=(made == 1) | (made == 3)), pa.array(cost, pa.int64())],
                    names=["conv", "b", "step", "edit", "times", "i", "role", "cost"])
    return run


def _sha_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, sha: hash of the newline-joined lines of a sorted stream."""
    at, sha = None, None
    for b in batches:
        done_conv, done_sha = [], []
        for conv, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if conv != at:
                if sha is not None:
                    done_conv.append(at)
                    done_sha.append(sha.hexdigest())
                at, sha = conv, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(line.encode("utf-8", "surrogatepass"))
        yield pa.RecordBatch.from_arrays([pa.array(done_conv, pa.string()), pa.array(done_sha, pa.string())], names=["conv", "sha"])
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.string()), pa.array([sha.hexdigest()], pa.string())], names=["conv", "sha"])


def _shown(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """(conv_id, turn, role, text, copies): planted faults, by the crc32 of
    "<conv>:<turn>" modulo 20: 0 drops a row, 1 empties its text, 2 takes its
    ``.!?``, 3 repeats it, 4 makes it the user's."""
    fault = F.crc32(F.concat(_shown(conv_col), F.lit(":"), _shown(turn_col)).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(_shown("text"), "[.!?]", "")).otherwise(_shown("text"))
    return conversations.where(fault != 0).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(_shown("role")).alias("role"), text.alias("text"), F.when(fault == 3, 2).otherwise(1).cast("long").alias("copies"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``i``: the place of each row in its conversation, from 0, by a range
    sort and the counts of its pieces (one row for a conversation and piece)."""
    order = ["conv", "turn", "role", "text"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("__piece", F.shiftright("__at", 33)), "turns")
    pieces = placed.groupBy("conv", "__piece").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("conv").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return placed.join(pieces, ["conv", "__piece"]).withColumn("i", F.col("__at") - F.col("__first") + F.col("__off")).drop("__at", "__piece", "__first", "__off")


def _doublings(blocks: DataFrame) -> range:
    return range(math.ceil(math.log2((blocks.agg(F.max("b")).first()[0] or 0) + 1)))


def _costs_after(blocks: DataFrame) -> DataFrame:
    """conv, b, exits: costs from the four states at the end of each block."""
    m = materialize(blocks.mapInArrow(_matrices, "conv string, b long, m array<long>"), "block-costs")
    for k in _doublings(blocks):
        following = m.select("conv", (F.col("b") - (1 << k)).alias("b"), F.col("m").alias("o"))
        cells = [F.least(*[F.element_at("m", 4 * s + u + 1) + F.element_at("o", 4 * u + t + 1) for u in range(4)], F.lit(_FAR)) for s in range(4) for t in range(4)]
        m = materialize(m.join(following, ["conv", "b"], "left").select("conv", "b", F.when(F.col("o").isNull(), F.col("m")).otherwise(F.array(*cells)).alias("m")), "block-costs")
    return m.select("conv", (F.col("b") - 1).alias("b"), F.array(*[F.element_at("m", 4 * s + 1) for s in range(4)]).alias("exits"))


def _entries(blocks: DataFrame) -> DataFrame:
    """conv, b, entry: the state in which the least path enters each block."""
    f = materialize(blocks.mapInArrow(_exit_states, "conv string, b long, f array<long>"), "block-exits")
    for k in _doublings(blocks):
        earlier = f.select("conv", (F.col("b") + (1 << k)).alias("b"), F.col("f").alias("o"))
        through = F.transform("o", lambda s: F.element_at("f", s.cast("int") + 1))
        f = materialize(f.join(earlier, ["conv", "b"], "left").select("conv", "b", F.when(F.col("o").isNull(), F.col("f")).otherwise(through).alias("f")), "block-exits")
    return f.select("conv", (F.col("b") + 1).alias("b"), F.element_at("f", NOTHING + 1).alias("entry"))


def repair(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Edits and a report of conversations (conv_id, turn, role, text, copies).

    Edits, in order of (b, step): conv_id, edit (K keep, R rerole, D delete,
    I insert), times (of a deletion that many copies take), turn, role, text as
    repaired (null where deleted).  Report: a row for each conversation with
    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    with temporary_tables(rows.sparkSession):
        rows = rows.groupBy("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")).agg(F.sum("copies").alias("copies"))
        rows = rows.withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
        rows = _numbered(rows)
        same = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(12), "role", "text").alias("h2")]
        end = F.rtrim("text", F.lit(_SPACE))
        rows = rows.select("*", *same, (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("open"), F.substring("role", 1, 1).alias("initial"))
        first = rows.groupBy("conv", "h1", "h2").agg(F.min("i").alias("first"))
        rows = rows.join(first, ["conv", "h1", "h2"]).withColumn("again", F.col("i") > F.col("first")).drop("h1", "h2", "first")
        rows = materialize(rows, "judged-turns")

        role = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
        forced = F.col("blank") | F.col("again")
        code = role + F.when(forced, 4).when(F.col("open"), 8).otherwise(0)
        listed = F.array_sort(F.collect_list(F.struct("i", code.cast("long").alias("code"), (F.col("copies") - 1).alias("extra"))))  # of a block
        blocks = rows.groupBy("conv", F.floor(F.col("i") / block).alias("b")).agg(listed.alias("x"))
        last = blocks.groupBy("conv").agg(F.max("b").alias("b")).withColumn("last", F.lit(True))
        blocks = materialize(blocks.join(last, ["conv", "b"], "left").select("conv", "b", "x.code", "x.extra", F.coalesce("last", F.lit(False)).alias("last")), "blocks")

        at_end = F.array(*[F.lit(int(x)) for x in _END]).cast("array<long>")
        solved = blocks.join(_costs_after(blocks), ["conv", "b"], "left").withColumn("exits", F.coalesce("exits", at_end))
        solved = materialize(solved, "blocks-with-costs")
        solved = solved.join(_entries(solved), ["conv", "b"], "left").withColumn("entry", F.coalesce("entry", F.lit(NOTHING)).cast("long"))
        edits = materialize(solved.mapInArrow(_edit_rows(block), EDIT_ROWS), "edits")

        texts = rows.select("conv", "i", "turn", F.col("role").alias("was"), "text")
        done = edits.join(texts, ["conv", "i"], "left")
        left = F.col("edit") != "D"
        done = done.select("conv", "b", "step", "edit", "times", "turn", F.when(left, F.coalesce("role", "was")).alias("role"),
                           F.when(left, F.coalesce("text", F.lit(""))).alias("text"))
        names = rows.groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
        done = materialize(done.join(names, "conv"), "repaired-turns", keep=True)
        report = materialize(_report(rows, edits, done, names), "conversation-report", keep=True)
    return done.drop("conv"), report


def _report(rows: DataFrame, edits: DataFrame, done: DataFrame, names: DataFrame) -> DataFrame:
    turns = rows.select("conv", "turn").distinct().groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    following = rows.select("conv", (F.col("i") - 1).alias("i"), F.col("initial").alias("next"))
    pairs = rows.join(following, ["conv", "i"], "left")
    duplicate = F.when(F.col("blank"), 0).when(F.col("again"), F.col("copies")).otherwise(F.col("copies") - 1)
    wrong = F.col("next").isNotNull() & ~F.concat("initial", "next").isin("su", "ua", "au")
    counts = pairs.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"), F.sum(duplicate).alias("duplicate"),
        F.sum((~F.col("blank") & ~F.col("again") & F.col("open")).cast("long")).alias("truncated"),
        F.sum(wrong.cast("long") + F.col("copies") - 1).alias("illegal"), (F.sum(F.col("copies") - 1) * DELETE).alias("extra"))
    pieces = edits.groupBy("conv", "b").agg(F.array_sort(F.collect_list(F.struct("step", "edit", "times"))).alias("x"), F.sum("cost").alias("cost"))  # of a block
    pieces = pieces.select("conv", "b", "cost", F.array_join(F.transform("x", lambda x: F.repeat(x["edit"], x["times"].cast("int"))), "").alias("piece"))
    audits = pieces.groupBy("conv").agg(F.sum("cost").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "piece"))), lambda x: x["piece"]), "").alias("audit"))
    lines = done.where("edit <> 'D'").select("conv", F.concat("role", F.lit(":"), "text").alias("line"), "b", "step")
    shas = lines.repartition("conv").sortWithinPartitions("conv", "b", "step").select("conv", "line").mapInArrow(_sha_stream, "conv string, sha string")
    out = names.join(turns, "conv").join(counts, "conv").join(audits, "conv", "left").join(shas, "conv", "left")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", (F.coalesce("cost", F.lit(0)) + F.col("extra")).cast("long").alias("cost"),
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The report for every conversation of the table, after ``damaged``."""
    _, report = repair(damaged(conversations))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = every.alias("e").join(report.alias("r"), F.col("e.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
    zero = [F.coalesce(f"r.{c}", F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("e.conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def brute_force(rows: list[tuple[int | None, str, str]]) -> tuple[int, int, int, int, int, int, str, str]:
    """The report's values for one conversation of damaged rows (turn, role,
    text), by trying edits from the cheapest and least audit on."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        end = text.strip(_SPACE)[-1:]
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    heap: list[tuple[int, str, int, tuple[tuple[str, str], ...]]] = [(0, "", 0, ())]
    while True:
        cost, audit, i, out = heapq.heappop(heap)
        shape = "".join(r[:1] if r else " " for r, _ in out)
        if not re.fullmatch(r"s?(ua)*u?", shape):
            continue
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", shape):
            break
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + INSERT, audit + "I", i, (*out, (role, ""))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + DELETE, audit + "D", i + 1, out))
            if faults[i] not in ("blank", "duplicate"):
                late = UNFINISHED * (faults[i] == "truncated")
                heapq.heappush(heap, (cost + late, audit + "K", i + 1, (*out, (role, text))))
                for other in ("user", "assistant"):
                    heapq.heappush(heap, (cost + late + REROLE, audit + "R", i + 1, (*out, (other, text))))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode("utf-8", "surrogatepass")).hexdigest()
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha
