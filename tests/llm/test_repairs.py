"""Spelling variants, long repeats and conversation repair."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from histmart.llm import convrepair, recompress, spelling
from tests.llm.helpers import EDGE, documents


def _variants(spark, counts):
    found = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found.collect()}


@pytest.mark.parametrize("letters", ["ab", "abcdefé"])
def test_variants_equal_brute_force(spark, letters):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(5, 9))) for _ in range(300)}
    for w in sorted(words)[:100]:
        i = rng.randrange(len(w) + 1)
        words.add(rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:]]))
    counts = {w: rng.randrange(3, 40) for w in words if len(w) >= 5}
    assert _variants(spark, counts) == spelling.brute_force(counts)


def test_variants_chains_ties_and_none(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "zzzzz": 3, "yzzzz": 6, "xzzzz": 6, "alone": 9, "aaaaaaaaaaaaaaaaaaaa": 4, "aaaaaaaaaaaaaaaaaaaaa": 8}
    got = _variants(spark, counts)
    assert got == spelling.brute_force(counts)
    assert got["aaaaa"] == ("aaaab", "aabbb", 3, 1, 6) and got["zzzzz"][0] == "xzzzz" and got["alone"] == (None, "alone", 9, 0, None)
    assert _variants(spark, {"aaaaa": 3}) == {"aaaaa": (None, "aaaaa", 3, 0, None)}
    assert spelling.group_variants(spark.createDataFrame([], "word string, n long")).collect() == []


def test_words_are_counted_over_whole_texts(spark):
    rows = EDGE + [(20, "Straße ÜBER Über éclair " * 3, None, None, 0), (20, "Straße ÜBER Über éclair " * 3, None, None, 0)]
    got = {r["word"]: r["n"] for r in spelling.count_words(documents(spark, rows, extra=True), every=3, least=2, often=1).collect()}
    want = Counter()
    for doc_id, text, *_ in rows:
        for w in spelling.runs(text):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            want[w[:h % len(w)] + w[h % len(w) + 1:] if h % 3 == 0 else w] += 1
    assert got == {w: n for w, n in want.items() if len(w) >= 2}
    assert spelling.runs("A-z×÷_é1ÿĀ") == ["a", "z×÷", "é", "ÿ"]
    assert spelling.count_words(documents(spark, [])).collect() == []


def _repeats(spark, texts, size, parts=5):
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in recompress.long_repeats(documents(spark, rows).repartition(parts), size).collect()}
    return [(got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) for i in range(len(texts))]


@pytest.mark.parametrize("size,vocabulary", [(5, 6), (8, 3), (35, 40)])
def test_repeats_equal_brute_force(spark, size, vocabulary):
    rng = random.Random(size)
    draw = lambda n: [f"W{rng.randrange(vocabulary)}" for _ in range(n)]
    passages = [draw(size + d) for d in (-1, 0, 1, 20)]
    texts = []
    for _ in range(40):
        w = []
        for _ in range(rng.randrange(4)):
            w += draw(rng.randrange(size)) + rng.choice(passages)
        texts.append(rng.choice([" ", "\n", " \t"]).join(w + draw(rng.randrange(2 * size))))
    texts += texts[:3] + [" ".join(["a"] * n) for n in (size - 1, size, size, size + 1, 4 * size)]
    texts += [" ".join(["a", "b"] * 3 * size), " ".join(draw(3) * 2 * size), None, "", " \n", "Word " * size, "word " * size]
    assert _repeats(spark, texts, size) == recompress.brute_force(texts, size)


def test_anchor_follows_from_the_window(spark):
    """The same window has the same anchor, whatever stands around it."""
    rng = np.random.default_rng(3)
    for letters in (2, 50):
        inner = rng.integers(0, letters, 35).astype(np.uint64)
        seen = set()
        for _ in range(200):
            before, after = (rng.integers(0, letters, rng.integers(0, 40)).astype(np.uint64) for _ in range(2))
            h = np.concatenate([before, inner, after])
            name, at, m = recompress.anchors(h, np.zeros(len(h), np.int64), 35)
            k = np.searchsorted(at, len(before), side="right") - 1
            assert at[k] <= len(before) < at[k] + m[k]
            seen.add(int(name[k]))
        assert len(seen) == 1


def test_repeats_edges_and_texts(spark):
    got = recompress.long_repeats(documents(spark, EDGE, extra=True), 35).collect()
    want = recompress.brute_force([r[1] for r in EDGE], 35)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == sorted(
        (r[0] is None, r[0] or 0, *w) for r, w in zip(EDGE, want, strict=True))
    assert recompress.long_repeats(documents(spark, [])).collect() == []
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(1, f"first {passage} one", "en", "a", 0), (2, f"{passage} two", "en", "a", 0), (3, "stays as it\nis", "en", "a", 0)]
    out = {r["doc_id"]: r for r in recompress.without_repeats(documents(spark, rows, extra=True), 35).collect()}
    assert [out[i]["text"] for i in (1, 2, 3)] == ["first one", "two", "stays as it\nis"] and out[1]["kept"] == "clash"
    spans = {r["doc_id"]: r["spans"] for r in recompress.long_repeats(documents(spark, rows), 35).collect()}
    assert [tuple(x) for x in spans[1]] == [(1, 51)] and spans[3] is None


ROWS = "conv_id long, turn long, role string, text string, copies long"


def _conversations(rng, n, most):
    rows = []
    for c in range(n):
        for _ in range(rng.randrange(1, most + 1)):
            turn = rng.choice([None, *range(12)])
            rows.append((None if c == 0 else c, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "ux"]),
                         rng.choice(["Yes.", "No!", "So", "", " \n", "Why? ", f"T{turn}.", f"t{turn}"]), rng.choice([1, 1, 1, 2])))
    return rows


@pytest.mark.parametrize("block,n,most", [(4096, 60, 6), (2, 40, 6), (3, 12, 7)])
def test_repair_equals_brute_force(spark, block, n, most):
    rows = _conversations(random.Random(block), n, most)
    _, report = convrepair.repair(spark.createDataFrame(rows, ROWS), block)
    got = {r[0]: tuple(r)[1:] for r in report.collect()}
    want = {}
    for c in {r[0] for r in rows}:
        want[c] = convrepair.brute_force([r[1:4] for r in rows if r[0] == c for _ in range(r[4])])
    assert got == want


def test_repair_edits_spell_the_audit(spark):
    rows = [(1, 0, "assistant", "Hi.", 1), (1, 1, "user", "So", 3), (1, 2, "user", "", 1), (1, 3, "system", "Stop.", 1)]
    edits, report = convrepair.repair(spark.createDataFrame(rows, ROWS))
    edits = sorted(edits.collect(), key=lambda r: (r["b"], r["step"]))
    line = report.first()
    assert "".join(r["edit"] * r["times"] for r in edits) == line["audit"]
    left = [(r["role"], r["text"]) for r in edits if r["edit"] != "D"]
    assert [r for r, _ in left] == ["user", "assistant"] * (len(left) // 2)
    assert line["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()


def _damage(conv, turn, role, text):
    shown = lambda x: " " if x is None else str(x)
    k = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
    row = (turn, "user" if k == 4 else shown(role), "" if k == 1 else "".join(c for c in shown(text) if k != 2 or c not in ".!?"))
    return [] if k == 0 else [row, row] if k == 3 else [row]


def test_damaged_conversations(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"Text {c} {t}" + rng.choice(["", "."])) for c in range(60) for t in range(rng.randrange(1, 6))]
    rows += [(c, 0, "user", "Alone.") for c in range(100, 140)]
    rows += [(None, None, None, None), (None, 1, "user", None), (None, 2, None, "x."), (None, 3, "user", "word " * 40_000 + "."), (7, None, "user", "Who?"), (7, 1, "user", "Text.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS cost", "'x' AS audit", "'y' AS conv", "0 AS i")
    got = {r["conv_id"]: tuple(r)[1:] for r in convrepair.repair_damaged(table).collect()}
    want = {c: convrepair.brute_force([d for r in rows if r[0] == c for d in _damage(*r)]) for c in {r[0] for r in rows}}
    assert got == want and any(w[6] == "" for w in want.values())
    assert convrepair.repair_damaged(table.where("false")).collect() == []
