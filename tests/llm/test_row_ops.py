"""Mixing, sharding, PII, tool calls, embeddings and the pipeline."""

import collections
import hashlib
import json
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from histmart.llm import kdshard, mixing, pii, toolcalls, vectors
from tests.llm.helpers import EDGE, classes, documents, words


def _targets(sizes, share=1.5, weights=(3, 1, 2), most=2.0):
    """Targets by sharing the excess again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in capped]
        if not rest:
            return capped
        left, ws = total - sum(capped.values()), sum(w[s] for s in rest)
        over = [s for s in rest if left * w[s] / ws >= most * sizes[s]]
        if not over:
            return capped | {s: left * w[s] / ws for s in rest}
        capped |= {s: most * sizes[s] for s in over}


def _mix(spark, rows):
    thin = documents(spark, rows).select(F.col("doc_id").alias("row_key"), "source", mixing.word_count("text").alias("size"))
    return mixing.mix(thin).collect()


@pytest.mark.parametrize("bucket", [20_000, 40])
def test_mix_reaches_targets(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rng = random.Random(1)
    rows = [(i, "w " * int(rng.paretovariate(1.2) * 5), "en", rng.choice(["a", "a", "a", "b", "ü", "Z", None, "c"]), 0) for i in range(600)]
    got = _mix(spark, rows)
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    want = _targets(size)
    taken = collections.Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == size[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert len(got) == 600
    for s in size:  # tiny buckets decide nearly all but the large documents before the landing
        largest = max(len(words(r[1])) for r in rows if r[3] == s)
        assert abs(taken[s] - want[s]) <= 0.01 * want[s] + (5 if bucket > 600 else largest / 2)
    assert sorted(map(str, _mix(spark, list(reversed(rows))))) == sorted(map(str, got))


def test_flight_keeps_the_totals():
    rng = np.random.default_rng(2)
    pi, x = rng.random(500), rng.integers(1, 1000, 500).astype(float)
    before = pi.sum(), pi @ x
    mixing.flight(pi, x, rng)
    assert ((pi > 0) & (pi < 1)).sum() <= 2 and pi.sum() == pytest.approx(before[0]) and pi @ x == pytest.approx(before[1])
    hits = np.zeros(6)
    for k in range(4000):  # the inclusion probabilities hold
        p = np.array([0.3, 0.3, 0.3, 0.7, 0.7, 0.7])
        mixing.flight(p, np.array([5.0, 1, 7, 3, 3, 9]), np.random.default_rng(k))
        hits += p
    assert np.abs(hits / 4000 - [0.3, 0.3, 0.3, 0.7, 0.7, 0.7]).max() < 0.04


def test_mix_edges(spark):
    got = _mix(spark, EDGE)
    assert len(got) == len(EDGE) and all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert _mix(spark, []) == [] and all(r["target"] == 0 for r in _mix(spark, EDGE[:3]))
    docs = documents(spark, EDGE, extra=True)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    times = collections.Counter(r["text"] for r in out.select("text").collect())
    assert times["one"] <= 6 and times["word " * 30_000] >= 1


def _shards(spark, rows, n=8, extra=False):
    return kdshard.kd_shards(documents(spark, rows, extra=extra), n)


def test_shards_hold_near_equal_bytes(spark):
    rng = random.Random(3)
    rows = [(i, "é" * rng.randrange(1, 400) + str(i), rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "a", "b", None]), 0) for i in range(1500)]
    rows += [(2000 + i, "copy " * 20, "en", rng.choice("ab"), 0) for i in range(30)]
    for n in (8, 5, 1):
        got = _shards(spark, rows, n).collect()
        size, slots, copies = collections.Counter(), collections.defaultdict(list), set()
        for r in got:
            assert r["size"] == len(r["text"].encode()) + 1
            size[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
            if r["doc_id"] >= 2000:
                copies.add(r["shard"])
        assert len(got) == len(rows) and sorted(size) == list(range(n)) and len(copies) == 1
        assert max(size.values()) <= 1.05 * min(size.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_the_median_is_that_of_the_widest_dimension(spark):
    """With two shards, one split: all of one side lie below the other."""
    rows = [(i, "x" * (3 ** (i % 9)) + "y" * i, "en", "a", 0) for i in range(300)]
    got = _shards(spark, rows, 2).collect()
    low, high = ([len(r["text"]) for r in got if r["shard"] == s] for s in (0, 1))
    assert math.log(max(low)) <= math.log(min(high)) + 1e-3


def test_a_hot_text_is_parted(spark):
    rows = [(i, "same text" if i % 3 else f"text number {i}", "en", "a", 0) for i in range(1200)]
    size = collections.Counter()
    for r in _shards(spark, rows).collect():
        size[r["shard"]] += r["size"]
    assert len(size) == 8 and max(size.values()) <= 1.15 * min(size.values())


def test_shard_edges(spark):
    got = _shards(spark, EDGE, 3, extra=True).collect()
    assert len(got) == len(EDGE) and {r["size"] for r in got if not r["text"]} == {1}
    assert _shards(spark, []).collect() == []
    one = _shards(spark, EDGE[:1]).collect()
    assert len(one) == 1 and one[0]["slot"] == 0
    by_bytes = kdshard.kd_shards(documents(spark, [(i, "x" * 99, "en", "a", 0) for i in range(40)]), target_bytes=1000).collect()
    assert {r["shard"] for r in by_bytes} == {0, 1, 2, 3}


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _base_spans(text):
    out = []
    for rank, (kind, rx) in enumerate(BASE.items()):
        for m in re.finditer(rx, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip":
                ok = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                total = sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(d))))
                ok = 12 <= len(d) <= 19 and total % 10 == 0
            else:
                ok = kind == "email" or 9 <= len(d) <= 15
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


PII_TEXTS = [
    "mail a.b+c@x-y.example.com, a@b.c_d@e.f.g; @x.y a@b", "über 1.2.3.4 and 1.2.3.4.5.6.7.8 256.1.1.1 0255.01.2.3 1..2.3.4 999.1.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 4 1 1 1 12 49927398716 0000 0000 0000", "+1 (243) 555-5526 +49.30.1234567 ++1234567890 +1 +12 345 6789- x +1234567890123456",
    "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" ssn 123-45-6789 call 212-555-0199", "日本 a@b.co 😀 +1 212 555 0199 😀 4111111111111111", "1" * 5000 + " " + "a" * 5000 + "@b.c",
    "1 " * 3000, "a@b.c" + ".d" * 3000, "1.2.3.4," * 800, "", None,
]


def test_pii_base_spans_equal_python(spark):
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(PII_TEXTS + [r[1] for r in EDGE])]
    got = {r["doc_id"]: r for r in pii.find_pii(documents(spark, rows, extra=True)).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        want = _base_spans(t)
        line = ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
        assert got[i]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest(), t
        n = collections.Counter(x[3] for x in want)
        assert [got[i][f"n_{k}"] for k in BASE] == [n[k] for k in BASE]
        assert set(filter(None, line.split(","))) <= set(got[i]["spans"].split(","))
    added = set(got[4]["spans"].split(","))
    assert any(x.startswith("secret:") for x in added)
    assert pii.find_pii(documents(spark, [])).collect() == []


def test_reliabilities_are_learned():
    rng = random.Random(7)
    rows = collections.Counter()
    for _ in range(4000):  # two good labelers, one that guesses
        z = rng.random() < 0.4
        v = (z if rng.random() < 0.9 else not z, z if rng.random() < 0.85 else not z, rng.random() < 0.5)
        rows[("email", tuple(int(x) for x in v), 1)] += 1
    w = pii.fit([(k, v, c, n) for (k, v, c), n in sorted(rows.items())])["email"]
    z = lambda v: w[0] + sum(w[1 + 2 * i + x] for i, x in enumerate(v)) + w[7 + 1]
    assert z((1, 1, 0)) > 0 > z((0, 0, 1)) and abs(w[6] - w[5]) < abs(w[2] - w[1])


TOOLS = {"f": {"q": ("string", True), "n": ("integer", False)}, "g": {"x": ("any", False)}}


def test_tool_calls(spark):
    ref = lambda x: '{"$ref":"%s"}' % x
    calls = [(1, 5, "c", "f", '{"q":%s}' % ref("b")), (1, 1, "a", "f", '{"n": 1, "q":"x"}'), (1, 3, "b", "g", '{"x":{"z":1,"y":[%s]}}' % ref("a")),
             (1, 7, "d", "f", '{"q":1}'), (1, 8, "e", "f", '{"n":2}'), (1, 9, "h", "zzz", "{}"), (1, 10, "i", "f", "not json"), (1, 11, "j", "f", '{"q":"x","w":0}'),
             (1, 12, "k", "g", '{"x":%s}' % ref("l")), (1, 13, "l", "g", '{"x":%s}' % ref("k")), (1, 14, "m", "g", '{"x":%s}' % ref("k")),
             (1, 15, "n", "g", '{"x":%s}' % ref("gone")), (1, 16, "o", "g", '{"x":"a \\"quote\\" ü"}'), (2, 1, "a", "g", "{}"), (2, 2, "a", "g", '{"x":1}'),
             (2, 3, "p", "g", None), (None, 1, "a", "g", "{}"), (2, 4, None, "g", "{}"), (3, 1, "q", "g", '{"x":1}'), (3, 1, "q", "g", '{"x":1}')]
    results = [(1, 2, "a", 'r "1"'), (1, 4, "b", "r2"), (1, 6, "c", None), (1, 3, "a", "late"), (1, 20, "o", ""), (4, 1, "zz", "lost"), (3, 2, "q", "ok")]
    out = toolcalls.link_tool_calls(spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string"),
                                    spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"), TOOLS).collect()
    by = {(r["conv_id"], r["call_id"]): r for r in out if r["conv_id"] != 2}
    status = lambda c: (by[1, c]["status"], by[1, c]["errors"], by[1, c]["level"])
    assert status("a") == ("ok", [], 0) and status("b") == ("ok", [], 1) and status("c") == ("ok", [], 2)
    assert status("d")[:2] == ("invalid_arguments", ["type:q"]) and status("e")[:2] == ("invalid_arguments", ["missing:q"])
    assert status("h")[1] == ["unknown_tool"] and status("i")[1] == ["invalid_json"] and status("j")[1] == ["unknown:w"]
    assert status("k") == ("cyclic", [], None) and status("l") == ("cyclic", [], None) and status("m") == ("cyclic", [], None)
    assert status("n")[1] == ["unknown_reference"] and by[4, "zz"]["status"] == "orphan_result" and by[3, "q"]["status"] == "ok"
    assert by[1, "a"]["json"] == '{"arguments":{"n":1,"q":"x"},"id":"a","name":"f","result":"r \\"1\\""}' and by[1, "a"]["n_results"] == 2
    assert by[1, "b"]["json"] == '{"arguments":{"x":{"y":[{"$ref":"a"}],"z":1}},"id":"b","name":"g","result":"r2"}'
    assert json.loads(by[1, "o"]["json"]) == {"arguments": {"x": 'a "quote" ü'}, "id": "o", "name": "g", "result": ""}
    assert [r["status"] for r in out if r["conv_id"] == 2 and r["call_id"] == "a"] == ["duplicate_id"] * 2
    assert {r["status"] for r in out if r["conv_id"] is None or r["call_id"] is None} == {"no_id"}
    for c in (1, 2, 3, 4):
        assert sorted(r["position"] for r in out if r["conv_id"] == c) == list(range(sum(r["conv_id"] == c for r in out)))
    order = {r["call_id"]: r["position"] for r in out if r["conv_id"] == 1}
    assert order["a"] < order["b"] < order["c"]


def test_a_long_conversation(spark):
    conv = spark.createDataFrame([(1, i, ("user", "assistant")[i % 2], f"text {i}") for i in range(1400)] + [(2, 0, "assistant", None), (None, 1, "user", "x")],
                                 "conv_id long, turn long, role string, text string")
    out = toolcalls.link_tool_calls(*toolcalls.calls_of_conversations(conv), toolcalls.TOOLS).collect()
    mine = sorted((r for r in out if r["conv_id"] == 1), key=lambda r: r["position"])
    assert [r["position"] for r in mine] == list(range(701)) and (mine[-1]["status"], mine[-1]["turn"]) == ("orphan_result", 0)  # the first turn answers nothing
    mine = mine[:-1]
    assert max(r["level"] for r in mine) == 2
    at = {r["call_id"]: r["position"] for r in mine}
    for r in mine:
        body = json.loads(r["json"])
        assert all(at[x] < r["position"] for x in r["needs"]) and r["json"] == json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert body["result"] == (f"text {r['turn'] + 1}" if r["turn"] < 1399 else None)


def test_every_turn_gives_a_call_or_a_result(spark):
    """Also those with a null role or turn, a negative turn, or a null conversation."""
    conv = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, None, "c"), (1, 3, "assistant", "d"), (1, None, "user", "e"), (1, None, None, "f"), (1, None, "assistant", "g"),
            (2, -1, "assistant", "h"), (2, 0, "system", "i"), (2, -5, "user", "j"), (None, 1, "assistant", "k"), (None, 2, "user", "l"), (3, 0, "user", None)]
    table = spark.createDataFrame(conv, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS status", "'y' AS call_id", "1 AS level")
    out = toolcalls.link_tool_calls(*toolcalls.calls_of_conversations(table), toolcalls.TOOLS).collect()
    got = sorted((str(r["conv_id"]), str(r["turn"]), r["status"] if r["status"] in ("orphan_result", "no_id", "no_result") else "linked", json.loads(r["json"])["result"]) for r in out)
    assert got == sorted([
        ("1", "0", "orphan_result", "a"), ("1", "1", "linked", "c"), ("1", "3", "no_result", None), ("1", "None", "orphan_result", "e"), ("1", "None", "orphan_result", "f"),
        ("1", "None", "no_id", None), ("2", "-1", "linked", "i"), ("2", "-5", "orphan_result", "j"), ("None", "1", "no_id", None), ("None", "2", "orphan_result", "l"),
        ("3", "0", "orphan_result", "")])
    assert toolcalls.link_tool_calls(*toolcalls.calls_of_conversations(table.where("false")), toolcalls.TOOLS).collect() == []


def test_shards_by_null_and_repeated_ids(spark):
    """Copies of a hot text are dealt out whatever their ids are."""
    rng = random.Random(5)
    others = [(10 + i, f"another text {i} " + "x" * rng.randrange(40), "en", "a", 0) for i in range(1500)]
    for ident in (None, 0):
        got = _shards(spark, others + [(ident, "nineteen characters", "en", "a", 0)] * 3000).collect()
        size, slots = collections.Counter(), collections.defaultdict(list)
        for r in got:
            size[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert len(got) == 4500 and len(size) == 8 and max(size.values()) <= 1.05 * min(size.values())
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards_by_sources_with_a_long_common_start(spark):
    rows = [(i, f"{i:04d} text of one length", "en", f"common_crawl_20{21 + 2 * (i % 2)}", 0) for i in range(2000)]
    of = collections.defaultdict(set)
    for r in _shards(spark, rows, 2).collect():
        of[r["shard"]].add(r["source"])
    assert sorted(map(sorted, of.values())) == [["common_crawl_2021"], ["common_crawl_2023"]]


def _by_sorting(points, leaves):
    """The tree by sorting whole nodes: leaf -> bytes and the spread of its
    sources; points are (weight, source rank, language rank, log length)."""
    lo, hi = ([f(p[i] for p in points) for i in (1, 2, 3)] for f in (min, max))
    scaled = [(p[0], *[(p[i + 1] - lo[i]) / ((hi[i] - lo[i]) or 1) for i in range(3)]) for p in points]

    def split(node, m):
        if m == 1:
            return [sum(p[0] for p in node)]
        dim = max(range(1, 4), key=lambda i: (max(p[i] for p in node) - min(p[i] for p in node), -i)) if node else 1
        node = sorted(node, key=lambda p: p[dim])
        want, at, total = sum(p[0] for p in node) * (m // 2) / m, 0, 0
        while at < len(node) and abs(total + node[at][0] - want) <= abs(total - want):
            total += node[at][0]
            at += 1
        return split(node[:at], m // 2) + split(node[at:], m - m // 2)

    return split(scaled, leaves)


def test_shard_bytes_equal_a_tree_by_sorting(spark):
    """Where no two points tie, leaves hold the bytes that sorting gives, up to the search's tolerance."""
    rows = [(i, "x" * (40 + 3 * i), "en", "a", 0) for i in range(700)]
    for n in (2, 3, 8):
        size = collections.Counter()
        for r in _shards(spark, rows, n).collect():
            size[r["shard"]] += r["size"]
        want = _by_sorting([(len(r[1]) + 1, 0, 0, math.log(len(r[1]) + 1)) for r in rows], n)
        most = max(len(r[1]) + 1 for r in rows)
        assert all(abs(size[i] - w) <= 2 * most for i, w in enumerate(want)), (size, want)


def test_plans_do_not_grow_with_the_levels_of_the_tree(spark, monkeypatch):
    sizes, cuts = [], kdshard._cuts

    def seen(p, *a):
        sizes.append(len(p.where("_node = 1")._jdf.queryExecution().optimizedPlan().toString()))
        return cuts(p, *a)
    monkeypatch.setattr(kdshard, "_cuts", seen)
    rows = [(i, "x" * (40 + 3 * i), "en", "a", 0) for i in range(200)]
    got = _shards(spark, rows, 16)
    assert len(sizes) == 4 and max(sizes[1:]) <= 1.2 * sizes[1]
    size = collections.Counter()
    for r in got.collect():
        size[r["shard"]] += r["size"]
    want = _by_sorting([(len(r[1]) + 1, 0, 0, math.log(len(r[1]) + 1)) for r in rows], 16)
    assert all(abs(size[i] - w) <= 2 * max(len(r[1]) + 1 for r in rows) for i, w in enumerate(want)), (size, want)


def test_mix_of_rows_without_ids(spark):
    """Null and repeated ids, and rows that agree in everything, count as rows of their own."""
    rng = random.Random(6)
    rows = [(None, "one two three four", "en", "a", 0)] * 400 + [(7, " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(1, 30))), "en", rng.choice("abc"), 0) for _ in range(900)]
    rows += [(None, f"text {i} of b", "en", "b", 0) for i in range(300)]
    out = mixing.mix_documents(documents(spark, rows)).collect()
    again = mixing.mix_documents(documents(spark, rows)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    size, taken = collections.Counter(), collections.Counter()
    for r in rows:
        size[r[3]] += len(r[1].split())
    for r in out:
        taken[r["source"]] += len(r["text"].split())
    share, weights = 1.5 * sum(size.values()), {"a": 3, "b": 1, "c": 2}
    target = {s: min(2 * size[s], share * weights[s] / 6) for s in size}
    for _ in range(3):  # what is above twice a source's size goes to the others by weight
        free = [s for s in size if target[s] < 2 * size[s]]
        rest = share - sum(target[s] for s in size if s not in free)
        target |= {s: min(2 * size[s], rest * weights[s] / sum(weights[x] for x in free)) for s in free}
    assert all(abs(taken[s] - target[s]) <= 40 for s in size), (taken, target)
    counts, given = collections.Counter(r[:4] for r in rows), collections.Counter(tuple(r)[:4] for r in out)
    assert all(n <= 2 * counts[r] for r, n in given.items()) and set(given) <= set(counts)


def test_pii_of_a_text_with_very_many_matches(spark):
    n = 200_000
    text = " ".join(f"user{i}@example.com" for i in range(n)) + " 212-555-0199"
    started = time.time()
    got = pii.find_pii(documents(spark, [(1, text, "en", "a", 0), (2, "a@b.c", "en", "a", 0)])).collect()
    assert time.time() - started < 60
    by = {r["doc_id"]: r for r in got}
    want = ",".join(f"{k}:{s}:{e}" for s, _, e, k in _base_spans(text))
    assert by[1]["n_email"] == n and by[1]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and by[2]["n_email"] == 1


def _cosine_links(rows):
    ok = [v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v) and any(v or []) for _, v, lab in rows]

    def link(i, j):
        if not (ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])):
            return False
        a, b = (np.ldexp(v, -np.frexp(np.abs(v).max())[1]) for v in (np.array(rows[i][1]), np.array(rows[j][1])))
        return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) >= 0.98
    return link


def test_vector_dedup_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", 8)
    rng = np.random.default_rng(8)
    rows = []
    for g in range(12):
        base = rng.normal(size=16)
        for _ in range(8):
            rows.append((len(rows), [float(x) for x in base + rng.normal(size=16) * rng.choice([0, 0.05, 0.1, 0.15])], int(g % 2)))
    nan, inf = float("nan"), float("inf")
    rows += [(100 + i, v, lab) for i, (v, lab) in enumerate([(None, 0), ([0.0] * 16, 0), ([nan] * 16, 0), ([inf] + [1.0] * 15, 0), ([None] + [1.0] * 15, 0), (rows[0][1], None),
             ([2 * x for x in rows[0][1]], 0), (rows[0][1][:3], 0), ([], 0), (rows[1][1], 1), (rows[0][1], 0), ([1e-200] * 16, 0), ([1e-200] * 16, 0)])]
    link = _cosine_links(rows)
    comp = classes(len(rows), link)
    got = {r["vec_id"]: r for r in vectors.vector_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("clash"))).collect()}
    for i, r in enumerate(rows):
        assert got[r[0]]["n_links"] == sum(link(i, j) for j in range(len(rows)) if j != i), r
        assert got[r[0]]["component_id"] == rows[comp[i]][0] and got[r[0]]["kept"] == (comp[i] == i)
    assert vectors.vector_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_error_bounds_hold():
    rng = np.random.default_rng(9)
    for d in (3, 64, 2500):
        u = rng.normal(size=(50, d))
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        q, s, h, e = vectors.quantise(u)
        approx = np.outer(s, s) * vectors.int_product(q, q)
        assert (vectors.int_product(q, q) == q.astype(np.int64) @ q.astype(np.int64).T).all()
        assert (np.abs(approx - u @ u.T) <= np.outer(h, e) + np.outer(e, h) + np.outer(e, e) + 1e-12).all()


def test_near_dedup_decides_by_row(spark):
    rng = random.Random(12)
    prose = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    a, z, u, c, x, y = (prose() for _ in range(6))
    rows = [(1, a, "en", "a", 0), (None, a, "en", "a", 0), (None, z, "en", "a", 0), (3, c, "en", "a", 0), (5, u, "en", "a", 0), (5, c + " end", "en", "b", 0),
            (None, x, "en", "a", 0), (None, x + " end", "en", "a", 0), (None, x, "en", "a", 0), (7, y, "en", "a", 0), (7, y + " end", "en", "a", 0), (7, y, "en", "b", 0),
            (8, None, "en", "a", 0), (8, None, "en", "a", 0), (9, "", "en", "a", 0), (None, None, "en", "a", 0)]
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, documents(spark, rows), "").collect()]
    assert collections.Counter(i for i, _ in got) == {1: 1, None: 3, 3: 1, 5: 1, 7: 1, 8: 1, 9: 1}
    assert {(1, a), (None, z), (3, c), (5, u), (8, None), (9, ""), (None, None)} <= set(got)


def test_pipeline(spark, tmp_path):
    rng = random.Random(10)
    vocab = [a + b for a in ("the", "and", "ing", "ed", "her") for b in ("tion", "er", "of", "s")]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    item = prose(20)
    rows = [(i, prose(rng.randrange(40, 200)), "en", rng.choice("abc"), 0) for i in range(150)]
    rows += [(200, rows[3][1], "en", "a", 0), (201, rows[4][1] + " end", "en", "b", 0), (202, rows[5][1] + " " + item + " " + prose(50), "en", "c", 0)]
    rows += [(300 + i, "".join(chr(rng.randrange(33, 126)) for _ in range(500)), "en", "a", 0) for i in range(5)] + [(400 + i, *r[1:]) for i, r in enumerate(EDGE[:6])]
    d = str(tmp_path)
    documents(spark, rows).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 150, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs, seen = spark.read.parquet(f"{d}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        assert out.columns[:len(docs.columns)] == docs.columns if k < 4 else set(docs.columns) <= set(out.columns)
        out.write.parquet(f"{d}/out{k}")
        docs = spark.read.parquet(f"{d}/out{k}")
        seen.append(collections.Counter(r["doc_id"] for r in docs.select("doc_id").collect()))
    assert set(range(150)) <= set(seen[0]) and not set(range(300, 305)) & set(seen[0])  # junk goes, prose stays
    assert 200 not in seen[1] and 201 not in seen[1] and 3 in seen[1] and 202 in seen[1]
    assert set(seen[1]) - set(seen[2]) == {202}
    assert set(seen[3]) <= set(seen[2]) and max(seen[3].values()) <= 2
    assert seen[4] == seen[3]
    size = collections.Counter()
    for r in docs.collect():
        size[r["shard"]] += r["size"]
    assert len(size) == 8
    once = sorted(map(str, corpus_pipeline.run(spark, d).collect()))
    assert once == sorted(map(str, docs.select(*corpus_pipeline.run(spark, d).columns).collect()))


