"""Near-dedup, decontamination, language ID, quality and licenses."""

import hashlib
import random
import textwrap

import numpy as np
import pyarrow as pa
import pytest

from histmart.llm import decontam, graph, langid, licenses, minhash, quality
from histmart.llm import text as T
from tests.llm.helpers import EDGE, classes, documents, shingle_set, words

VOCAB = [f"w{i}" for i in range(400)]


def _near_copies(rng, n_groups=6, per=12, n_words=60):
    rows = []
    for _ in range(n_groups):
        base = [rng.choice(VOCAB) for _ in range(n_words)]
        for _ in range(per):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 6])):
                w[rng.randrange(len(w))] = rng.choice(VOCAB)
            rows.append((len(rows), " ".join(w), "en", "a", 0))
    rows += [(len(rows) + i, " ".join(rng.choice(VOCAB) for _ in range(rng.randrange(1, 80))), "en", "a", 0) for i in range(30)]
    return rows


@pytest.mark.parametrize("k,short", [(2, False), (2, True), (5, True)])
def test_minhash_equals_brute_force(spark, monkeypatch, k, short):
    if short:  # long lists, in small blocks
        monkeypatch.setattr(minhash, "LIST_JOIN", 1)
        monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = _near_copies(random.Random(k))
    sets = [shingle_set(r[1], k) for r in rows]
    want = classes(len(rows), lambda i, j: bool(sets[i]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]))
    got = {r["doc_id"]: r for r in minhash.minhash_dedup(documents(spark, rows), shingle=k).collect()}
    assert [got[i]["component_id"] for i in range(len(rows))] == want
    assert [got[i]["n_shingles"] for i in range(len(rows))] == [len(s) for s in sets]
    assert [got[i]["kept"] for i in range(len(rows))] == [w == i for i, w in enumerate(want)]


def test_minhash_edges(spark):
    got = [tuple(r) for r in minhash.minhash_dedup(documents(spark, EDGE, extra=True), shingle=2).collect()]
    by = {r[0]: r for r in got}
    assert len(got) == len(EDGE)
    assert by[1] == (1, 0, 1, True) and by[2] == (2, 0, 2, True) and by[3] == (3, 0, 3, True)
    assert by[5][2] == by[9][2] == by[4][2] == 4 and by[8][2] == 7 and by[7][3] and not by[8][3]
    assert by[None] == (None, 5, None, True)
    assert minhash.minhash_dedup(documents(spark, [])).collect() == []


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (5, 4), (4, 6), (6, 1), (20, 20), (3, 30)] + [(100 + i, 101 + i) for i in range(20)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {x: 1 for x in (1, 2, 3, 4, 5, 6, 30)} | {10: 10, 11: 10} | {100 + i: 100 for i in range(21)}
    assert got == want


def test_components_in_small_plans(spark, monkeypatch):
    exchanges, write = [], graph.materialize

    def seen(df, *a):
        exchanges.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return write(df, *a)
    monkeypatch.setattr(graph, "materialize", seen)
    edges = [(i, i + 1) for i in range(40)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == dict.fromkeys(range(41), 0)
    assert len(exchanges) > 2 and max(exchanges) <= 5, exchanges


def test_words_and_shingles_of_bytes():
    texts = ["", "One  two\tTHREE", None, "one", "  ", "a b a b", "één twee één"]
    for _, _, data, offsets in T.text_chunks(pa.array(texts)):
        s, e, doc = T.words(data, offsets)
        assert [data[a:b].tobytes().decode() for a, b in zip(s, e)] == [w for t in texts for w in (t or "").split()]
        d, h = T.shingles(T.word_hashes(data, s, e), doc, len(texts), 2)
        assert np.bincount(d, minlength=len(texts)).tolist() == [len(shingle_set(t, 2)) for t in texts]
    chunks = list(T.text_chunks(pa.array(texts).slice(1, 4), max_bytes=4))
    assert [c[:2] for c in chunks][0][0] == 0 and chunks[-1][1] == 4


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(3)
    item = lambda n: " ".join(rng.choice(VOCAB[:40]) for _ in range(n))
    items = {"1": item(25), "2": item(12), "10": item(4), "3": "", "4": None, "5": "Ünï-cödé x", "6": item(10)}
    texts = [r[1] for r in EDGE]
    for t in items.values():
        texts += [f"zz {(t or '').upper()}! yy", " ".join((t or "").split()[2:13]), f"{t}, {t}"]
    texts += [item(300) for _ in range(10)]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    bench = spark.createDataFrame([(int(i), t) for i, t in items.items()] + [(None, item(12)), (2, items["2"])], "item_id long, text string")
    found = decontam.decontaminate(documents(spark, rows, extra=True), bench)
    got = {r["doc_id"]: r for r in decontam.digest(found).collect()}
    for i, t in enumerate(texts):
        want = decontam.brute_force(t, items) if len(t or "") < 10_000 else (len(decontam.normalise(t).split()), 0, 0, hashlib.sha256(b"").hexdigest())
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"], got[i]["items_sha256"]) == want, t
    for r in found.collect():  # spans hold the hit words, in the original
        assert sum(len(decontam.normalise(texts[r["doc_id"]][s["start"]:s["end"]]).split()) for s in r["spans"]) == r["n_hit"]


def test_decontamination_in_parts(spark, monkeypatch):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice(VOCAB) for _ in range(30))) for i in range(4)]
    docs = documents(spark, [(i, f"{items[i % 4][1]} and {items[(i + 1) % 4][1]}", "en", "a", 0) for i in range(8)] + EDGE[:3])
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(str, decontam.decontaminate(docs, bench).collect()))
    monkeypatch.setattr(decontam, "AUTOMATON_BYTES", 10)
    assert sorted(map(str, decontam.decontaminate(docs, bench).collect())) == one
    empty = decontam.decontaminate(docs, bench.limit(0)).collect()
    assert len(empty) == 11 and all(r["n_hit"] == 0 for r in empty)


def test_decontamination_in_many_parts(spark, monkeypatch):
    rng = random.Random(5)
    item = lambda i: " ".join(f"{rng.choice(VOCAB)}x{i}" for _ in range(10))
    items = [(i, item(i)) for i in range(10)] + [(10, "w1 w2 w3"), (11, "w1 w2 w3")]
    docs = documents(spark, [(i, f"{items[i][1]} and {items[(i + 1) % 12][1]}", "en", "a", 0) for i in range(12)] + EDGE[:3])
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    one = sorted(map(str, decontam.decontaminate(docs, bench).collect()))
    monkeypatch.setattr(decontam, "AUTOMATON_BYTES", 10)
    assert sorted(map(str, decontam.decontaminate(docs, bench).collect())) == one
    assert sum("'10', '11'" in x for x in one) == 3


LANGS = {"en": ["the", "and", "thing", "with", "house"], "de": ["der", "und", "nicht", "straße", "haus"], "fr": ["le", "été", "avec", "maison", "qui"],
         "es": ["el", "niño", "con", "casa", "año"]}


def test_language_id(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(LANGS[x]) for _ in range(rng.randrange(3, 40))), x, "a", 0) for i, x in enumerate(list(LANGS) * 60)]
    rows += [(1000 + i, r[1], r[2], r[3], r[4]) for i, r in enumerate(EDGE[:4])] + [(2000, "123 ... !!", "en", "a", 0), (2001, "été avec maison", None, "a", 0), (None, "der und nicht", "de", "a", 0)]
    got = {r["doc_id"]: r for r in langid.identify(documents(spark, rows, extra=True)).collect()}
    held = [r for r in rows[:240] if got[r[0]]["held_out"]]
    assert len(held) > 30 and np.mean([got[r[0]]["lang_pred"] == r[2] for r in held]) >= 0.95
    assert {got[i]["lang_pred"] for i in (1000, 1001, 1002, 2000)} == {"und"} and got[2000]["score"] == 0
    assert got[2001]["lang_pred"] == "fr" and got[None]["lang_pred"] == "de" and not got[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.identify(documents(spark, [])).collect() == []
    unlabelled = langid.identify(documents(spark, [(1, "the and", None, "a", 0)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in unlabelled] == [("und", 0.0)]


def _brute_ngrams(texts, order):
    from collections import Counter

    c = Counter()
    for t in texts:
        b = bytes([quality.START]) * (order - 1) + t.encode()
        c.update(b[i - order + 1:i + 1] for i in range(order - 1, len(b)))
    return c


def _brute_kneser_ney(texts):
    """log probability of the last byte of an n-gram, by the textbook."""
    import math
    from collections import Counter

    n = quality.ORDER
    c = {n: _brute_ngrams(texts, n)}
    for k in range(n - 1, 0, -1):
        c[k] = Counter(g[1:] for g in c[k + 1])
    d = {}
    for k, t in c.items():
        m = [sum(v == j for v in t.values()) for j in range(5)]
        d[k] = (0.5, 1.0, 1.5)
        if m[1] and m[2]:
            y = m[1] / (m[1] + 2 * m[2])
            raw = [1 - 2 * y * m[2] / m[1], 2 - 3 * y * m[3] / m[2], 3 - 4 * y * m[4] / m[3] if m[3] else 1.5]
            d[k] = tuple(min(max(x, 0.1), j - 0.05) for j, x in enumerate(raw, 1))

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / 256
        same = {h: v for h, v in c[k].items() if h[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        s = sum(same.values())
        off = lambda v: d[k][min(v, 3) - 1]
        return max(same.get(g, 0) - (off(same[g]) if g in same else 0), 0) / s + sum(map(off, same.values())) / s * p(g[1:])

    return lambda text: sum(math.log(p(x[i - n + 1:i + 1])) for x in [bytes([quality.START]) * (n - 1) + text.encode()] for i in range(n - 1, len(x)))


def test_perplexity_equals_the_textbook(spark, monkeypatch):
    train = ["the cat sat on the mat", "the dog sat", "", "a cat and a dog and the mat", "ünï"]
    score = ["the cat", "xyz ü", "the dog sat on a mat", "", None, "a", "the cat"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(score)], "key long, text string, lang string")
    want = _brute_kneser_ney(train)
    for size, few in ((8, 10**6), (quality.BATCH_BYTES, 0), (8, 0)):  # a broadcast; one batch, and many
        monkeypatch.setattr(quality, "BATCH_BYTES", size)
        monkeypatch.setattr(quality, "BROADCAST_NGRAMS", few)
        got = {r["key"]: r for r in quality.perplexity(docs, spark.createDataFrame([(t,) for t in train], "text string")).collect()}
        assert len(got) == len(score)
        for i, t in enumerate(score):
            assert got[i]["n_bytes"] == len((t or "").encode()) and got[i]["lp"] == pytest.approx(want(t or ""), abs=1e-9)


def test_quality_decisions(spark):
    rng = random.Random(6)
    good = [(i, " ".join(rng.choice(LANGS["en"]) for _ in range(80)), "en", "a", 0) for i in range(120)]
    bad = [(200 + i, "".join(chr(rng.randrange(33, 126)) for _ in range(400)), "en", "a", 0) for i in range(20)]
    edge = [(1000 + i, *r[1:]) for i, r in enumerate(EDGE[:4])]
    labels = spark.createDataFrame([(i, 1) for i in range(0, 100)] + [(200, 0), (None, 1), (5, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in quality.classify(documents(spark, good + bad + edge, extra=True), labels).collect()}
    assert all(got[r[0]] for r in good) and not any(got[r[0]] for r in bad)
    assert not got[1000] and not got[1001]
    assert quality.classify(documents(spark, []), labels).collect() == []
    free = quality.classify(documents(spark, good[:3] + edge[:1]), labels.limit(0)).collect()
    assert sorted(r["kept"] for r in free) == [False, True, True, True]


def test_license_scan(spark):
    t = licenses.TEMPLATES
    rows = EDGE[:6] + [(20, f"prose here.\n{t['MIT']}\nmore prose", "en", "a", 0), (21, "x\n" + t["BSD-3-Clause"].replace("forms,", "forms"), "en", "a", 0),
                       (22, "I have no license to say that.", "en", "a", 0), (23, "\n".join([t["Apache-2.0"], "prose", t["CC-BY-NC-4.0"]]), "en", "a", 0),
                       (24, t["GPL-3.0"].replace("version 3", "version 9"), "en", "a", 0), (25, "All rights reserved. " + "copyright noise " * 5000, "en", "a", 0)]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(documents(spark, rows, extra=True)).collect()}
    names = lambda i: [x["license"] for x in got[i]["licenses"]]
    assert names(20) == ["MIT"] and names(21) == ["BSD-3-Clause"] and names(22) == [] and names(23) == ["Apache-2.0", "CC-BY-NC-4.0"] and names(24) == []
    assert names(25) == ["all-rights-reserved"] and got[1]["n_blocks"] == 0
    x = got[20]["licenses"][0]
    assert x["exact"] and rows[6][1][x["start"]:x["end"]] in t["MIT"] and x["reduction"] > 0.3
    assert licenses.scan_licenses(documents(spark, [])).collect() == []


def test_adjacent_notices():
    t = licenses.TEMPLATES
    s = licenses.Scanner(t)
    names = lambda text: [x["license"] for x in s.scan(text)[1]]
    assert names("Licensed under CC BY 4.0.\nAll rights reserved.") == ["CC-BY-4.0", "all-rights-reserved"]
    five = ["MIT", "Apache-2.0", "GPL-2.0", "CC-BY-4.0", "all-rights-reserved"]
    assert names("\n".join(t[k] for k in five)) == five
    assert names("\n".join([t["GPL-2.0"], t["GPL-3.0"].replace("General Public", "General and Public")])) == ["GPL-2.0", "GPL-3.0"]
    assert names("\n".join([t["MIT"]] * 3 + [t["BSD-3-Clause"].replace("binary ", "")] * 2)) == ["MIT"] * 3 + ["BSD-3-Clause"] * 2
    assert names("All rights reserved. " * 3000) == ["all-rights-reserved"] * 3000


def _names(s, text):
    return [x["license"] for x in s.scan(text)[1]]


def test_compression_decides_between_templates(monkeypatch):
    """A notice that holds another one's words goes to the template that saves
    most; with the savings turned round it goes to another."""
    t = licenses.TEMPLATES
    s = licenses.Scanner(t)
    holds = {"Apache-2.0-header": "Apache-2.0", "ISC": "0BSD", "BSD-2-Clause-text": "BSD-3-Clause", "AGPL-3.0-header": "GPL-3.0-header"}
    for whole, part in holds.items():
        assert _names(s, f"Some prose before. {t[whole]} And some after.") == [whole]
    both = "\n".join([t["AGPL-3.0-header"], t["GPL-3.0-header"], t["LGPL-3.0-header"]])
    assert _names(s, both) == ["AGPL-3.0-header", "GPL-3.0-header", "LGPL-3.0-header"]
    real = licenses.Scanner.reductions
    compressed = []
    monkeypatch.setattr(licenses.Scanner, "reductions", lambda self, w: compressed.append(w) or real(self, w))
    assert _names(s, "copyright but no notice") == [] and compressed == ["copyright but no notice"]
    monkeypatch.setattr(licenses.Scanner, "reductions", lambda self, w: {k: -x for k, x in real(self, w).items()})
    for whole, part in holds.items():
        got = _names(s, f"Some prose before. {t[whole]} And some after.")
        assert got == [part] if "GPL" not in part else whole not in got and len(got) == 1


def test_every_template_is_found_anywhere():
    t = licenses.TEMPLATES
    s = licenses.Scanner(t)
    noise = "lorem ipsum dolor sit amet consetetur " * 400
    for k, text in t.items():
        for where in (text, f"{noise}{text}", f"{noise}{text} {noise}", "\n# ".join(textwrap.wrap(f"# {text}", 50)), f"{t['CC0-1.0']} {text} {t['MIT']}"):
            assert k in _names(s, where), (k, where[:80])


def test_ranking_and_choice_equal_brute_force():
    """The same choices by trying every stretch of words with every template."""
    t = {"x": "license a b c", "y": "license a b c d e f g h i j k", "z": "c d e rights", "v": "rights 2 b a"}
    s = licenses.Scanner(t)

    def lost(want, have):  # words of the template that a stretch doesn't hold in order
        best = [0] * (len(have) + 1)
        for w in want:
            row = [0]
            for j, h in enumerate(have):
                row.append(max(best[j + 1], row[j], best[j] + (w == h)))
            best = row
        return len(want) - best[-1]

    def choose(words, lo, hi):
        if lo >= hi:
            return []
        saved = s.reductions(" ".join(words[lo:hi]))
        for k in sorted(saved, key=lambda x: (-saved[x], x)):
            want, n = t[k].split(), len(t[k].split())
            numbers = {w for w in want if w.isdigit()}
            found = []
            for i in range(lo, hi):
                for j in range(i + 1, min(hi, i + 2 * n) + 1):
                    if words[i] in want and words[j - 1] in want and numbers <= set(words[i:j]):
                        q = lost(want, words[i:j])
                        x = j - i - (n - q)
                        if (n - q) / n >= licenses.COVER and x <= n:
                            found.append((q + x, i, j))
            if found:
                _, i, j = min(found)
                return [*choose(words, lo, i), (k, i, j), *choose(words, j, hi)]
        return []

    rng = random.Random(11)
    for _ in range(150):
        words = ["license"] + [rng.choice(["license", "rights", "2", "u", *"abcde"]) for _ in range(rng.randrange(1, 14))]
        if rng.random() < 0.5:
            words[1:1] = rng.choice(list(t.values())).split()
        words = words[:24]
        text = " ".join(words)
        starts = [len(" ".join(words[:i])) + (i > 0) for i in range(len(words))]
        got = [(h["license"], starts.index(h["start"]), text[:h["end"]].count(" ") + 1) for h in s.scan(text)[1]]
        assert got == choose(words, 0, len(words)), text


def test_wordings_equal_brute_force():
    rng = random.Random(8)
    s = licenses.Scanner({"t": "a b c d e f a g h 2 i"})
    want = s.words["t"]
    for _ in range(60):
        have = [w for w in want for w in ([w] if rng.random() < 0.9 else []) + (["z"] if rng.random() < 0.15 else [])] * 2
        got = {(q, x, a, z) for q, x, a, z in s.wordings(have, "t")}
        for a in range(len(have)):
            for z in range(a + 1, min(len(have), a + 2 * len(want)) + 1):
                # longest common subsequence without and with the number
                best = [{False: 0} for _ in range(len(want) + 1)]
                for w in have[a:z]:
                    nxt = [dict(b) for b in best]
                    for i, x in enumerate(want):
                        for f, v in best[i].items():
                            if x == w:
                                g = f or x == "2"
                                nxt[i + 1][g] = max(nxt[i + 1].get(g, 0), v + 1)
                        for f, v in nxt[i].items():
                            nxt[i + 1][f] = max(nxt[i + 1].get(f, 0), v)
                    best = nxt
                n = best[-1].get(True, 0)
                if n >= 10 and z - a - n <= 11 and have[a] != "z" and have[z - 1] != "z":
                    assert any(q <= 11 - n and x <= z - a - n and lo >= a and hi <= z for q, x, lo, hi in got), (have, a, z)
        assert all(0 <= a < z <= len(have) and z - a == 11 - q + x for q, x, a, z in got)


@pytest.mark.parametrize("prefix", ["", "# ", " * ", "// ", "--"])
def test_wrapped_notices(prefix):
    t = licenses.TEMPLATES
    s = licenses.Scanner(t)
    for k in ("MIT-text", "GPL-3.0-header", "Apache-2.0-header", "BSD-3-Clause"):
        for width in (40, 60, 72):
            text = "Some code\n" + "".join(f"{prefix}{x}\n" for x in textwrap.wrap(t[k], width, break_on_hyphens=False, break_long_words=False)) + "more code\n"
            n, found = s.scan(text)
            assert n == 1 and [x["license"] for x in found] == [k] and found[0]["exact"], (k, width, found)


def test_notices_in_long_lines():
    t = licenses.TEMPLATES
    s = licenses.Scanner(t)
    rng = random.Random(9)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) if i % 50 else "warranty" for i in range(4000)]
    for k in t:
        for at in (0, 2000, 4000):
            found = s.scan(" ".join([*noise[:at], t[k], *noise[at:]]))[1]
            assert [x["license"] for x in found] == [k] and found[0]["exact"] and found[0]["reduction"] > 0, (k, at)
    blob = "x" * 200_000
    assert [x["license"] for x in s.scan(f"{blob} {t['MIT']} {blob}")[1]] == ["MIT"]


def test_words_helper_agrees():
    assert words("A b\tC") == ["a", "b", "c"]
