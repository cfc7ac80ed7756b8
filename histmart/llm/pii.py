"""Personal data by weak supervision, in DataFrame functions only.

Base spans come from four patterns with checks (e-mail, IP address, payment
card, phone) and always stay.  Looser candidates (numbers of card length that
fail the check digit, phones without country code, obfuscated e-mail, social
security numbers, secrets) join them, and three labelers vote on every
candidate: the strict pattern, a gazetteer (top-level domains, issuer
prefixes, reserved address ranges, key prefixes, area numbers) and the words
before it.  A labeler says yes (1), no (0) or nothing (2).

Expectation-maximisation over the table of vote patterns (a bounded number of
rows: kinds x 27 x length classes) estimates each labeler's reliability, and
the posteriors train a logistic span classifier.  Its weights go back into
the plan as literals; candidates it accepts are added to the base spans.

Positions are code points, end exclusive.  They come from the pieces between
matches: a match starts after all earlier pieces and matches.  Null texts
count as empty; repeated rows and ids are independent of each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmart.session import materialize

KINDS = ("email", "ip", "card", "phone")
MORE = ("ssn", "secret")
#: The patterns, written so that each position is tried once: a run's inner
#: positions can match only where the previous match ended.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates beyond the base patterns.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}[\x20]?[\[(](?:at|AT)[\])][\x20]?[A-Za-z0-9-]{1,63}(?:[\x20]?(?:\.|[\[(](?:dot|DOT)[\])])[\x20]?[A-Za-z0-9-]{1,63}){1,4}",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9_])(?:[0-9a-f]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,48})(?![A-Za-z0-9_])",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: What the gazetteer and the words before a candidate say (fixed values):
#: patterns that vote yes, and patterns that vote no.
GAZETTEER = {
    "email": (r"(?i)\.(?:com|org|net|edu|gov|io|info|eu|de|fr|es|it|nl|uk|us|ca|at|ch)$", r"(?i)\.(?:png|jpe?g|gif|js|css|py|local|invalid)$"),
    "ip": (r"^(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.", r"^0*(?:0|127|22[4-9]|2[3-5][0-9])\."),
    "card": (r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65|62)", r"^(?:0|1|9)"),
    "phone": (r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9])", r"^\(?[01]"),
    "ssn": (r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$", r"^(?:000|666|9)"),
    "secret": (r"^(?:AKIA|gh[pousr]_|sk-)|(?=.*[a-f])(?=.*[0-9])", r"^(.)\1*$"),
}
CONTEXT = {
    "email": (r"(?i)(?:e-?mail|mailto|contact|write|kontakt|correo|courriel)\W*$", r"(?i)(?:example|user@|todo)\W*$"),
    "ip": (r"(?i)(?:\bip|address|host|server|client|from)\W*$", r"(?i)(?:version|release|section|v|\d\.)\W*$"),
    "card": (r"(?i)(?:card|visa|master|amex|credit|pay|karte|tarjeta|carte)\W*(?:no|number|nr)?\W*$", r"(?i)(?:isbn|order|id|serial|ref|invoice)\W*(?:no|number|nr)?\W*$"),
    "phone": (r"(?i)(?:phone|tel|call|fax|mobile|cell|telefon|tél|móvil)\W*(?:no|number|nr)?\W*$", r"(?i)(?:isbn|order|serial|ref|invoice)\W*$"),
    "ssn": (r"(?i)(?:ssn|social security|security)\W*(?:no|number|nr)?\W*$", r"(?i)(?:part|order|serial|ref|isbn)\W*$"),
    "secret": (r"(?i)(?:token|key|secret|passw(?:or)?d|auth|credential|bearer)[\s\"'=:]*$", r"(?i)(?:sha(?:1|256)?|md5|commit|checksum|hash|digest)[\s\"'=:]*$"),
}
BEFORE = 32
#: matches whose positions are summed in one go
MATCHES = 256
SPAN = "struct<kind:string,s:int,e:int,base:boolean,strict:int,gaz:int,ctx:int,len:int>"
_FOUND = "array<struct<s:int,e:int,t:string,before:string>>"


def _matches(text: Column, pattern: str, guard: Column) -> Column:
    """Start, end, match and the text before, for each match in order.

    Positions are sums of lengths.  They are summed within blocks of matches,
    then over blocks, so the work for a text grows with its matches times a
    block, and not with their square.
    """
    m, p = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def step(a: Column, x: Column) -> Column:
        s = a["at"] + F.char_length(x["p"])
        e = s + F.char_length(x["m"])
        one = F.struct(s.alias("s"), e.alias("e"), x["m"].alias("t"), F.right(x["p"], F.lit(BEFORE)).alias("before"))
        return F.struct(e.alias("at"), F.array_append(a["out"], one).cast(_FOUND).alias("out"))

    def moved(at: Column, found: Column) -> Column:
        return F.transform(found, lambda x: F.struct((x["s"] + at).alias("s"), (x["e"] + at).alias("e"), x["t"].alias("t"), x["before"].alias("before")))

    def summed(pairs: Column) -> Column:
        # blocks of at most MATCHES; there are none without matches
        firsts = F.filter(F.sequence(F.lit(0), F.size(pairs), F.lit(MATCHES)), lambda i: i < F.size(pairs))
        return F.transform(firsts, lambda i: F.aggregate(F.slice(pairs, i + 1, F.lit(MATCHES)), zero, step))

    def placed(done: Column) -> Column:
        ends = F.aggregate(done, F.array(F.lit(0)), lambda a, x: F.array_append(a, F.element_at(a, -1) + x["at"]))
        return F.flatten(F.zip_with(done, F.slice(ends, F.lit(1), F.size(done)), lambda x, at: moved(at, x["out"])))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("out"))
    pairs = F.zip_with(m, F.slice(p, F.lit(1), F.size(m)), lambda x, y: F.struct(x.alias("m"), y.alias("p")))
    found = _let(_let(pairs, summed), placed)
    return F.when(guard, found).otherwise(F.array().cast(_FOUND)).cast(_FOUND)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body's own
    functions of array elements read it again and again."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def _strict(kind: str, t: Column) -> Column:
    """Whether a match of the base pattern passes its check."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return t.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    n = F.length(_digits(t))
    if kind == "card":
        return n.between(12, 19) & F.when(n.between(12, 19), F.call_function("luhn_check", _digits(t))).otherwise(False)
    return n.between(9, 15)


def _vote(yes_no: tuple[str, str], t: Column) -> Column:
    return F.when(t.rlike(yes_no[0]), 1).when(t.rlike(yes_no[1]), 0).otherwise(2)


def _checked(kind: str) -> Callable[[Column], Column]:
    return lambda x: _strict(kind, x["t"])


def _spanned(kind: str, base: bool, strict: int) -> Callable[[Column], Column]:
    return lambda x: _span(kind, x, F.lit(base), F.lit(strict))


def _span(kind: str, x: Column, base: Column, strict: Column) -> Column:
    t = _digits(x["t"]) if kind == "card" else x["t"]
    n = F.char_length(t)
    size = F.when(n < 8, 0).when(n < 14, 1).when(n < 24, 2).otherwise(3)
    return F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), base.alias("base"), strict.cast("int").alias("strict"),
                    _vote(GAZETTEER[kind], t).alias("gaz"), _vote(CONTEXT[kind], x["before"]).alias("ctx"), size.alias("len")).cast(SPAN)


def candidates(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, base, loose): the spans of every document, with votes."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = documents.select(F.col(id_col).alias("_id"), body.alias("_text"))
    text, digit = F.col("_text"), F.col("_text").rlike("[0-9][\\x20.-]?[0-9]")
    guards = {"email": F.contains(text, F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(text, F.lit("+"))}
    d = d.withColumns({f"_{k}": _matches(text, PATTERNS[k], guards[k]) for k in KINDS}
                      | {f"_loose_{k}": _matches(text, p, digit if k in ("phone", "ssn") else text.rlike(p)) for k, p in LOOSE.items()})
    base, loose = [], []
    for k in KINDS:
        ok = F.filter(f"_{k}", _checked(k))
        base.append(F.transform(ok, _spanned(k, True, 1)))
    long_numbers = F.filter("_card", lambda x: F.length(_digits(x["t"])).between(12, 19) & ~_strict("card", x["t"]))
    loose.append(F.transform(long_numbers, _spanned("card", False, 0)))
    for k in LOOSE:
        loose.append(F.transform(f"_loose_{k}", _spanned(k, False, 1 if k in MORE else 0)))
    d = d.select("_id", F.concat(*base).alias("base"), F.concat(*loose).alias("loose"))
    d = d.select("_id", "loose", "base", *[F.filter("base", _of_kind(k)).alias(f"_base_{k}") for k in KINDS])  # spans of one kind are disjoint, in order
    apart = _let(F.struct("loose", *[f"_base_{k}" for k in KINDS]), lambda d: F.filter(d["loose"], lambda x: ~reduce(or_, [_overlaps(d[f"_base_{k}"], x) for k in KINDS])))
    return d.select("_id", "base", apart.alias("loose"))


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def _overlaps(spans: Column, x: Column) -> Column:
    """Whether a span meets one of a sorted array of disjoint spans: the first
    of them that ends behind its start, by binary search."""
    def half(a: Column, _: Column) -> Column:
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        behind = F.get(spans, mid)["e"] > x["s"]
        open_ = a["lo"] < a["hi"]
        return F.struct(F.when(open_ & ~behind, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(open_ & behind, mid).otherwise(a["hi"]).alias("hi"))

    rounds = F.when(F.size(spans) > 0, F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))).otherwise(F.array().cast("array<int>"))
    at = F.aggregate(rounds, F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), half, lambda a: a["lo"])
    return F.coalesce(F.get(spans, at)["s"] < x["e"], F.lit(False))


def fit(patterns: list[tuple[str, tuple[int, int, int], int, int]], rounds: int = 30) -> dict[str, list[float]]:
    """Weights of the span classifier for each kind.

    ``patterns`` has (kind, votes of the three labelers, length class, count),
    a row for each pattern that occurs.  Per kind, expectation-maximisation
    estimates how often each labeler says yes, no or nothing on real and on
    other spans, from a start at the majority of the votes; logistic
    regression on the votes and the length class learns the posteriors.
    """
    weights = {}
    for kind in (*KINDS, *MORE):
        rows = [(v, c, n) for k, v, c, n in patterns if k == kind]
        if not rows:
            continue
        post = [min(0.95, max(0.05, 0.5 + 0.2 * sum(x == 1 for x in v) - 0.2 * sum(x == 0 for x in v))) for v, _, _ in rows]
        for _ in range(rounds):
            total = sum(n for _, _, n in rows)
            prior = (1 + sum(p * n for p, (_, _, n) in zip(post, rows))) / (2 + total)
            says = [[[1.0 + 2.0 * (x == (1 if z else 0)) for x in range(3)] for z in (0, 1)] for _ in range(3)]  # labelers are better than chance
            for p, (v, _, n) in zip(post, rows):
                for lab, x in enumerate(v):
                    says[lab][1][x] += p * n
                    says[lab][0][x] += (1 - p) * n
            says = [[[y / sum(z) for y in z] for z in lab] for lab in says]
            for i, (v, _, _) in enumerate(rows):
                yes = prior * math.prod(says[lab][1][x] for lab, x in enumerate(v))
                no = (1 - prior) * math.prod(says[lab][0][x] for lab, x in enumerate(v))
                post[i] = yes / (yes + no)
        x = [[1.0, *(float(v[lab] == y) for lab in range(3) for y in (0, 1)), *(float(c == y) for y in range(4))] for v, c, _ in rows]
        w = [0.0] * 11
        total = sum(n for _, _, n in rows)
        for _ in range(500):
            grad = [1e-3 * y for y in w]
            for f, p, (_, _, n) in zip(x, post, rows):
                miss = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, f)))) - p
                grad = [g + miss * n / total * b for g, b in zip(grad, f)]
            w = [a - 2.0 * g for a, g in zip(w, grad)]
        weights[kind] = w
    return weights


def _accepted(x: Column, weights: dict[str, list[float]]) -> Column:
    out = F.lit(False)
    for kind, w in weights.items():
        z = F.lit(w[0])
        for lab, vote in enumerate(("strict", "gaz", "ctx")):
            z = z + F.when(x[vote] == 0, w[1 + 2 * lab]).when(x[vote] == 1, w[2 + 2 * lab]).otherwise(0.0)
        z = z + F.element_at(F.array(*[F.lit(y) for y in w[7:]]), x["len"] + 1)
        out = F.when(x["kind"] == kind, z > 0).otherwise(out)
    return out


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind in the order of KINDS and MORE."""
    rank = lambda x: F.array_position(F.array(*[F.lit(k) for k in (*KINDS, *MORE)]), x["kind"])
    keyed = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), rank(x).alias("r"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_pii(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone and
    base_sha256 of the base spans, spans (all of them) and n_added."""
    found = materialize(candidates(documents, id_col, text_col), "pii")
    votes = found.select(F.explode(F.concat("base", "loose")).alias("x")).groupBy("x.kind", "x.strict", "x.gaz", "x.ctx", "x.len").agg(F.count("*").alias("n"))
    weights = fit(sorted((r["kind"], (r["strict"], r["gaz"], r["ctx"]), r["len"], r["n"]) for r in votes.collect()))
    found = found.withColumn("added", F.filter("loose", lambda x: _accepted(x, weights)))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(F.col("_id").alias(id_col), *[count(k) for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
