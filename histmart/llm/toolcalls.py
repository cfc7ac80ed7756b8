"""Tool-call linking, in DataFrame functions only.

Calls and results are hash-joined by conversation and call id, calls are
ordered topologically by the results that their arguments refer to
(``{"$ref": "<call id>"}``), arguments are checked against the tool's schema,
and every call becomes one canonical JSON text: keys in order at every level,
no spaces.

Order: a call's level is 0 if it refers to no known call of its conversation,
else one more than the largest level it refers to.  Levels come from peeling
the reference edges: each round settles the calls whose references are all
settled, so rounds follow the longest chain.  Calls on or behind a cycle have
no level; they are ``cyclic`` and come last.  ``position`` numbers the calls
of a conversation by level, turn and id, in blocks of turns, so a
conversation of any length is no single task's.

Null conversation or call ids link with nothing: each such result is a row of
its own.  Identical rows count once;
different calls that share an id are all ``duplicate_id``.  Of several
results the first turn's counts.  A result without a call is a row of its
own (``orphan_result``).  Invalid JSON has no arguments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histmart.session import materialize

#: parameter -> (type, required); types: string, integer, number, boolean, object, array, any
Schemas = dict[str, dict[str, tuple[str, bool]]]
_KIND = {
    "string": r"^STRING", "integer": r"^(?:BIGINT|DECIMAL\([0-9]+,0\))", "number": r"^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)",
    "boolean": r"^BOOLEAN", "object": r"^OBJECT", "array": r"^ARRAY", "any": r"",
}
REFERENCE = r'\{"\$ref":"((?:[^"\\]|\\.)*)"\}'
TURNS = 512


def _errors(schemas: Schemas) -> Column:
    """What is wrong with the arguments ``v`` (variant) of tool ``name``."""
    out = F.array(F.lit("unknown_tool"))
    for tool, params in schemas.items():
        found = []
        for p, (kind, required) in params.items():
            value = F.variant_get("v", f"$['{p}']", "variant")
            held = F.array_contains("keys", p)
            if required:
                found.append(F.when(~held, f"missing:{p}"))
            is_ref = F.schema_of_variant(value).rlike(r"^OBJECT<`?\$ref`?: STRING>")
            found.append(F.when(held & ~F.coalesce(F.schema_of_variant(value).rlike(_KIND[kind]) | is_ref, F.lit(False)), f"type:{p}"))
        extra = F.transform(F.array_except("keys", F.array(*[F.lit(p) for p in params]).cast("array<string>")), lambda k: F.concat(F.lit("unknown:"), k))
        out = F.when(F.col("name") == tool, F.concat(F.array_compact(F.array(*found)), F.array_sort(extra))).otherwise(out)
    return F.when(F.col("v").isNull() | F.col("keys").isNull(), F.array(F.lit("invalid_json"))).otherwise(out)


def levels(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From reference edges (call -> needs): (call, level) of the calls that
    can be ordered, and (call) of those on or behind a cycle."""
    left = materialize(edges.select("call", "needs").distinct(), "references")
    n, level, done = left.count(), 0, None
    while n:
        level += 1
        waiting = left.select(F.col("call").alias("needs")).distinct()
        rest = materialize(left.join(waiting, "needs", "left_semi").select("call", "needs"), "references")
        settled = left.join(rest.select("call").distinct(), "call", "left_anti").select("call").distinct().withColumn("level", F.lit(level))
        done = settled if done is None else done.unionAll(settled)
        m = rest.count()
        if m == n:
            break
        left, n = rest, m
    cyclic = left.select("call").distinct() if n else left.select("call").limit(0)
    return (done if done is not None else left.select("call", F.lit(0).alias("level")).limit(0)), cyclic


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call, and per result without one.

    ``calls`` has conv_id, turn, call_id, name, arguments (JSON); ``results``
    has conv_id, turn, call_id, content.  Returns conv_id, turn, call_id,
    name, status, errors, needs (ids referred to), level, position, n_results,
    json.
    """
    c = calls.select("conv_id", "turn", F.col("call_id").cast("string").alias("call_id"), F.col("name").cast("string").alias("name"),
                     F.col("arguments").cast("string").alias("arguments")).distinct()
    c = c.withColumn("v", F.try_parse_json("arguments")).withColumn("keys", F.when(F.col("v").isNotNull(), F.json_object_keys("arguments")))
    canonical = F.to_json("v")
    c = c.withColumns({"errors": _errors(schemas), "canonical": canonical, "needs": F.array_distinct(F.regexp_extract_all(F.coalesce(canonical, F.lit("")), F.lit(REFERENCE), F.lit(1)))})
    c = c.withColumn("call", F.xxhash64("conv_id", "call_id")).drop("v", "keys", "arguments")
    c = materialize(c, "calls")
    own = c.where("conv_id is not null and call_id is not null").groupBy("call").agg(F.count("*").alias("n_same"))
    wanted = c.where("conv_id is not null").select("call", F.explode("needs").alias("need")).join(c.select("call", "conv_id").distinct(), "call")
    edges = wanted.select("call", F.xxhash64("conv_id", "need").alias("needs"))
    known = edges.join(own.select(F.col("call").alias("needs")), "needs", "left_semi")
    order, cyclic = levels(known)
    lost = edges.join(own.select(F.col("call").alias("needs")), "needs", "left_anti").select("call").distinct().withColumn("lost", F.lit(True))
    r = results.select("conv_id", "turn", F.col("call_id").cast("string").alias("call_id"), F.col("content").cast("string").alias("content")).distinct()
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    unlinked = r.where(~has_id).select("conv_id", "call_id", F.struct("turn", "content").alias("r"), F.lit(1).cast("long").alias("n_results"))
    r = r.where(has_id).groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results")).unionByName(unlinked)
    named = ["conv_id", "call_id"]
    joined = (c.join(own, "call", "left").join(order, "call", "left").join(cyclic.withColumn("cyclic", F.lit(True)), "call", "left").join(lost, "call", "left")
              .withColumnRenamed("turn", "call_turn").join(r, named, "full"))
    is_call = F.col("canonical").isNotNull() | F.col("errors").isNotNull()
    level = F.when(is_call & F.col("cyclic").isNull(), F.coalesce("level", F.lit(0)))
    errors = F.concat(F.coalesce("errors", F.array().cast("array<string>")), F.when(F.col("lost"), F.array(F.lit("unknown_reference"))).otherwise(F.array().cast("array<string>")))
    status = (F.when(~is_call, "orphan_result").when(F.col("conv_id").isNull() | F.col("call_id").isNull(), "no_id").when(F.col("n_same") > 1, "duplicate_id")
              .when(F.col("cyclic"), "cyclic").when(F.size(errors) > 0, "invalid_arguments").when(F.col("r").isNull(), "no_result").otherwise("ok"))
    turn = F.coalesce("call_turn", F.col("r.turn"))
    out = joined.select("conv_id", turn.alias("turn"), "call_id", "name", status.alias("status"), errors.alias("errors"),
                        F.coalesce("needs", F.array().cast("array<string>")).alias("needs"), level.alias("level"), F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results"),
                        "canonical", F.col("r.content").alias("content"))
    # calls first, then cyclic ones, then orphans; in blocks of turns
    out = out.withColumn("_rank", F.when(F.col("status") == "orphan_result", 2).when(F.col("level").isNull(), 1).otherwise(0)).withColumn("_level", F.coalesce("level", F.lit(0)))
    out = out.withColumn("_block", F.floor(F.coalesce("turn", F.lit(0)) / TURNS))
    block = ["conv_id", "_rank", "_level", "_block"]
    counts = out.groupBy(*block).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_rank", "_level", "_block").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).select(F.col("conv_id").alias("_c"), "_rank", "_level", "_block", "_start")
    nth = F.row_number().over(Window.partitionBy(*block).orderBy("turn", "call_id", "name", "canonical", "content"))
    out = out.withColumn("_nth", nth)
    out = out.join(start.withColumnsRenamed({b: f"{b}2" for b in block[1:]}),
                   out["conv_id"].eqNullSafe(F.col("_c")) & (F.col("_rank") == F.col("_rank2")) & (F.col("_level") == F.col("_level2")) & (F.col("_block") == F.col("_block2")))
    quote = lambda x: F.to_json(F.array(x))
    text = lambda x: F.coalesce(F.substring(quote(x), 2, F.length(quote(x)) - 2), F.lit("null"))
    json = F.concat(F.lit('{"arguments":'), F.coalesce("canonical", F.lit("null")), F.lit(',"id":'), text(F.col("call_id")), F.lit(',"name":'), text(F.col("name")),
                    F.lit(',"result":'), text(F.col("content")), F.lit("}"))
    return out.select("conv_id", "turn", "call_id", "name", "status", "errors", "needs", "level",
                      (F.col("_start") + F.col("_nth") - 1).cast("long").alias("position"), "n_results", json.alias("json"))


#: Tools that the given conversations are read as calls of.
TOOLS: Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", True), "after": ("string", False)},
    "count": {"text": ("string", True), "words": ("integer", False), "after": ("string", False)},
    "quote": {"text": ("string", True), "exact": ("boolean", True), "after": ("string", False)},
}


def calls_of_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read from the turns of the given table.

    An assistant turn is a call: the tool follows from the text's checksum,
    its arguments hold the whole text, and two of three calls refer to the
    call two turns before.  Every other row, also one with a null role, is the
    result of the turn before it; where that is no call, or there is none, it
    is an orphan.  A null turn has no id: such a call is ``no_id``, such a
    result an orphan of its own.  Some calls break their schema on purpose of
    the data: a checksum divisible by 13 writes the number as text.
    """
    t = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    crc = F.crc32(F.col("text").cast("binary"))
    tool = F.element_at(F.array(*[F.lit(x) for x in TOOLS]), (F.pmod(crc, F.lit(len(TOOLS))) + 1).cast("int"))
    ident = lambda turn: F.when(turn.isNotNull(), F.concat_ws("_", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string")))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    number = F.when(F.pmod(crc, F.lit(13)) == 0, F.concat(F.lit('"'), words.cast("string"), F.lit('"'))).otherwise(words.cast("string"))
    quoted = F.to_json(F.array("text"))
    body = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    ref = F.when((F.col("turn") >= 2) & (F.pmod(F.floor(F.col("turn") / 2), F.lit(3)) > 0), F.concat(F.lit(',"after":{"$ref":"'), ident(F.col("turn") - 2), F.lit('"}'))).otherwise("")
    args = (F.when(F.col("name") == "search", F.concat(F.lit('{"query":'), body, F.lit(', "limit":'), number, ref, F.lit("}")))
            .when(F.col("name") == "count", F.concat(F.lit('{"words":'), number, F.lit(', "text":'), body, ref, F.lit("}")))
            .otherwise(F.concat(F.lit('{"text":'), body, F.lit(', "exact":'), F.when(F.pmod(crc, F.lit(2)) == 0, "true").otherwise("false"), ref, F.lit("}"))))
    calls = t.where("role = 'assistant'").withColumn("name", tool).select("conv_id", "turn", ident(F.col("turn")).alias("call_id"), "name", args.alias("arguments"))
    results = t.where("not role <=> 'assistant'").select("conv_id", "turn", ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
