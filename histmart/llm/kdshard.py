"""Sharding by a k-d tree: recursive splits at distributed weighted medians.

Points are distinct texts (all copies of a text stay together); their weight
is the bytes of all copies, their coordinates are metadata: the ranks of
source and language among all values of theirs (of the copies' first in
order), and the logarithm of the length.  A text whose copies hold more than
a twentieth of a shard's bytes, so that shards couldn't come within a few
percent of each other with it whole, is cut into pieces, which are points of
their own.  Rows get numbers of their own first and are dealt to pieces, and
to the buckets in which slots are counted, by them: null and repeated ids
are no different from others.  A node is split along its widest
dimension (in parts of the root's extent) at the weighted median, or at the
quantile that its number of leaves asks for; ties in that dimension are
broken by a hash of the text, so a split comes as near to the wanted bytes as
the largest point allows.

A median is found by histograms: 4096 bins over the key range of every node,
a grouped sum for all nodes at once, then again within the bin that holds the
median.  The driver sees one row for each node, at most as many as shards.
Every level's nodes are written with the points: a node's number refers to its
parent's several times over, so a plan over all levels would grow by a factor
with each of them, and with it the driver's memory.

Null texts have no bytes, null sources and languages come first in their
dimension, repeated rows are copies like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histmart.llm.tables import release
from histmart.operators.keys import assign_keys
from histmart.session import materialize, temporary_tables

PIECES = 256
#: copies of a text that hold more than 1 / GIANT of a shard's bytes may be parted
GIANT = 20
BINS = 4096
#: a bin that holds less than this share of its node ends the search
TOLERANCE = 0.0005
DIMS = ("_d0", "_d1", "_d2")
_SCALE = (1 << 30) - 1


def _ranks(rows: DataFrame) -> DataFrame:
    """(_dim, _value, _rank): the values of both string columns, numbered in
    order, nulls first; one dimension's follow the other's."""
    values = rows.select(F.explode(F.array(F.struct(F.lit(0).alias("_dim"), F.col("_src").alias("_value")),
                                           F.struct(F.lit(1).alias("_dim"), F.col("_lang").alias("_value")))).alias("x")).select("x.*").distinct()
    return assign_keys(values, ["_dim", "_value"], "_rank")


def _pick(values: list, at: Column, kind: str) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (at + 1).cast("int"))


def numbered(df: DataFrame, group: str, by: str, out: str, buckets: int) -> DataFrame:
    """Adds ``out``: 0, 1, ... without gaps within each group.

    Rows are numbered in buckets of a group, to which the rows of earlier
    buckets are added, so a group of any size is no single task's.
    """
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(by), F.lit(buckets)))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = df.groupBy(group, "_bucket").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    nth = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(by))
    return df.withColumn("_nth", nth).join(start, [group, "_bucket"]).withColumn(out, F.col("_start") + F.col("_nth") - 1).drop("_bucket", "_nth", "_start")


def _points(rows: DataFrame, n_shards: int) -> tuple[DataFrame, int]:
    pieces = rows.groupBy("_h", "_salt").agg(F.sum("_size").alias("w"), F.count("*").alias("n"), F.max("_size").alias("size"),
                                             F.min("_src").alias("src"), F.min("_lang").alias("lang"))
    pieces = materialize(pieces, "kd-pieces")
    groups = pieces.groupBy("_h").agg(F.sum("w").alias("gw"), F.sum("n").alias("gn"), F.min("src").alias("x0"), F.min("lang").alias("x1"), F.max("size").alias("gs"))
    ranks = _ranks(rows)
    for dim in (0, 1):
        of = ranks.where(F.col("_dim") == dim).select("_value", F.col("_rank").cast("double").alias("_rank"))
        groups = groups.join(of, F.col(f"x{dim}").eqNullSafe(F.col("_value"))).withColumn(f"x{dim}", F.col("_rank")).drop("_value", "_rank")
    total, count = pieces.agg(F.sum("w"), F.sum("n")).first()
    giant = (F.col("gw") > (total or 0) / (GIANT * n_shards)) & (F.col("gn") > 1)
    p = pieces.join(groups, "_h").select(
        "_h", "_salt", "w", F.col("x0"), F.col("x1"), F.ln(F.col("gs").cast("double")).alias("x2"),
        F.shiftrightunsigned(F.when(giant, F.xxhash64("_h", "_salt")).otherwise(F.xxhash64("_h")), 32).alias("_tie"))
    p = materialize(p, "kd-points")
    ends = p.agg(*[f(f"x{i}") for i in range(3) for f in (F.min, F.max)]).first()
    for i, d in enumerate(DIMS):
        lo, hi = ends[2 * i] or 0.0, ends[2 * i + 1] or 0.0
        p = p.withColumn(d, F.floor((F.col(f"x{i}") - lo) / (hi - lo) * _SCALE) if hi > lo else F.lit(0).cast("long"))
    return p.select("_h", "_salt", "w", *DIMS, "_tie"), count or 0


def _cuts(p: DataFrame, wanted: list[float], dims: list[int]) -> list[int]:
    """For each node the key up to which its first child goes."""
    k = len(wanted)
    key = _pick([0] * k, F.col("_node"), "long")
    for i, d in enumerate(DIMS):
        key = F.when(_pick(dims, F.col("_node"), "int") == i, F.shiftleft(F.col(d), 32) + F.col("_tie")).otherwise(key)
    q = p.select("_node", "w", key.alias("key"))
    lo, hi, below = [0] * k, [1 << 62] * k, [0.0] * k
    cut, open_ = [(1 << 62)] * k, [x > 0 for x in wanted]
    while any(open_):
        step = [max(1, -(-(h - a) // BINS)) for a, h in zip(lo, hi, strict=True)]
        inside = q.where((F.col("key") >= _pick(lo, F.col("_node"), "long")) & (F.col("key") < _pick(hi, F.col("_node"), "long")) & _pick(open_, F.col("_node"), "boolean"))
        bins = inside.groupBy("_node", F.floor((F.col("key") - _pick(lo, F.col("_node"), "long")) / _pick(step, F.col("_node"), "long")).alias("bin")).agg(
            F.sum("w").alias("w"), F.min("key").alias("k0"), F.max("key").alias("k1"))
        run = Window.partitionBy("_node").orderBy("bin")
        bins = bins.withColumn("up_to", F.sum("w").over(run)).withColumn("last", F.lead("bin").over(run).isNull())
        need = _pick([x - b for x, b in zip(wanted, below, strict=True)], F.col("_node"), "double")
        hit = bins.where((F.col("up_to") >= need) | F.col("last")).groupBy("_node").agg(F.min(F.struct("bin", "w", "up_to", "k0", "k1")).alias("b"))
        seen = set()
        for r in hit.collect():  # a row for each node
            j, b = r["_node"], r["b"]
            seen.add(j)
            before, within = below[j] + float(b["up_to"] - b["w"]), float(b["w"])
            if b["k0"] == b["k1"] or within <= TOLERANCE * wanted[j]:
                near = wanted[j] - before > within / 2
                cut[j], open_[j] = (b["k1"] if near else b["k0"] - 1), False
            else:
                lo[j], hi[j], below[j] = b["k0"], b["k1"] + 1, before
        for j in range(k):
            if open_[j] and j not in seen:  # a node without points
                open_[j] = False
    return cut


def _kd_tree(rows: DataFrame, n_shards: int) -> tuple[DataFrame, int]:
    points, count = _points(rows, n_shards)
    release(rows.sparkSession)
    p = points.withColumn("_node", F.lit(0))
    leaves = [n_shards]
    while max(leaves) > 1:
        k = len(leaves)
        stats = {r["_node"]: r for r in p.groupBy("_node").agg(F.sum("w").alias("w"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMS]).collect()}
        dims = [max(range(3), key=lambda i: (stats[j][DIMS[i]], -i)) if j in stats else 0 for j in range(k)]
        wanted = [float(stats[j]["w"]) * (m // 2) / m if j in stats and m > 1 else 0.0 for j, m in enumerate(leaves)]
        cuts = _cuts(p, wanted, dims)
        first, children = [], []
        for m in leaves:
            first.append(len(children))
            children += [m // 2, m - m // 2] if m > 1 else [m]
        key = F.lit(0).cast("long")
        for i, d in enumerate(DIMS):
            key = F.when(_pick(dims, F.col("_node"), "int") == i, F.shiftleft(F.col(d), 32) + F.col("_tie")).otherwise(key)
        second = (key > _pick(cuts, F.col("_node"), "long")) & _pick([m > 1 for m in leaves], F.col("_node"), "boolean")
        p = p.withColumn("_node", (_pick(first, F.col("_node"), "int") + second.cast("int")).cast("int"))
        leaves = children
        if max(leaves) > 1:
            p = materialize(p, "kd-level")
        release(p.sparkSession)
    return p.select("_h", "_salt", F.col("_node").alias("shard")), count


def kd_shards(documents: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", lang_col: str = "lang", target_bytes: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """The documents with their size (UTF-8 bytes + 1), shard and slot.

    ``target_bytes``, if given, sets the number of leaves in place of
    ``n_shards``.  Slots run from 0 without gaps in each shard.  Columns of
    these names in ``documents`` are replaced.  ``columns`` are those to give
    back, by default all: they are written once, with the rows' numbers.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keep = [c for c in (documents.columns if columns is None else columns) if c not in ("size", "shard", "slot")]
    rows = documents.select(*[F.col(c) for c in keep], F.xxhash64(body).alias("_h"), (F.octet_length(body) + 1).cast("long").alias("_size"),
                            F.col(source_col).cast("string").alias("_src"), F.col(lang_col).cast("string").alias("_lang"),
                            F.monotonically_increasing_id().alias("_row"))
    with temporary_tables(documents.sparkSession):
        rows = materialize(rows.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(PIECES))), "kd-rows", keep=True)
        if target_bytes:
            n_shards = max(1, -(-(rows.agg(F.sum("_size")).first()[0] or 0) // target_bytes))
        shards, count = _kd_tree(rows.select("_h", "_salt", "_size", "_src", "_lang"), n_shards)
        shards = materialize(shards, "kd-shards", keep=True)
    # slots are counted on thin rows, so texts are shuffled once
    placed = numbered(rows.select("_row", "_h", "_salt").join(shards, ["_h", "_salt"]).select("_row", "shard"), "shard", "_row", "slot", max(1, -(-count // 50_000)))
    return rows.join(placed, "_row").select(*[F.col(f"`{c}`") for c in keep], F.col("_size").alias("size"), "shard", "slot")
