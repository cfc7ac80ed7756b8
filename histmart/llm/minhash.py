"""MinHash near-dedup by bottom-k sketches (one hash function).

Each text becomes its set of hashed word shingles.  Texts with equal sets are
one node.  A node's sketch holds its k smallest hashes.  Inverted lists of the
retained values generate candidate pairs, the sketch of the union estimates
their similarity and drops the clearly unlike, and exact Jaccard on the full
sets decides every link.

Why no link is lost and no list explodes
----------------------------------------
* With Jaccard 0.8 each of the k smallest hashes of the union lies in both
  sets with probability 0.8.  Two sketches of 64 share fewer than 33 values
  with a probability of about 1e-7, and sketches of small sets are the sets.
* So a node needs to be listed only under its ``s - c + 1`` rarest values
  (s retained, c = 33 of 64 to be shared), in one global order: rarest
  first.  Values that very many documents retain (common passages, frequent
  words) fall out of the lists without any cap.
* In a list, the nodes of one size class are first compared with one hub.
  Whatever ends up in one component needs no further comparison, which settles
  large groups of near copies in linear work.  Then all pairs that lie in a
  common list but in different components are compared: short lists by a join,
  long ones block against block inside a task, which decides on the full sets
  and gives back one edge a node at most, never the pairs.

Nulls and empty texts have an empty set and link with nothing.  Repeated rows
and repeated ids are fine: nodes are sets, not rows.  A component is named by
its smallest id (null if it has none).  Node numbers are 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.llm import text as T
from histmart.llm.graph import components, named, roots
from histmart.llm.tables import release
from histmart.session import materialize, temporary_tables

SKETCH = 64
#: share of a sketch that two sketches of linked sets have in common, at least
SHARED = 33 / 64
#: longest list whose pairs are made by a join; longer ones go in blocks
LIST_JOIN = 64
#: nodes and shingles of a block
BLOCK = 256
BLOCK_SHINGLES = 1 << 16
#: allocation seeds of the two set fingerprints
_SIG1, _SIG2 = np.uint64(0xA5A5A5A55A5A5A5A), np.uint64(0x3C3C3C3CC3C3C3C3)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _sets(col: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for lo, hi, data, offsets in T.text_chunks(col):
        start, end, doc = T.words(data, offsets)
        doc, s = T.shingles(T.word_hashes(data, start, end), doc, hi - lo, k)
        u = s.view(np.uint64)
        node = T.mix(T.sum_by(doc, T.mix(u ^ _SIG1), hi - lo))
        sig = T.sum_by(doc, T.mix(u ^ _SIG2), hi - lo)
        yield lo, hi, doc, s, np.bincount(doc, minlength=hi - lo), node, sig


def _sketcher(shingle: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, doc, s, n, node, sig in _sets(b.column(1), shingle):
                first = np.cumsum(n) - n
                low = np.arange(len(s)) - first[doc] < k
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], pa.array(n, pa.int64()), _signed(node), _signed(sig), T.list_array(np.minimum(n, k), s[low])],
                    names=["doc_id", "n", "node", "sig", "sketch"])
    return run


def _full_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, _, s, n, node, _ in _sets(b.column(0), shingle):
                yield pa.RecordBatch.from_arrays([_signed(node), T.list_array(n, s)], names=["node", "members"])
    return run


def _member_rows(values: np.ndarray, lens: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """0/1 matrix: which of the columns (sorted values) each list holds."""
    out = np.zeros((len(lens), len(columns)), np.float32)
    if len(columns):
        at = np.minimum(np.searchsorted(columns, values), len(columns) - 1)
        held = columns[at] == values
        out[np.repeat(np.arange(len(lens)), lens)[held], at[held]] = 1
    return out


def _overlaps(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of two runs of lists, each (values, lengths)."""
    both = np.intersect1d(a[0], b[0])
    return _member_rows(*a, both) @ _member_rows(*b, both).T


def _part(lists: tuple[np.ndarray, np.ndarray], keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of the rows of a mask."""
    values, lens = lists
    return values[np.repeat(keep, lens)], lens[keep]


def _block_links(percent: int):
    """Links between two blocks of one list, as edges to one node of each
    component that they make.  A pair is looked at only in the least of the
    lists that both are in."""
    def lists(col: pa.Array, row: int) -> tuple[np.ndarray, np.ndarray]:
        nested = col[row].values
        return nested.flatten().to_numpy(zero_copy_only=False), np.diff(nested.offsets.to_numpy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                value = b.column(0)[row].as_py()
                node, comp, n, prefix, members = [], [], [], [], []
                for side in (0, 1):
                    c = [b.column(1 + 5 * side + i) for i in range(5)]
                    node.append(c[0][row].values.to_numpy())
                    comp.append(c[1][row].values.to_numpy())
                    n.append(c[2][row].values.to_numpy())
                    prefix.append(lists(c[3], row))
                    members.append(lists(c[4], row))
                small, large = np.minimum.outer(*n), np.maximum.outer(*n)
                ok = (comp[0][:, None] != comp[1][None, :]) & (100 * small >= percent * large)
                lower = [_part_values(x, value) for x in prefix]
                ok &= _overlaps(*lower) == 0
                if ok.any():  # the sketches are the lowest members
                    low = [_lowest(x, SKETCH) for x in members]
                    ok &= _overlaps(*low) >= np.floor(SHARED * np.maximum.outer(low[0][1], low[1][1]))
                x, y = ok.any(1), ok.any(0)
                inter = _overlaps(_part(members[0], x), _part(members[1], y))
                total = n[0][x][:, None] + n[1][y][None, :]
                link = ok[np.ix_(x, y)] & (100 * inter >= percent * (total - inter))
                rx, ry = roots(link)
                names = np.concatenate([node[0][x], node[1][y]])
                u, v = names, names[np.concatenate([rx, ry])]
                yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], names=["u", "v"])
    return run


def _part_values(lists: tuple[np.ndarray, np.ndarray], below: int) -> tuple[np.ndarray, np.ndarray]:
    """The values under a bound."""
    values, lens = lists
    keep = values < below
    of = np.repeat(np.arange(len(lens)), lens)
    return values[keep], np.bincount(of[keep], minlength=len(lens))


def _lowest(lists: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k values of every list."""
    values, lens = lists
    first = np.cumsum(lens) - lens
    keep = np.arange(len(values)) - np.repeat(first, lens) < k
    return values[keep], np.minimum(lens, k)


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidate pairs whose union sketch doesn't rule out the similarity."""
    a = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    return (pairs.join(a, "a").join(b, "b")
            .select("a", "b", union.alias("u"), F.array_intersect("sa", "sb").alias("i"))
            .where(F.size(F.array_intersect("u", "i")) >= F.floor(SHARED * F.size("u"))).select("a", "b"))


def _members(need: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, members): the full sets of the nodes in ``need``."""
    ids = need.join(nodes, "node").select(F.col("doc_id").alias("need_id")).distinct()
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["need_id"]), "left_semi").select("text")
    full = texts.mapInArrow(_full_sets(shingle), "node long, members array<long>")
    return materialize(full.join(need, "node", "left_semi").dropDuplicates(["node"]), "sets")


def _linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    pairs = materialize(pairs, "pairs")
    full = _members(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), nodes, docs, shingle)
    inter = F.size(F.array_intersect("ma", "mb"))
    return (pairs.join(full.select(F.col("node").alias("b"), F.col("members").alias("mb")), "b")
            .join(full.select(F.col("node").alias("a"), F.col("members").alias("ma")), "a")
            .select("a", "b", (F.size("ma") + F.size("mb")).alias("total"), inter.alias("i"))
            .where(f"100 * i >= {percent} * (total - i)")
            .select(F.col("a").alias("u"), F.col("b").alias("v")))


def _linked_in_blocks(hot: DataFrame, lists: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links within long lists (value, node, n, comp): every pair of blocks of
    a list is compared on the full sets inside a task, which returns at most
    one edge for each node of the two blocks."""
    need = hot.select("node").distinct()
    full = _members(need, nodes, docs, shingle)
    prefix = lists.join(need, "node", "left_semi").groupBy("node").agg(F.collect_list("value").alias("prefix"))  # SKETCH values at most
    cut = hot.groupBy("value").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    dealt = (hot.join(cut, "value").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
             .join(prefix, "node").join(full, "node"))
    blocks = dealt.groupBy("value", "block").agg(F.collect_list(F.struct("node", "comp", "n", "prefix", "members")).alias("x"))
    blocks = materialize(blocks.select("value", "block", *[F.col(f"x.{c}").alias(c) for c in ("node", "comp", "n", "prefix", "members")]), "blocks")
    pairs = (cut.select("value", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("i"))
             .select("value", "i", F.explode(F.sequence("i", F.col("blocks") - 1)).alias("j")))
    side = lambda name, at: blocks.select("value", F.col("block").alias(at), *[F.col(c).alias(f"{c}_{name}") for c in ("node", "comp", "n", "prefix", "members")])
    work = pairs.join(side("a", "i"), ["value", "i"]).join(side("b", "j"), ["value", "j"]).drop("i", "j")
    cols = [f"{c}_{s}" for s in ("a", "b") for c in ("node", "comp", "n", "prefix", "members")]
    return work.select("value", *cols).mapInArrow(_block_links(percent), "u long, v long")


def minhash_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Documents whose sets of distinct ``shingle``-word shingles (ASCII
    lower-cased, split at ASCII white space) have 100 * intersection >=
    percent * union are linked; component_id is the smallest id reachable,
    kept marks the document that carries it.  Of several rows with that id
    all are kept: they are told apart by nothing else here.
    """
    if not 80 <= percent <= 100:
        raise ValueError("the bound on shared sketch values holds for similarities from 0.8 to 1")
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with temporary_tables(docs.sparkSession):
        found = materialize(_classes(docs, shingle, percent), "near-dups", keep=True)
    return found.withColumnRenamed("doc_id", id_col)


def _classes(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    sets = materialize(docs.mapInArrow(_sketcher(shingle, SKETCH), "doc_id long, n long, node long, sig long, sketch array<long>"), "sketches")
    nodes = materialize(sets.where("n > 0").groupBy("node", "n").agg(F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch")), "nodes")

    # the rarest-first prefix of every sketch
    posts = nodes.select("node", "n", F.explode("sketch").alias("value"))
    common = posts.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared_posts = posts.join(common, "value").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("l"))  # at most SKETCH values
    s = F.least(F.col("n"), F.lit(SKETCH))
    listed = s - F.floor(SHARED * s) + 1 - (s - F.size("l"))  # values with df 1 come first and list nothing
    lists = shared_posts.select("node", "n", F.explode(F.slice("l", 1, F.greatest(listed, F.lit(0)).cast("int"))["value"]).alias("value"))
    lists = materialize(lists.withColumn("class", F.floor(F.ln("n") / math.log(1.25))), "lists")

    # first a hub for each list and size class
    hubs = lists.groupBy("value", "class").agg(F.min("node").alias("hub"), F.count("*").alias("m")).where("m > 1").drop("m")
    stars = lists.join(hubs, ["value", "class"]).where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    links = materialize(_linked(_alike(_pairs(stars), nodes), nodes, docs, shingle, percent), "links")
    release(docs.sparkSession)
    comp = materialize(components(links), "components")

    # then what is left: pairs of one list in different components
    placed = lists.drop("class").join(comp, "node", "left").select("value", "node", "n", F.coalesce("component", "node").alias("comp"))
    open_lists = placed.groupBy("value").agg(F.count("*").alias("m"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("value", "m")
    rest = materialize(placed.join(open_lists, "value"), "rest")
    short = rest.where(f"m <= {LIST_JOIN}").drop("m")
    right = short.select("value", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"))
    few = (short.withColumnsRenamed({"node": "a", "n": "na", "comp": "ca"}).join(right, "value")
           .where(f"a < b and ca <> cb and 100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b"))
    more = _linked(_alike(_pairs(few), nodes), nodes, docs, shingle, percent)
    hot = rest.where(f"m > {LIST_JOIN}").drop("m")
    stars = comp.select(F.col("node").alias("u"), F.col("component").alias("v"))
    comp = components(stars.unionAll(more).unionAll(_linked_in_blocks(hot, lists, nodes, docs, shingle, percent)))

    ids = named(nodes.select("node", F.col("doc_id").alias("id")), comp)
    out = sets.select("doc_id", "n", "node").join(ids, "node", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
