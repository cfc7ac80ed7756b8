"""Embedding near-dedup: int8 tile products with rigorous error bounds.

Vectors of one label are compared tile by tile.  A unit vector u is kept as
int8 numbers q with a scale s; e = |u - s q| is its exact quantisation error.
For two of them  u.v <= s t (q.r) + |s q| f + e |t r| + e f  (e, f their
errors), and the integer product q.r comes exactly from a float32 product
(in slices of 1000 dimensions: 127 * 127 * 1000 < 2^24).  Only pairs whose
upper bound reaches the threshold are computed again in double precision from
the original numbers, and these decide.

Equal vectors of a label are one node with a count, so a large group of copies
costs one row; a tile pair gives back, for each of its nodes, the number of
linked vectors and one node of its component, never the pairs.  The work is
that of all pairs within a label, spread over (label, tile, tile).

Vectors that are null, zero or hold null or non-finite numbers, and those
with a null label, link with nothing, nor do vectors of different lengths.
Repeated rows are copies.  A component's name is its smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.llm.graph import components, named, roots
from histmart.session import materialize, temporary_tables

#: vectors of a tile, fewer for long ones: a tile holds at most 2 MB of doubles
TILE = 1024
TILE_NUMBERS = 1 << 18


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 numbers, scales, norms of the rounded vectors and errors; the last
    two are raised by more than double precision can lose."""
    s = np.abs(u).max(1) / 127
    q = np.rint(u / s[:, None]).astype(np.int8)
    r = q * s[:, None]
    up = 1 + 1e-12
    return q, s, np.linalg.norm(r, axis=1) * up, np.linalg.norm(u - r, axis=1) * up + 1e-15


def int_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of the rows of two int8 matrices."""
    total = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], 1000):
        total += a[:, k:k + 1000].astype(np.float32) @ b[:, k:k + 1000].astype(np.float32).T
    return total


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of a and b have a cosine of at least threshold."""
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    qa, sa, ha, ea = quantise(a / na[:, None])
    qb, sb, hb, eb = quantise(b / nb[:, None])
    upper = np.outer(sa, sb) * int_product(qa, qb) + np.outer(ha, eb) + np.outer(ea, hb) + np.outer(ea, eb)
    out = upper >= threshold - 1e-12
    x, y = np.nonzero(out)
    for k in range(0, len(x), 1 << 14):
        i, j = x[k:k + (1 << 14)], y[k:k + (1 << 14)]
        out[i, j] = np.einsum("ij,ij->i", a[i], b[j]) / (na[i] * nb[j]) >= threshold
    return out


def _pack(group: pa.Table) -> pa.Table:
    t = group.combine_chunks()
    full = np.array(t["vec"].to_pylist(), dtype=np.float64)
    full = np.ldexp(full, -np.frexp(np.abs(full).max(1))[1][:, None])  # exact; squares of very large or small numbers stay in range
    return pa.table({"label": t["label"][:1], "dims": t["dims"][:1], "tile": t["tile"][:1], "nodes": pa.array([t["node"].to_pylist()], pa.list_(pa.int64())),
                     "copies": pa.array([t["m"].to_pylist()], pa.list_(pa.int64())), "numbers": pa.array([full.tobytes()], pa.binary())})


def _compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                same, na, ca, xa, nb, cb, xb = (b.column(i)[r].as_py() for i in range(7))
                a = np.frombuffer(xa).reshape(len(na), -1)
                link = linked(a, a if same else np.frombuffer(xb).reshape(len(nb), -1), threshold)
                if same:
                    np.fill_diagonal(link, False)
                rx, ry = roots(link)
                names = np.array(na + nb, dtype=np.int64)
                x, y = np.flatnonzero(link.any(1)), np.flatnonzero(link.any(0))
                node, links, root = names[x], (link @ np.array(cb, dtype=np.float64))[x], names[rx[x]]
                if not same:
                    node, links, root = np.append(node, names[len(na) + y]), np.append(links, (link.T @ np.array(ca, dtype=np.float64))[y]), np.append(root, names[ry[y]])
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(links.astype(np.int64)), pa.array(root, pa.int64())], names=["node", "links", "root"])
    return run


def vector_dedup(embeddings: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    with temporary_tables(embeddings.sparkSession):
        found = materialize(_links(embeddings, threshold, id_col, vector_col, label_col), "vector-dups", keep=True)
    return found


def _links(embeddings: DataFrame, threshold: float, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"), F.col(label_col).cast("string").alias("label"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("node", F.when(F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)), F.xxhash64("label", "vec")))
    nodes = rows.where("node is not null").groupBy("label", "vec").agg(F.first("node").alias("node"), F.min("id").alias("id"), F.count("*").alias("m"))
    nodes = materialize(nodes.withColumn("dims", F.size("vec")), "vectors")
    sizes = nodes.groupBy("label", "dims").agg(F.count("*").alias("n"))
    per = F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_NUMBERS) / F.col("dims"))))
    sizes = materialize(sizes.withColumn("tiles", F.ceil(F.col("n") / per)), "labels")
    tiles = nodes.join(sizes.select("label", "dims", "tiles"), ["label", "dims"]).withColumn("tile", F.pmod("node", "tiles"))
    tiles = materialize(tiles.select("label", "dims", "tile", "node", "m", "vec").groupBy("label", "dims", "tile").applyInArrow(
        _pack, "label string, dims int, tile long, nodes array<long>, copies array<long>, numbers binary"), "tiles")
    pairs = (sizes.select("label", "dims", "tiles", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("i"))
             .select("label", "dims", "i", F.explode(F.sequence("i", F.col("tiles") - 1)).alias("j")))
    a = tiles.select("label", "dims", F.col("tile").alias("i"), F.col("nodes").alias("na"), F.col("copies").alias("ca"), F.col("numbers").alias("xa"))
    b = tiles.select("label", "dims", F.col("tile").alias("j"), F.col("nodes").alias("nb"), F.col("copies").alias("cb"), F.col("numbers").alias("xb"))
    work = pairs.join(b, ["label", "dims", "j"]).join(a, ["label", "dims", "i"]).select((F.col("i") == F.col("j")).alias("same"), "na", "ca", "xa", "nb", "cb", "xb")
    found = materialize(work.mapInArrow(_compare(threshold), "node long, links long, root long"), "links")
    comp = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    info = (nodes.select("node", "m").join(named(nodes.select("node", "id"), comp), "node")
            .join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left"))
    out = rows.select("id", "node").join(info.select("node", "component_id", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
