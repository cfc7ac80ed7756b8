"""Connected components over DataFrames of edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.session import delete_table, materialize


def _both(e: DataFrame) -> DataFrame:
    return e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    n = _both(e)
    m = n.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return n.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    n = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = n.groupBy("u").agg(F.min("v").alias("m"))
    moved = n.join(m, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(m.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from each node of an edge.

    Alternates large-star and small-star steps until the edges are stars
    whose centre is the smallest node.  Every step is a grouped minimum (with
    partial aggregation) and an equi join and is written to the shared
    checkpoint folder (small-star reads its edges several times), and the
    driver sees two numbers a round.  A hub's edges are thin rows, and the
    joins are ones that adaptive execution may split.  ``edges`` has long
    columns ``u`` and ``v``.
    """
    e = materialize(edges.where("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        large = materialize(_large_star(e), "edges")
        e = materialize(_small_star(large), "edges")
        delete_table(large)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def named(nodes: DataFrame, comp: DataFrame, salts: int = 32) -> DataFrame:
    """(node, component_id): the smallest id of the nodes of each node's
    component, its own id for a node in none.

    ``nodes`` has node and id, ``comp`` is the result of ``components``.  A
    component of any size is dealt over ``salts`` keys.
    """
    members = materialize(comp.join(nodes.select("node", "id"), "node"), "members")
    ids = members.groupBy("component").agg(F.min("id").alias("component_id"))
    ids = ids.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    placed = members.withColumn("salt", F.pmod("node", F.lit(salts)).cast("int")).join(ids, ["component", "salt"]).select("node", "component_id")
    return nodes.join(placed, "node", "left").select("node", F.coalesce("component_id", "id").alias("component_id"))


def roots(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and columns of a link matrix the number of a node of their
    component (rows first); nodes without a link keep their own."""
    nx, ny = link.shape
    rx, ry, none = np.arange(nx), nx + np.arange(ny), nx + ny
    while True:
        x = np.minimum(rx, np.where(link, ry[None, :], none).min(1, initial=none))
        y = np.minimum(ry, np.where(link, x[:, None], none).min(0, initial=none))
        if (x == rx).all() and (y == ry).all():
            return rx, ry
        rx, ry = x, y
