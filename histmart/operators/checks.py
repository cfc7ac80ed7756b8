"""Audit check framework: every check is a DataFrame of
``(test, batch_id, result, description)``; a suite is their union, sorted
by test and batch only when reported.

Checks are aggregates (counts, count-distinct, conditional counts) or
anti-joins, so each one is a single pass with a map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHECK_COLUMNS = ("test", "batch_id", "result", "description")


def verdict(ok: Column) -> Column:
    return F.when(ok, F.lit("OK")).otherwise(F.lit("Not OK"))


def check_frame(df: DataFrame, test: str, batch: Column, ok: Column, description: str) -> DataFrame:
    return df.select(F.lit(test).alias("test"), batch.cast("int").alias("batch_id"),
                     verdict(ok).alias("result"), F.lit(description).alias("description"))


def keys_unique(df: DataFrame, test: str, key: Sequence[str], batch: Column | None = None) -> DataFrame:
    """Q2: count = count(distinct key), per batch when ``batch`` is given."""
    g = df.groupBy(batch.alias("__b")) if batch is not None else df.groupBy(F.lit(None).alias("__b"))
    agg = g.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(*key).alias("nd"))
    return check_frame(agg, test, F.col("__b"), F.col("n") == F.col("nd"), "Keys are unique")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Q6: child rows whose non-null reference has no parent (left anti join)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return child.where(F.col(child_key).isNotNull()).join(p, F.col(child_key) == F.col("__pk"), "left_anti")


def reference_report(tables: dict[str, DataFrame], edges: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Q6 for any number of edges ``(child, column, parent, parent_key)`` in one
    grouped count: (child, column, parent, refs, orphans), a row an edge.

    Each table is read once and gives its parent keys and its non-null
    references, tagged with the key space they belong to; references of one
    key are counted before the only shuffle, so a hot key is one row a task.
    Keys are integers.  Null references count as none; empty tables give zeros.
    """
    spaces = list(dict.fromkeys((parent, key) for _, _, parent, key in edges))
    place, taken = {}, dict.fromkeys(spaces, 0)  # edge -> (key space, place among the edges into it)
    for child, column, parent, key in edges:
        place[child, column, parent] = spaces.index((parent, key)), taken[parent, key]
        taken[parent, key] += 1
    width, is_key = max(taken.values()), -1

    def tagged(space: int, slot: int, key: Column) -> Column:
        return F.struct(F.lit(space).alias("space"), F.lit(slot).alias("slot"), key.cast("long").alias("key"))

    parts: dict[str, list[Column]] = {}
    for i, (parent, key) in enumerate(spaces):
        parts.setdefault(parent, []).append(tagged(i, is_key, F.col(key)))
    for child, column, parent, _ in edges:
        parts.setdefault(child, []).append(tagged(*place[child, column, parent], F.col(column)))
    spark = tables[edges[0][0]].sparkSession
    # a row for each key space, so that edges between empty tables are reported as well
    keys = spark.range(len(spaces)).select(F.col("id").cast("int").alias("space"), F.lit(is_key).alias("slot"), F.lit(None).cast("long").alias("key"))
    for name, entries in parts.items():
        e = tables[name].select(F.explode(F.array(*entries)).alias("e")).select("e.*")
        keys = keys.unionByName(e.where(F.col("key").isNotNull()))
    counts = keys.groupBy("space", "key").agg(
        F.max(F.col("slot") == is_key).alias("known"), *[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(width)])
    sums = counts.groupBy("space").agg(
        *[F.sum(f"n{i}").alias(f"refs{i}") for i in range(width)],
        *[F.sum(F.when(F.col("known"), 0).otherwise(F.col(f"n{i}"))).alias(f"orphans{i}") for i in range(width)])
    rows = []
    for child, column, parent, _ in edges:
        space, slot = place[child, column, parent]
        rows.append(F.struct(F.lit(space).alias("of"), F.lit(child).alias("child"), F.lit(column).alias("column"), F.lit(parent).alias("parent"),
                             F.col(f"refs{slot}").alias("refs"), F.col(f"orphans{slot}").alias("orphans")))
    return sums.select("space", F.explode(F.array(*rows)).alias("r")).where(F.col("space") == F.col("r.of")).select(
        "r.child", "r.column", "r.parent", "r.refs", "r.orphans")


def count_violations(df: DataFrame, checks: dict[str, Column], batch: Column | None = None) -> DataFrame:
    """Q5/Q8: ``count_if(not predicate)`` for each named predicate, one pass."""
    g = df.groupBy(batch.alias("batch_id")) if batch is not None else df.groupBy(
        F.lit(None).cast("int").alias("batch_id"))
    agg = g.agg(F.count(F.lit(1)).alias("rows"),
                *[F.count_if(~F.coalesce(p, F.lit(False))).alias(n) for n, p in checks.items()])
    stack = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations"))
                                for n in checks]))
    return agg.select("batch_id", "rows", stack.alias("s")).select("batch_id", "s.check", "rows", "s.violations")


def interval_report(versions: DataFrame, key: Sequence[str], eff: str = "effective_date",
                    end: str = "end_date", current: str = "is_current") -> DataFrame:
    """Q4 in one pass of ``lead``: misaligned ends, overlaps, empty intervals,
    wrong current flags and keys not reaching end of time."""
    w = Window.partitionBy(*key).orderBy(eff)
    nxt = F.lead(eff).over(w)
    v = versions.withColumn("__next", nxt)
    eot = F.lit("9999-12-31").cast("date")
    return v.agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(F.col("__next").isNotNull() & (F.col(end) != F.col("__next"))).alias("misaligned"),
        F.count_if(F.col("__next").isNotNull() & (F.col(end) > F.col("__next"))).alias("overlapping"),
        F.count_if(F.col(eff) >= F.col(end)).alias("empty"),
        F.count_if(F.col(current) != (F.col(end) == eot)).alias("bad_current"),
        F.count_if(F.col("__next").isNull() & (F.col(end) != eot)).alias("not_reaching_end"))
