"""Lookups: point-in-time (as-of), code tables, calendar, current version,
exists flags, ranked person match, semi/anti splits.

No side is hinted: the planner's broadcast decision is checked against
``spark.sql.autoBroadcastJoinThreshold`` from statistics and re-checked by
AQE at run time; above it Catalyst falls back to a shuffled join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def asof_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                ts: str, eff: str = "effective_date", end: str = "end_date",
                how: str = "inner", strategy: str = "join",
                dim_cols: Sequence[str] | None = None) -> DataFrame:
    """Attach the dimension version in force at ``ts``: ``eff <= ts < end``.

    ``strategy='join'``: equi hash join on the business key with the range as
    residual (versions per key are few); AQE's skew join splits a hot key on
    the fact side.  ``strategy='carry'``: for keys with very long version
    lists - the version in force is resolved once per (key, fact day) by a
    carry-forward over day-level rows, then equi-joined back to the facts on
    (key, day): no row multiplication, and versions are day-granular.  It takes
    the latest started version, so it needs versions that don't overlap; the
    caller chooses.
    """
    dim_cols = list(dim_cols) if dim_cols is not None else [
        c for c in dim.columns if c not in (dim_key,)]
    if strategy == "join":
        d = dim.select(F.col(dim_key).alias("__dk"), *[F.col(c) for c in dim_cols])
        t = F.col(ts).cast("date") if dict(fact.dtypes).get(ts) == "date" else F.col(ts)
        cond = ((F.col(fact_key) == F.col("__dk"))
                & (t >= F.col(eff)) & (F.to_date(t) < F.col(end)))
        return fact.join(d, cond, how).drop("__dk")
    if strategy == "carry":
        return _asof_carry(fact, dim, fact_key, dim_key, ts, eff, end, how, dim_cols)
    raise ValueError(f"unknown strategy {strategy}")


def _asof_carry(fact, dim, fact_key, dim_key, ts, eff, end, how, dim_cols):
    """Version in force per (key, fact day), found by carrying the last
    version start forward over day-level rows, then joined back to the facts
    on (key, day).  Both sides of the window are at most one row per key and
    day, so a hot key is bounded by its number of days."""
    payload = F.struct(*[F.col(c) for c in dim_cols])
    ptype = dim.select(payload.alias("p")).schema["p"].dataType
    days = (fact.select(F.col(fact_key).alias("__k"), F.to_date(F.col(ts)).alias("__d")).distinct()
                .select("__k", "__d", F.lit(1).alias("__side"), F.lit(None).cast(ptype).alias("__p")))
    starts = dim.select(F.col(dim_key).alias("__k"), F.to_date(F.col(eff)).alias("__d"), F.lit(0).alias("__side"),
                        payload.alias("__p"))
    w = (Window.partitionBy("__k").orderBy("__d", "__side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    resolved = (days.unionByName(starts).withColumn("__p", F.last("__p", ignorenulls=True).over(w))
                    .where(F.col("__side") == 1)
                    .where(F.col("__p").isNotNull() & (F.col("__d") < F.col(f"__p.{end}")))
                    .select(F.col("__k").alias("__rk"), F.col("__d").alias("__rd"), "__p"))
    j = fact.join(resolved, (F.col(fact_key) == F.col("__rk")) & (F.to_date(F.col(ts)) == F.col("__rd")), how)
    return j.select(*fact.columns, *[F.col(f"__p.{c}").alias(c) for c in dim_cols])


def asof_dual_key(fact: DataFrame, ref_col: str, ts: str, dim: DataFrame,
                  id_col: str, name_col: str, eff: str = "effective_date",
                  end: str = "end_date", id_width: int = 10,
                  dim_cols: Sequence[str] | None = None) -> DataFrame:
    """Point-in-time lookup by id *or* name.

    A reference of trimmed length ``id_width`` is an id, otherwise a name.
    The dimension is emitted twice, keyed once by id and once by name, and
    the fact side carries (kind, key): one equi join with the range as
    residual.  The fact side is scanned and shuffled once, and there is
    never an OR join condition (which would fall back to a nested loop).
    """
    trimmed = F.trim(F.col(ref_col))
    is_id = F.length(trimmed) == id_width
    f = fact.withColumns({
        "__kind": F.when(is_id, F.lit("id")).otherwise(F.lit("name")),
        "__key": F.when(is_id, trimmed.try_cast("long").cast("string")).otherwise(trimmed)})
    cols = list(dim_cols) if dim_cols is not None else [c for c in dim.columns]
    by_id = dim.select(F.lit("id").alias("__dkind"), F.col(id_col).cast("string").alias("__dk"), *cols)
    by_name = dim.select(F.lit("name").alias("__dkind"), F.col(name_col).cast("string").alias("__dk"), *cols)
    d = by_id.unionByName(by_name)
    t = F.col(ts)
    cond = ((F.col("__kind") == F.col("__dkind")) & (F.col("__key") == F.col("__dk"))
            & (t >= F.col(eff)) & (F.to_date(t) < F.col(end)))
    return f.join(d, cond, "inner").drop("__kind", "__key", "__dkind", "__dk")


def lookup_code(df: DataFrame, codes: DataFrame, left_on: str, right_on: str,
                how: str = "left") -> DataFrame:
    """Many-to-one code-table lookup; unmatched rows keep null attributes.

    Whether ``codes`` is broadcast is the planner's choice, by its size.
    """
    return df.join(codes, F.col(left_on) == codes[right_on], how).drop(codes[right_on])


def lookup_calendar(df: DataFrame, ts: str, dim_date: DataFrame, dim_time: DataFrame | None = None,
                    date_key: str = "sk_dateid", time_key: str = "sk_timeid",
                    date_value: str = "date_value", time_value: str = "time_value",
                    prefix: str = "") -> DataFrame:
    """Date part and time part of ``ts`` to calendar surrogate keys."""
    d = dim_date.select(F.col(date_value).alias("__dv"), F.col(date_key).alias(f"{prefix}{date_key}"))
    out = df.join(d, F.to_date(F.col(ts)) == F.col("__dv"), "left").drop("__dv")
    if dim_time is not None:
        t = dim_time.select(F.col(time_value).alias("__tv"), F.col(time_key).alias(f"{prefix}{time_key}"))
        out = out.join(t, F.date_format(F.col(ts), "HH:mm:ss") == F.col("__tv"),
                       "left").drop("__tv")
    return out


def lookup_current(df: DataFrame, dim: DataFrame, left_on: str, right_on: str,
                   cols: Sequence[str], current_col: str = "is_current",
                   how: str = "left") -> DataFrame:
    """Join to the current version only (J7); the filter is pushed to the scan."""
    d = dim.where(F.col(current_col)).select(F.col(right_on).alias("__rk"), *cols)
    return df.join(d, F.col(left_on) == F.col("__rk"), how).drop("__rk")


def exists_flag(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[Column, Column]],
                flag: str = "exists") -> DataFrame:
    """``flag`` is true when some right row matches on every pair, null-safe.

    The right side is reduced to distinct match keys first so the left row
    count is preserved; ``<=>`` still plans as an equi (hash) join.
    """
    names = [f"__m{i}" for i in range(len(pairs))]
    r = right.select(*[rc.alias(n) for (_, rc), n in zip(pairs, names)]).distinct() \
             .withColumn("__hit", F.lit(True))
    l = left.withColumns({f"__l{i}": lc for i, (lc, _) in enumerate(pairs)})
    cond = None
    for i, n in enumerate(names):
        c = F.col(f"__l{i}").eqNullSafe(r[n])
        cond = c if cond is None else cond & c
    out = l.join(r, cond, "left").withColumn(flag, F.col("__hit").isNotNull())
    return out.drop("__hit", *names, *[f"__l{i}" for i in range(len(pairs))])


def match_person(people: DataFrame, candidates: DataFrame, pairs: Sequence[tuple[str, str]],
                 cand_id: str, priority: str, out_col: str = "match_id") -> DataFrame:
    """Ranked null-safe match on several upper-cased fields.

    ``candidates`` carries ``priority``; the highest priority wins and the
    candidate id breaks ties (last hit wins).  Output: ``people`` plus
    ``out_col`` (null when no candidate matches).  The candidate side is
    reduced to one winner per match key with a partial aggregate before the
    join, so a popular name cannot fan out the join.
    """
    keys = [f"__k{i}" for i in range(len(pairs))]
    cand = candidates.select(*[F.upper(F.col(rc)).alias(k) for (_, rc), k in zip(pairs, keys)],
                             F.col(cand_id).alias("__cid"), F.col(priority).alias("__pri"))
    best = cand.groupBy(*keys).agg(
        F.max_by("__cid", F.struct("__pri", "__cid")).alias(out_col))
    best = best.select(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)], out_col)
    p = people.withColumns({k: F.upper(F.col(lc)) for (lc, _), k in zip(pairs, keys)})
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"__b{i}"))
        cond = c if cond is None else cond & c
    return p.join(best, cond, "left").drop(*keys, *[f"__b{i}" for i in range(len(keys))])


def semi_anti(left: DataFrame, right: DataFrame, on) -> tuple[DataFrame, DataFrame]:
    """Split ``left`` into (keys absent from ``right``, keys present)."""
    on = _cols(on)
    return left.join(right.select(*on), on, "left_anti"), left.join(right.select(*on), on, "left_semi")
