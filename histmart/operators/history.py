"""Type-2 history: version intervals, change detection, forward fill, merge.

Records are first reduced to one per key and day with a map-side aggregate;
every window after that is partitioned by the business key over day-level
rows, so a key holding a large share of the records costs its number of
days in one task, not its number of records.  Change detection and interval
closing share one hash partitioning and sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histmart.operators.keys import assign_keys
from histmart.session import materialize

END_OF_TIME = "9999-12-31"


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _eot() -> Column:
    return F.lit(END_OF_TIME).cast("date")


def _null_safe_differs(a: Column, b: Column) -> Column:
    """True when ``a`` and ``b`` differ, null equal to null (rule D11)."""
    return ~a.eqNullSafe(b)


def consolidate_day(df: DataFrame, key, eff: str, order: Sequence[str] = (),
                    day_col: str | None = None) -> DataFrame:
    """Keep the last record per key and calendar day of ``eff``.

    ``order`` breaks ties inside a timestamp; key + eff + order must be a total
    order.  A ``max_by`` aggregate per (key, day): it combines map-side, so a
    key holding a large share of the records is reduced before the shuffle,
    and every later key window sees at most one row per day.
    """
    key = _cols(key)
    rest = [c for c in df.columns if c not in key]
    ordering = F.struct(F.col(eff), *[F.col(c) for c in order])
    out = (df.groupBy(*key, F.to_date(F.col(eff)).alias("__day"))
             .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("__r"))
             .select(*key, "__r.*"))
    if day_col:
        out = out.withColumn(day_col, F.to_date(F.col(eff)))
    return out


def change_detect(df: DataFrame, key, order: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Rows whose ``attrs`` differ (null-safe) from the previous row of the key.

    The first row of each key always counts as a change.
    """
    key = _cols(key)
    w = Window.partitionBy(*key).orderBy(*[F.col(c) for c in order])
    cur = F.struct(*[F.col(a) for a in attrs])
    prev = F.lag(cur).over(w)
    return (df.withColumn("__prev", prev)
              .where(F.col("__prev").isNull() | _null_safe_differs(F.col("__prev"), cur))
              .drop("__prev"))


def scd2_intervals(df: DataFrame, key, eff: str, order: Sequence[str] = (),
                   attrs: Sequence[str] | None = None,
                   eff_col: str = "effective_date", end_col: str = "end_date",
                   current_col: str = "is_current", whole: bool = False) -> DataFrame:
    """Turn records of a business key into half-open versions.

    1. last record of each day wins (D15);
    2. with ``attrs``, a record only opens a version when it differs from the
       previous kept one (W2, null-safe);
    3. ``end`` is the next version's start, else 9999-12-31; current = open.

    ``whole`` says that a task may sort all records of a key (``whole_keys``).
    Without ``attrs`` the record after tells then whether one is the last of
    its day, and where its version ends: no aggregate, and the shuffle and
    sort are those of a ``carry_forward`` in the same order.
    """
    key = _cols(key)
    if whole and not attrs:
        day = F.to_date(F.col(eff))
        w = Window.partitionBy(*key).orderBy(eff, *order)
        # a struct: the day after may be null, as may be the whole record after
        out = df.withColumn("__next", F.lead(F.struct(day.alias("day"))).over(w))
        out = out.where(F.col("__next").isNull() | ~F.col("__next.day").eqNullSafe(day))
        out = out.withColumns({eff_col: day, end_col: F.coalesce("__next.day", _eot())}).drop("__next")
        out = out.select(*key, *[c for c in out.columns if c not in key])
        return out.withColumn(current_col, F.col(end_col) == _eot())
    out = consolidate_day(df, key, eff, order).withColumn(eff_col, F.to_date(F.col(eff)))
    if attrs:
        out = change_detect(out, key, [eff_col], attrs)
    w = Window.partitionBy(*key).orderBy(F.col(eff_col))
    out = out.withColumn(end_col, F.coalesce(F.lead(eff_col).over(w), _eot()))
    return out.withColumn(current_col, F.col(end_col) == _eot())


def _default_chunk(df: DataFrame, col: str) -> Column:
    """Day of a temporal ordering column, blocks of 4096 of an integral one."""
    t = dict(df.dtypes)[col]
    if t in ("date", "timestamp", "timestamp_ntz"):
        return F.to_date(F.col(col))
    if t in ("int", "bigint", "smallint", "tinyint"):
        return F.floor(F.col(col) / 4096).cast("long")
    return F.lit(0)


# rows of one key that a task sorts whole; keys with more are filled in chunks
HOT_ROWS = 100_000


def whole_keys(df: DataFrame, key, hot_rows: int = HOT_ROWS) -> bool:
    """True when every row of ``df`` has a key and no key more than ``hot_rows``
    rows, so that a task may sort all rows of a key.  A job of its own, which
    reads the key columns only."""
    key = _cols(key)
    unkeyed = F.lit(False)
    for k in key:
        unkeyed = unkeyed | F.col(k).isNull()
    n = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    return n.where(unkeyed | (F.col("__n") > hot_rows)).isEmpty()


def carry_forward(df: DataFrame, key, order: Sequence[str], cols: Sequence[str],
                  chunk: Column | None = None, hot_rows: int = HOT_ROWS, whole: bool | None = None) -> DataFrame:
    """Fill each column with the latest non-null value seen so far for the key.

    An absent field (null) takes the running state; an empty string is a value
    and is kept (W8).  Turn '' to null *after* this step when needed.

    If ``whole_keys`` (``whole``, if the caller has asked) rows take one
    shuffle and one window by key, which leaves them dealt and sorted by key
    for what follows.  Otherwise keys of at most ``hot_rows`` rows cost one
    shuffle and one sort.  Others
    take a segmented prefix scan in chunks (default: the day of a temporal
    first ordering column, or blocks of an integral one), so no task sorts all
    rows of a hot key:
    1. last non-null per (key, chunk) - a map-side aggregate;
    2. state before each chunk - a window over chunk-level rows per key;
    3. fill inside each (key, chunk), falling back to that state.
    Rows whose key is null have no key to share a state by: they are filled
    inside their chunk.
    """
    key = _cols(key)
    if whole_keys(df, key, hot_rows) if whole is None else whole:
        so_far = (Window.partitionBy(*key).orderBy(*[F.col(c) for c in order])
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(so_far) for c in cols})
    chunk = chunk if chunk is not None else _default_chunk(df, order[0])
    # at most one in hot_rows of the rows: bounded for a broadcast
    hot = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows) \
            .select(*[F.col(k).alias(f"__h_{k}") for k in key], F.lit(True).alias("__hot"))
    d = df.join(F.broadcast(hot), [F.col(k) == F.col(f"__h_{k}") for k in key], "left").drop(*[f"__h_{k}" for k in key])
    unkeyed = F.lit(False)
    for k in key:
        unkeyed = unkeyed | F.col(k).isNull()
    d = d.withColumn("__chunk", F.when(F.col("__hot") | unkeyed, chunk))
    o = F.struct(*[F.col(c) for c in order])
    per_chunk = d.where(F.col("__hot")).groupBy(*key, "__chunk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(f"__l_{c}") for c in cols])
    before = Window.partitionBy(*key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    state = per_chunk.select(*[F.col(k).alias(f"__k_{k}") for k in key], F.col("__chunk").alias("__c"),
                             *[F.last(f"__l_{c}", ignorenulls=True).over(before).alias(f"__p_{c}") for c in cols])
    on = [F.col(k) == F.col(f"__k_{k}") for k in key] + [F.col("__chunk") == F.col("__c")]
    j = d.join(state, on, "left")
    inside = (Window.partitionBy(*key, "__chunk").orderBy(*[F.col(c) for c in order])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    j = j.withColumns({c: F.coalesce(F.last(F.col(c), ignorenulls=True).over(inside), F.col(f"__p_{c}"))
                       for c in cols})
    return j.select(*df.columns)


def scd2_merge(current: DataFrame, changes: DataFrame, key, attrs: Sequence[str], eff: str, order: Sequence[str] = (),
               sk_col: str | None = "sk", highest: DataFrame | int = 0, eff_col: str = "effective_date",
               end_col: str = "end_date", current_col: str = "is_current", detect_changes: bool = True,
               stamp: dict[str, object] | None = None) -> DataFrame:
    """The current versions of a dimension after a change batch, and those
    that it closed (K4).  Versions closed before aren't looked at.

    Changes are reduced to the last of a key and day (a partial aggregate).
    They then meet the current versions in one window by key, over one row a
    key and day: a change on the start day of the current version takes its
    place and its surrogate (D15), so facts that point at it stay right; with
    ``detect_changes`` a row equal to the one before opens no version; each
    version ends where the next begins.  New versions get keys above
    ``highest`` (a number, or a one-row frame).  ``stamp`` gives columns of
    new versions that no change carries, such as the batch id.
    """
    key = _cols(key)
    stamp = stamp or {}
    chg = consolidate_day(changes.select(*key, *attrs, F.col(eff).alias("__eff"), *order), key, "__eff", order)
    others = [c for c in current.columns if c not in (*key, *attrs, eff_col, end_col, current_col)]
    types = current.schema
    new = chg.select(*key, *[F.col(c).cast(types[c].dataType).alias(c) for c in attrs], F.to_date("__eff").alias(eff_col), F.lit(1).alias("__src"),
                     *[F.lit(stamp.get(c)).cast(types[c].dataType).alias(c) for c in others])
    rows = current.select(*key, *attrs, eff_col, F.lit(0).alias("__src"), *others).unionByName(new)
    w = Window.partitionBy(*key).orderBy(eff_col, "__src")
    columns = {"__next": F.lead(eff_col).over(w)}
    if sk_col:
        columns[sk_col] = F.coalesce(F.col(sk_col), F.when(F.lag(eff_col).over(w) == F.col(eff_col), F.lag(sk_col).over(w)))
    rows = rows.withColumns(columns).where(F.col("__next").isNull() | (F.col("__next") != F.col(eff_col)))
    if detect_changes:
        rows = change_detect(rows, key, [eff_col], attrs)
    by_day = Window.partitionBy(*key).orderBy(eff_col)
    rows = rows.withColumn(end_col, F.coalesce(F.lead(eff_col).over(by_day), _eot()))
    rows = rows.withColumn(current_col, F.col(end_col) == _eot()).select(*current.columns)
    if not sk_col:
        return rows
    rows = materialize(rows, "versions")  # read for the versions that have a key and for those that get one
    fresh = assign_keys(rows.where(F.col(sk_col).isNull()).drop(sk_col), [*key, eff_col], sk_col,
                        **({"base_df": highest} if isinstance(highest, DataFrame) else {"base": highest}))
    return rows.where(F.col(sk_col).isNotNull()).unionByName(fresh.select(*current.columns))


def scd2_apply(target: DataFrame, changes: DataFrame, key, attrs: Sequence[str],
               eff: str, order: Sequence[str] = (), sk_col: str | None = "sk",
               current_col: str = "is_current", **options) -> DataFrame:
    """A whole versioned dimension after a change batch: ``scd2_merge`` of its
    current versions, with those closed before.  A table that is kept by
    batch (``sinks``) needs only the former."""
    closed = target.where(~F.col(current_col))
    highest = target.agg(F.coalesce(F.max(sk_col), F.lit(0))) if sk_col else 0
    merged = scd2_merge(target.where(F.col(current_col)), changes, key, attrs, eff, order, sk_col, highest, current_col=current_col, **options)
    return closed.unionByName(merged)


def cascade_versions(parent_versions: DataFrame, child_current: DataFrame,
                     parent_key: str, child_parent_key: str,
                     carry: Sequence[str] = (), parent_eff: str = "effective_date",
                     parent_sk: str = "sk", child_parent_sk: str = "parent_sk") -> DataFrame:
    """Each new parent version opens a new version of every open child (K8).

    The child's new version points at the *new* parent surrogate and takes
    the columns in ``carry`` (for instance status) from the new parent
    version (rule D16).  Equi join on the business key; the result feeds
    ``scd2_apply`` of the child dimension.
    """
    p = parent_versions.select(
        F.col(parent_key).alias("__pk"), F.col(parent_eff).alias("__peff"),
        F.col(parent_sk).alias("__psk"), *[F.col(c).alias(f"__p_{c}") for c in carry])
    joined = child_current.join(p, F.col(child_parent_key) == F.col("__pk"), "inner")
    return (joined
            .withColumn(child_parent_sk, F.col("__psk"))
            .withColumns({c: F.col(f"__p_{c}") for c in carry})
            .withColumn("cascade_eff", F.col("__peff"))
            .drop("__pk", "__peff", "__psk", *[f"__p_{c}" for c in carry]))
