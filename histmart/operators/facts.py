"""Fact-table operators: lifecycle collapse, running balance, rolling extremes,
trailing sums, range-join ratios, first/last non-null per column.

Every window here runs on a pre-aggregated input (one row per key and day or
key and quarter), so a hot key is bounded by its number of days, not by its
number of raw rows; the pre-aggregation is a partial (map-side) aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histmart.session import tasks_for


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def last_nonnull(df: DataFrame, key, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per key, the latest non-null value of each column (G5, pandas ``last``).

    ``max_by(c, when(c is not null, order))``: nulls are skipped column by
    column and the aggregate combines map-side.
    """
    key = _cols(key)
    o = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*key).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c) for c in cols])


def first_nonnull(df: DataFrame, key, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per key, the earliest non-null value of each column (G6, pandas ``first``)."""
    key = _cols(key)
    o = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*key).agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c) for c in cols])


def lifecycle_collapse(df: DataFrame, key, ts: str, status: str,
                       create_codes: Sequence[str], close_codes: Sequence[str],
                       order: Sequence[str] = ()) -> DataFrame:
    """History rows to one row per key with create and close stamps.

    create = the first row whose status is a create code; close = the last
    row whose status is a close code (null while open).
    """
    key = _cols(key)
    o = F.struct(F.col(ts), *[F.col(c) for c in order])
    is_create = F.col(status).isin(*create_codes)
    is_close = F.col(status).isin(*close_codes)
    return df.groupBy(*key).agg(
        F.min_by(F.col(ts), F.when(is_create, o)).alias("create_ts"),
        F.max_by(F.col(ts), F.when(is_close, o)).alias("close_ts"),
        F.max_by(F.col(status), o).alias("last_status"))


def daily_net(df: DataFrame, key, ts: str, amount: str, day_col: str = "day",
              amount_type: str = "decimal(18,2)") -> DataFrame:
    """Sum of ``amount`` per key and day (partial aggregate)."""
    key = _cols(key)
    return (df.groupBy(*key, F.to_date(F.col(ts)).alias(day_col))
              .agg(F.sum(F.col(amount).cast(amount_type)).cast("decimal(38,2)").alias("day_net")))


def running_balance(daily: DataFrame, key, day_col: str = "day", amount: str = "day_net",
                    out: str = "balance", opening: DataFrame | None = None,
                    opening_col: str = "opening") -> DataFrame:
    """Running sum per key in day order (W3, G12), plus an optional opening
    balance per key carried over from the previous batch (rule D8)."""
    key = _cols(key)
    w = (Window.partitionBy(*key).orderBy(day_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    res = daily.withColumn(out, F.sum(amount).over(w).cast("decimal(38,2)"))
    if opening is not None:
        res = (res.join(opening.select(*key, opening_col), key, "left")
                  .withColumn(out, (F.col(out) + F.coalesce(F.col(opening_col), F.lit(0)))
                              .cast("decimal(38,2)"))
                  .drop(opening_col))
    return res


def rolling_extremes(daily: DataFrame, key, day_col: str, high: str, low: str,
                     days: int = 365, prefix: str = "", tasks: int | None = None) -> DataFrame:
    """Rolling ``days``-day max of ``high`` and min of ``low``, with the latest
    date holding each extreme inside the frame (W4-W6, rule D13); null values
    hold none.

    Days are cut into blocks of ``days``, so the frame ``(day - days, day]`` is
    the end of one block and the start of the next.  The extreme over the
    start is a running one in day order.  That over the end is a running one
    in reverse order, read at the frame's first day: each row puts a question
    there, after the values of that day.  So a row costs two running windows,
    however many days a frame holds; both use one exchange by key, into
    ``tasks`` partitions (by default as many as the number of rows asks for).
    """
    key = _cols(key)
    tasks = tasks or tasks_for(daily)
    dn = F.unix_date(F.col(day_col))
    # latest of equal extremes: the larger day for a high, the smaller negative day for a low
    d = daily.repartition(tasks, *key).withColumns({
        "__dn": dn, "__block": F.floor(dn / days),
        "__h": F.when(F.col(high).isNotNull(), F.struct(F.col(high).alias("v"), F.col(day_col).alias("d"))),
        "__l": F.when(F.col(low).isNotNull(), F.struct(F.col(low).alias("v"), (-dn).alias("nd"), F.col(day_col).alias("d")))})
    start = Window.partitionBy(*key, "__block").orderBy("__dn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumns({"__hs": F.max("__h").over(start), "__ls": F.min("__l").over(start)})
    points = F.array(F.struct(F.lit(0).alias("ask"), F.col("__dn").alias("at")), F.struct(F.lit(1).alias("ask"), (F.col("__dn") - (days - 1)).alias("at")))
    d = d.withColumn("__p", F.explode(points)).withColumn("__of", F.floor(F.col("__p.at") / days))
    end = (Window.partitionBy(*key, "__of").orderBy(F.col("__p.at").desc(), F.col("__p.ask"))
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    value = F.col("__p.ask") == 0
    d = d.withColumns({"__he": F.max(F.when(value, F.col("__h"))).over(end), "__le": F.min(F.when(value, F.col("__l"))).over(end)})
    # a frame that fills its own block has no part in the one before
    before = F.col("__of") < F.col("__block")
    d = d.where(~value).withColumns({"__hi": F.greatest("__hs", F.when(before, F.col("__he"))), "__lo": F.least("__ls", F.when(before, F.col("__le")))})
    return d.select(*daily.columns, F.col("__hi.v").alias(f"{prefix}high_{days}"), F.col("__hi.d").alias(f"{prefix}high_{days}_date"),
                    F.col("__lo.v").alias(f"{prefix}low_{days}"), F.col("__lo.d").alias(f"{prefix}low_{days}_date"))


def trailing_sum(df: DataFrame, key, order: Sequence[str], value: str, rows: int = 4,
                 out: str = "trailing") -> DataFrame:
    """``SUM(value) OVER (PARTITION BY key ORDER BY order ROWS rows-1 PRECEDING)``."""
    key = _cols(key)
    w = Window.partitionBy(*key).orderBy(*[F.col(c) for c in order]).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, F.sum(value).over(w))


def quarter_start(c) -> Column:
    return F.trunc(F.col(c) if isinstance(c, str) else c, "quarter")


def prior_quarter_start(day) -> Column:
    """The unique quarter start q with ``day - 3 months <= q < day``.

    Turns the J11 range predicate into an equi-join key: same rows as the
    range join, but a plain hash join with no residual.
    """
    d = F.col(day) if isinstance(day, str) else day
    return F.trunc(F.date_sub(d, 1), "quarter")


def range_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               left_point: Column, right_start: str, right_end: str | None = None,
               how: str = "left") -> DataFrame:
    """Left rows to right rows of the same key whose start lies in a range
    ending at the point (J11 / J19 generic form): equi join on the key with
    the range as residual predicate, ``start <= point < end``."""
    cond = (F.col(left_key) == right[right_key]) & (right[right_start] <= left_point)
    if right_end is not None:
        cond = cond & (left_point < right[right_end])
    return left.join(right, cond, how)
