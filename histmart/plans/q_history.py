"""History-core driver queries on orders / lineitem / customer / events.

Versioned dimension used throughout: key ``o_custkey``, attribute
``o_orderpriority``, effective ``o_orderdate``, last order of a day by
``o_orderkey`` (SURVEY 7.3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histmart.operators import history as H
from histmart.operators.keys import assign_keys
from histmart.operators.lookup import asof_lookup
from histmart.plans.registry import query, table

SPLIT_DATE = "2000-01-01"

# --- shared SQL fragments (DuckDB twins) ------------------------------------

_REC_SQL = """
rec AS (
  SELECT o_custkey, o_orderpriority, o_orderkey, CAST(o_orderdate AS DATE) AS d,
         LEAD(CAST(o_orderdate AS DATE)) OVER (
           PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nd
  FROM orders),
dl AS (SELECT o_custkey, o_orderpriority, o_orderkey, d FROM rec WHERE nd IS NULL OR nd > d)"""

_VER_SQL = _REC_SQL + """,
ch AS (SELECT *, LAG(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY d) AS pp FROM dl),
cv AS (SELECT o_custkey, o_orderpriority, d AS effective_date FROM ch
       WHERE pp IS DISTINCT FROM o_orderpriority),
ver AS (SELECT *, COALESCE(LEAD(effective_date) OVER (PARTITION BY o_custkey
                  ORDER BY effective_date), DATE '9999-12-31') AS end_date FROM cv)"""


def priority_versions(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None,
                      ) -> DataFrame:
    """Customer priority versions (consolidated per day, change-detected)."""
    o = orders if orders is not None else table(spark, sf_dir, "orders")
    o = o.select("o_custkey", "o_orderpriority", "o_orderkey",
                 F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    v = H.scd2_intervals(o, "o_custkey", "o_orderdate", order=["o_orderkey"],
                         attrs=["o_orderpriority"])
    return v.select("o_custkey", "o_orderpriority", "effective_date", "end_date", "is_current")


# --- W1: version intervals ----------------------------------------------------

@query("scd2_intervals", "WITH " + _REC_SQL + """
SELECT o_custkey, o_orderpriority, o_orderkey, d AS effective_date,
       COALESCE(LEAD(d) OVER (PARTITION BY o_custkey ORDER BY d), DATE '9999-12-31') AS end_date,
       LEAD(d) OVER (PARTITION BY o_custkey ORDER BY d) IS NULL AS is_current
FROM dl""")
def q_scd2_intervals(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderkey",
        F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    v = H.scd2_intervals(o, "o_custkey", "o_orderdate", order=["o_orderkey"])
    return v.select("o_custkey", "o_orderpriority", "o_orderkey", "effective_date", "end_date",
                    "is_current")


# --- W2: change detection -----------------------------------------------------

@query("change_detect", "WITH " + _VER_SQL + """
SELECT o_custkey, o_orderpriority, effective_date, end_date,
       end_date = DATE '9999-12-31' AS is_current FROM ver""")
def q_change_detect(spark, sf_dir):
    return priority_versions(spark, sf_dir)


# --- J4: point-in-time lookup; flagship --------------------------------------

_ASOF_LINES_SQL = """
lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_custkey,
         CAST(l.l_shipdate AS DATE) AS ship_date,
         CAST(l.l_extendedprice AS DECIMAL(15,2)) AS price,
         CAST(l.l_discount AS DECIMAL(15,2)) AS disc
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
hit AS (
  SELECT lines.*, ver.o_orderpriority, ver.effective_date
  FROM lines JOIN ver ON lines.o_custkey = ver.o_custkey
   AND lines.ship_date >= ver.effective_date AND lines.ship_date < ver.end_date)"""


def _lines(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey",
                      F.col("l_shipdate").cast("date").alias("ship_date"),
                      # compact decimals: price x (1 - disc) is decimal(18,4), so it
                      # stays in 64-bit arithmetic instead of BigDecimal per row
                      F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
                      F.col("l_discount").cast("decimal(4,2)").alias("disc")))


def asof_revenue(spark: SparkSession, sf_dir: str, strategy: str = "join") -> DataFrame:
    """Flagship: priority in force for the customer on each ship date, and
    the revenue that fell under each priority."""
    hit = asof_lookup(_lines(spark, sf_dir), priority_versions(spark, sf_dir),
                      "o_custkey", "o_custkey", "ship_date", strategy=strategy,
                      dim_cols=["o_orderpriority", "effective_date", "end_date"])
    return hit.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.col("price") * (F.lit(1) - F.col("disc"))).cast("decimal(38,4)").alias("revenue"),
        F.countDistinct("o_custkey").alias("customers"))


@query("asof_revenue", "WITH " + _VER_SQL + "," + _ASOF_LINES_SQL + """
SELECT o_orderpriority, count(*) AS line_count,
       CAST(sum(price * (1 - disc)) AS DECIMAL(38,4)) AS revenue,
       count(DISTINCT o_custkey) AS customers
FROM hit GROUP BY o_orderpriority""")
def q_asof_revenue(spark, sf_dir):
    return asof_revenue(spark, sf_dir)


@query("asof_lookup", "WITH " + _VER_SQL + "," + _ASOF_LINES_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, ship_date, o_orderpriority, effective_date
FROM hit""")
def q_asof_lookup(spark, sf_dir):
    hit = asof_lookup(_lines(spark, sf_dir), priority_versions(spark, sf_dir),
                      "o_custkey", "o_custkey", "ship_date",
                      dim_cols=["o_orderpriority", "effective_date", "end_date"])
    return hit.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "ship_date",
                      "o_orderpriority", "effective_date")


@query("asof_lookup_carry", "WITH " + _VER_SQL + "," + _ASOF_LINES_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, ship_date, o_orderpriority, effective_date
FROM hit""")
def q_asof_lookup_carry(spark, sf_dir):
    """Same lookup through the sort-and-carry strategy (long version lists)."""
    hit = asof_lookup(_lines(spark, sf_dir), priority_versions(spark, sf_dir),
                      "o_custkey", "o_custkey", "ship_date", strategy="carry",
                      dim_cols=["o_orderpriority", "effective_date", "end_date"])
    return hit.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "ship_date",
                      "o_orderpriority", "effective_date")


# --- W8: forward fill -------------------------------------------------------

@query("carry_forward", """
WITH e AS (
  SELECT event_id, user_id, ts,
         CASE WHEN event_id % 3 = 0 THEN CAST(value AS DECIMAL(12,2)) END AS value,
         CASE WHEN event_id % 2 = 0 THEN event_type END AS event_type
  FROM events)
SELECT event_id, user_id,
  last_value(value IGNORE NULLS) OVER w AS value,
  last_value(event_type IGNORE NULLS) OVER w AS event_type
FROM e
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_carry_forward(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_id") % 3 == 0, F.col("value").cast("decimal(12,2)")).alias("value"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("event_type"))
    f = H.carry_forward(e, "user_id", ["ts", "event_id"], ["value", "event_type"])
    return f.select("event_id", "user_id", "value", "event_type")


# --- W9: dense keys ---------------------------------------------------------

@query("assign_keys", """
SELECT c_custkey, c_nationkey,
       row_number() OVER (ORDER BY c_nationkey, c_custkey) AS sk
FROM customer""")
def q_assign_keys(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return assign_keys(c, ["c_nationkey", "c_custkey"], "sk")


# --- K4: merge a change batch by rewrite --------------------------------------

@query("scd2_apply", "WITH " + _VER_SQL + f""",
k AS (
  SELECT ver.*, CASE WHEN effective_date < DATE '{SPLIT_DATE}' THEN 0 ELSE 1 END AS batch,
         row_number() OVER (PARTITION BY effective_date >= DATE '{SPLIT_DATE}'
                            ORDER BY o_custkey, effective_date) AS rn
  FROM ver)
SELECT o_custkey, o_orderpriority, effective_date, end_date,
       end_date = DATE '9999-12-31' AS is_current,
       CAST(CASE WHEN batch = 0 THEN rn
            ELSE rn + (SELECT count(*) FROM k WHERE batch = 0) END AS BIGINT) AS sk
FROM k""")
def q_scd2_apply(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    base_o = o.where(F.col("o_orderdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz"))
    chg_o = o.where(F.col("o_orderdate") >= F.lit(SPLIT_DATE).cast("timestamp_ntz"))
    base = assign_keys(priority_versions(spark, sf_dir, base_o), ["o_custkey", "effective_date"], "sk")
    changes = chg_o.select("o_custkey", "o_orderpriority", "o_orderkey",
                           F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    return H.scd2_apply(base, changes, "o_custkey", ["o_orderpriority"], "o_orderdate",
                        order=["o_orderkey"], sk_col="sk")


# --- K8: cascade of new parent versions to open children ----------------------

@query("cascade_versions", "WITH " + _VER_SQL + f""",
k AS (
  SELECT ver.*, row_number() OVER (PARTITION BY effective_date >= DATE '{SPLIT_DATE}'
                                   ORDER BY o_custkey, effective_date) AS rn,
         effective_date >= DATE '{SPLIT_DATE}' AS is_new FROM ver),
base_n AS (SELECT count(*) AS n FROM k WHERE NOT is_new),
acct AS (SELECT c_custkey, c_custkey * 2 + a AS account_id
         FROM customer, (VALUES (0), (1)) t(a))
SELECT acct.account_id, acct.c_custkey,
       CAST(k.rn + base_n.n AS BIGINT) AS customer_sk,
       k.o_orderpriority AS status, k.effective_date AS cascade_eff
FROM k JOIN acct ON k.o_custkey = acct.c_custkey, base_n
WHERE k.is_new""")
def q_cascade_versions(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    split = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    base = assign_keys(priority_versions(spark, sf_dir, o.where(F.col("o_orderdate") < split)),
                       ["o_custkey", "effective_date"], "sk")
    changes = o.where(F.col("o_orderdate") >= split).select(
        "o_custkey", "o_orderpriority", "o_orderkey",
        F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    merged = H.scd2_apply(base, changes, "o_custkey", ["o_orderpriority"], "o_orderdate",
                          order=["o_orderkey"], sk_col="sk")
    new_versions = merged.where(F.col("effective_date") >= F.lit(SPLIT_DATE).cast("date"))
    accounts = (table(spark, sf_dir, "customer")
                .select("c_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("a"))
                .select("c_custkey", (F.col("c_custkey") * 2 + F.col("a")).alias("account_id")))
    out = H.cascade_versions(new_versions, accounts, "o_custkey", "c_custkey",
                             carry=["o_orderpriority"], parent_sk="sk",
                             child_parent_sk="customer_sk")
    return out.select("account_id", "c_custkey", "customer_sk",
                      F.col("o_orderpriority").alias("status"), "cascade_eff")


# --- Q4: interval checks ------------------------------------------------------

@query("interval_align", "WITH " + _VER_SQL + """
SELECT CAST(count(*) AS BIGINT) AS versions,
       CAST((SELECT count(*) FROM ver a JOIN ver b
             ON a.o_custkey = b.o_custkey AND a.end_date = b.effective_date) AS BIGINT) AS aligned,
       CAST(sum(CASE WHEN end_date = DATE '9999-12-31' THEN 1 ELSE 0 END) AS BIGINT) AS open_versions
FROM ver""")
def q_interval_align(spark, sf_dir):
    """Versions whose end is the next version's start, via ``lead`` (no self join)."""
    v = priority_versions(spark, sf_dir)
    w = Window.partitionBy("o_custkey").orderBy("effective_date")
    v = v.withColumn("__next", F.lead("effective_date").over(w))
    return v.agg(F.count(F.lit(1)).alias("versions"),
                 F.count_if(F.col("end_date") == F.col("__next")).alias("aligned"),
                 F.count_if(F.col("is_current")).alias("open_versions"))


@query("interval_overlap", """
WITH iv AS (
  SELECT o.o_custkey, o.o_orderkey, CAST(o.o_orderdate AS DATE) AS s,
         CAST(max(l.l_shipdate) AS DATE) AS e
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, o.o_orderkey, o.o_orderdate)
SELECT a.o_custkey, CAST(count(*) AS BIGINT) AS overlapping
FROM iv a
WHERE EXISTS (SELECT 1 FROM iv b WHERE b.o_custkey = a.o_custkey
              AND (b.s < a.s OR (b.s = a.s AND b.o_orderkey < a.o_orderkey))
              AND b.e > a.s)
GROUP BY a.o_custkey""")
def q_interval_overlap(spark, sf_dir):
    """Intervals [order date, last ship date) overlapping an earlier interval of
    the same customer: running max of earlier ends (per start day, then
    within the day), not a theta self join."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    iv = (li.groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("e"))
            .join(o, F.col("l_orderkey") == o.o_orderkey)
            .select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("s"), "e"))
    # latest end among intervals that start on earlier days: a running max
    # over one row per (customer, start day)
    per_day = iv.groupBy("o_custkey", F.col("s").alias("__d")).agg(F.max("e").alias("__de"))
    earlier_days = Window.partitionBy("o_custkey").orderBy("__d").rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_day.select(F.col("o_custkey").alias("__c"), "__d",
                             F.max("__de").over(earlier_days).alias("__prev_days"))
    # earlier intervals of the same start day, by order key
    same_day = Window.partitionBy("o_custkey", "s").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, -1)
    j = iv.join(per_day, (F.col("o_custkey") == F.col("__c")) & (F.col("s") == F.col("__d")), "left")
    prev_end = F.greatest(F.col("__prev_days"), F.max("e").over(same_day))
    flagged = j.withColumn("__prev_end", prev_end).where(F.col("__prev_end") > F.col("s"))
    return flagged.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("overlapping"))


@query("interval_flags", "WITH " + _VER_SQL + """
, per_key AS (
  SELECT o_custkey,
         sum(CASE WHEN end_date = DATE '9999-12-31' THEN 1 ELSE 0 END) AS n_current,
         max(end_date) AS last_end,
         sum(CASE WHEN effective_date >= end_date THEN 1 ELSE 0 END) AS n_empty
  FROM ver GROUP BY o_custkey)
SELECT CAST(count(*) AS BIGINT) AS keys,
       CAST(sum(CASE WHEN n_current <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS bad_current,
       CAST(sum(CASE WHEN last_end <> DATE '9999-12-31' THEN 1 ELSE 0 END) AS BIGINT) AS bad_end_of_time,
       CAST(sum(n_empty) AS BIGINT) AS empty_intervals
FROM per_key""")
def q_interval_flags(spark, sf_dir):
    v = priority_versions(spark, sf_dir)
    per_key = v.groupBy("o_custkey").agg(
        F.count_if(F.col("is_current")).alias("n_current"),
        F.max("end_date").alias("last_end"),
        F.count_if(F.col("effective_date") >= F.col("end_date")).alias("n_empty"))
    eot = F.lit(H.END_OF_TIME).cast("date")
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("n_current") != 1).alias("bad_current"),
        F.count_if(F.col("last_end") != eot).alias("bad_end_of_time"),
        F.sum("n_empty").cast("bigint").alias("empty_intervals"))
