"""Join and lookup driver queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from histmart.operators import lookup as L
from histmart.plans.q_history import _VER_SQL, priority_versions
from histmart.plans.registry import query, table

SPLIT_DATE = "2000-01-01"


def _name_no(c):
    """Number part of ``Customer#000000017`` style names, as text."""
    return F.regexp_extract(F.col(c), r"#(\d+)", 1)


# --- J1 inner equi join -----------------------------------------------------

@query("join_inner", """
SELECT o.o_orderstatus, l.l_returnflag, count(*) AS line_count,
       CAST(sum(CAST(l.l_quantity AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderstatus, l.l_returnflag""")
def q_join_inner(spark, sf_dir):
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
              .groupBy("o_orderstatus", "l_returnflag")
              .agg(F.count(F.lit(1)).alias("line_count"),
                   F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("decimal(38,2)")
                   .alias("quantity")))


# --- J2 code lookup -------------------------------------------------------------

@query("lookup_code", """
SELECT c.c_custkey, n.n_name, r.r_name, s.n_name AS size_code_name
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN nation s ON CAST(c.c_custkey % 40 AS INTEGER) = s.n_nationkey""")
def q_lookup_code(spark, sf_dir):
    """Many-to-one lookups into bounded code tables; a code outside the table
    (custkey mod 40 >= 25) leaves the attribute null."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", (F.col("c_custkey") % 40).cast("int").alias("size_code"))
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    out = L.lookup_code(c, n.select("n_nationkey", "n_name", "n_regionkey"), "c_nationkey", "n_nationkey")
    out = L.lookup_code(out, r, "n_regionkey", "r_regionkey")
    out = L.lookup_code(out, n.select(F.col("n_nationkey").alias("code"),
                                      F.col("n_name").alias("size_code_name")), "size_code", "code")
    return out.select("c_custkey", "n_name", "r_name", "size_code_name")


# --- J3 calendar lookup -------------------------------------------------------

def dim_date(spark, sf_dir):
    """Calendar rows for the span of the events, built with ``sequence``."""
    ev = table(spark, sf_dir, "events")
    span = ev.agg(F.min(F.col("ts").cast("date")).alias("lo"), F.max(F.col("ts").cast("date")).alias("hi"))
    return (span.select(F.explode(F.sequence("lo", "hi")).alias("date_value"))
                .select(F.date_format("date_value", "yyyyMMdd").cast("int").alias("sk_dateid"),
                        "date_value"))


def dim_time(spark):
    """One row per second of the day (bounded domain: 86 400 rows)."""
    return spark.range(0, 86400).select(
        F.col("id").cast("int").alias("sk_timeid"),
        F.format_string("%02d:%02d:%02d", (F.col("id") / 3600).cast("int"),
                        ((F.col("id") % 3600) / 60).cast("int"), (F.col("id") % 60).cast("int"))
        .alias("time_value"))


@query("lookup_calendar", """
WITH d AS (
  SELECT CAST(strftime(x, '%Y%m%d') AS INTEGER) AS sk_dateid, CAST(x AS DATE) AS date_value
  FROM (SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)),
                                      INTERVAL 1 DAY)) AS x FROM events)),
t AS (
  SELECT CAST(i AS INTEGER) AS sk_timeid,
         lpad(CAST(i // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST((i % 3600) // 60 AS VARCHAR), 2, '0')
           || ':' || lpad(CAST(i % 60 AS VARCHAR), 2, '0') AS time_value
  FROM range(0, 86400) r(i))
SELECT e.event_id, d.sk_dateid, t.sk_timeid
FROM events e
LEFT JOIN d ON CAST(e.ts AS DATE) = d.date_value
LEFT JOIN t ON strftime(e.ts, '%H:%M:%S') = t.time_value""")
def q_lookup_calendar(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    out = L.lookup_calendar(ev, "ts", dim_date(spark, sf_dir), dim_time(spark))
    return out.select("event_id", "sk_dateid", "sk_timeid")


# --- J4/J6 point-in-time by id or name -------------------------------------

@query("asof_dual_key", "WITH " + _VER_SQL + """,
cust AS (SELECT c_custkey, c_name FROM customer),
dimv AS (SELECT ver.*, cust.c_name FROM ver JOIN cust ON ver.o_custkey = cust.c_custkey),
f AS (
  SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) AS ship_date,
         CASE WHEN l.l_linenumber % 2 = 0 THEN lpad(CAST(o.o_custkey AS VARCHAR), 10, '0')
              ELSE c.c_name END AS ref
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey)
SELECT f.l_orderkey, f.l_linenumber, f.ref, dimv.o_custkey, dimv.o_orderpriority
FROM f JOIN dimv
  ON ((length(trim(f.ref)) = 10 AND TRY_CAST(trim(f.ref) AS BIGINT) = dimv.o_custkey)
      OR (length(trim(f.ref)) <> 10 AND trim(f.ref) = dimv.c_name))
 AND f.ship_date >= dimv.effective_date AND f.ship_date < dimv.end_date""")
def q_asof_dual_key(spark, sf_dir):
    """Half the line items name their customer by a 10-digit id, half by name
    (by line-number parity); each resolves to the version at its ship date."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("cust"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    f = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("cust") == c.c_custkey)
           .select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date"),
                   F.when(F.col("l_linenumber") % 2 == 0,
                          F.lpad(F.col("cust").cast("string"), 10, "0"))
                    .otherwise(F.col("c_name")).alias("ref")))
    dimv = priority_versions(spark, sf_dir).join(c, F.col("o_custkey") == c.c_custkey).drop("c_custkey")
    out = L.asof_dual_key(f, "ref", "ship_date", dimv, "o_custkey", "c_name",
                          dim_cols=["o_custkey", "o_orderpriority", "effective_date", "end_date"])
    return out.select("l_orderkey", "l_linenumber", "ref", "o_custkey", "o_orderpriority")


# --- J7 current-version lookup ---------------------------------------------

@query("lookup_current", "WITH " + _VER_SQL + """
SELECT o.o_orderkey, o.o_custkey, ver.o_orderpriority AS current_priority
FROM orders o LEFT JOIN ver ON o.o_custkey = ver.o_custkey AND ver.end_date = DATE '9999-12-31'""")
def q_lookup_current(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    v = priority_versions(spark, sf_dir).withColumnRenamed("o_orderpriority", "current_priority")
    return L.lookup_current(o, v, "o_custkey", "o_custkey", ["current_priority"])


# --- J8 exists flag, null-safe -------------------------------------------------

_PERSON_SQL = """
c AS (SELECT c_custkey, regexp_extract(c_name, '#(\\d+)', 1) AS no,
             CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS nat,
             CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE CAST(floor(c_acctbal / 2000) AS BIGINT) END AS band
      FROM customer),
s AS (SELECT s_suppkey, regexp_extract(s_name, '#(\\d+)', 1) AS no,
             CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_nationkey END AS nat,
             CASE WHEN s_suppkey % 3 = 1 THEN NULL ELSE CAST(floor(s_acctbal / 2000) AS BIGINT) END AS band
      FROM supplier)"""


def _people(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", _name_no("c_name").alias("no"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("nat"),
        F.when(F.col("c_custkey") % 3 == 1, F.lit(None))
         .otherwise(F.floor(F.col("c_acctbal") / 2000).cast("bigint")).alias("band"))
    s = table(spark, sf_dir, "supplier").select(
        "s_suppkey", _name_no("s_name").alias("no"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit(None)).otherwise(F.col("s_nationkey")).alias("nat"),
        F.when(F.col("s_suppkey") % 3 == 1, F.lit(None))
         .otherwise(F.floor(F.col("s_acctbal") / 2000).cast("bigint")).alias("band"))
    return c, s


@query("exists_flag", "WITH " + _PERSON_SQL + """
SELECT c.c_custkey,
       EXISTS (SELECT 1 FROM s WHERE s.nat IS NOT DISTINCT FROM c.nat
               AND s.band IS NOT DISTINCT FROM c.band) AS is_supplier_like
FROM c""")
def q_exists_flag(spark, sf_dir):
    """Customer flagged when some supplier has the same nation and balance
    band, null equal to null (the is-customer flag pattern)."""
    c, s = _people(spark, sf_dir)
    out = L.exists_flag(c, s, [(c["nat"], s["nat"]), (c["band"], s["band"])], flag="is_supplier_like")
    return out.select("c_custkey", "is_supplier_like")


# --- J10 ranked person match ------------------------------------------------

@query("match_person", "WITH " + _PERSON_SQL + """,
cand AS (SELECT s_suppkey AS cid, nat, band, CASE WHEN s_suppkey % 2 = 0 THEN 2 ELSE 1 END AS pri
         FROM s),
best AS (SELECT nat, band, arg_max(cid, pri * 100000000 + cid) AS match_id
         FROM cand GROUP BY nat, band)
SELECT c.c_custkey, best.match_id
FROM c LEFT JOIN best ON c.nat IS NOT DISTINCT FROM best.nat
                     AND c.band IS NOT DISTINCT FROM best.band""")
def q_match_person(spark, sf_dir):
    """Customers matched to suppliers on (nation, band), null-safe; even
    suppliers play the current batch (higher priority), highest id wins."""
    c, s = _people(spark, sf_dir)
    cand = s.select(F.col("s_suppkey").alias("cid"), "nat", "band",
                    F.when(F.col("s_suppkey") % 2 == 0, 2).otherwise(1).alias("pri"))
    out = L.match_person(c, cand, [("nat", "nat"), ("band", "band")], "cid", "pri")
    return out.select("c_custkey", "match_id")


# --- J9 semi / anti split -----------------------------------------------------

@query("semi_anti", f"""
WITH late AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT_DATE}'),
early AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT_DATE}')
SELECT o_custkey, 'new' AS side FROM late WHERE o_custkey NOT IN (SELECT o_custkey FROM early)
UNION ALL
SELECT o_custkey, 'existing' AS side FROM late WHERE o_custkey IN (SELECT o_custkey FROM early)""")
def q_semi_anti(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    split = F.lit(SPLIT_DATE).cast("timestamp_ntz")
    late = o.where(F.col("o_orderdate") >= split).select("o_custkey").distinct()
    early = o.where(F.col("o_orderdate") < split).select("o_custkey").distinct()
    new, existing = L.semi_anti(late, early, "o_custkey")
    return (new.withColumn("side", F.lit("new"))
               .unionByName(existing.withColumn("side", F.lit("existing"))))


# --- J11 range left join and W7 trailing four quarters are in q_facts ---------

# --- J12 right join ---------------------------------------------------------------

@query("join_right", """
WITH fin AS (
  SELECT l_suppkey, date_trunc('quarter', l_shipdate) AS q, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS revenue
  FROM lineitem GROUP BY ALL),
quarters AS (SELECT s_suppkey, q FROM supplier, (SELECT DISTINCT date_trunc('quarter', l_shipdate) AS q FROM lineitem))
SELECT s.s_suppkey, CAST(s.q AS DATE) AS quarter_start, fin.revenue FROM fin RIGHT JOIN quarters s ON fin.l_suppkey = s.s_suppkey AND fin.q = s.q""")
def q_join_right(spark, sf_dir):
    """Revenue of every supplier in every quarter, null where it sold nothing."""
    q = F.trunc("l_shipdate", "quarter")
    li = table(spark, sf_dir, "lineitem").withColumn("quarter_start", q)
    fin = li.groupBy("l_suppkey", "quarter_start").agg(F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).cast("decimal(38,2)").alias("revenue"))
    # the quarters of the time span, one row each
    span = li.agg(F.sort_array(F.collect_set("quarter_start")).alias("quarters"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(span.scalar()).alias("q"))
    return (fin.join(s, (fin.l_suppkey == s.s_suppkey) & (fin.quarter_start == s.q), "right")
               .select("s_suppkey", F.col("q").alias("quarter_start"), "revenue"))


# --- J13 fact enrich --------------------------------------------------------

@query("join_enrich", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey,
       CAST(o.o_orderdate AS DATE) AS trade_date,
       CAST(o.o_totalprice AS DECIMAL(15,2)) AS trade_price,
       CAST(l.l_quantity AS INTEGER) AS qty
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_join_enrich(spark, sf_dir):
    """Holdings-style enrichment: every line item takes its trade's keys and price."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey",
        F.col("o_orderdate").cast("date").alias("trade_date"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("trade_price"),
        F.col("l_quantity").cast("int").alias("qty"))


# --- J14 star join counts --------------------------------------------------------

@query("star_counts", """
SELECT 'lineitem_star' AS fact, count(*) AS n
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
UNION ALL
SELECT 'orders_star', count(*) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT 'supplier_star', count(*) FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT 'events_star', count(*) FROM events e JOIN customer c ON e.user_id = c.c_custkey""")
def q_star_counts(spark, sf_dir):
    t = {n: table(spark, sf_dir, n) for n in
         ("lineitem", "orders", "customer", "nation", "region", "part", "supplier", "events")}
    nat_reg = t["nation"].join(F.broadcast(t["region"]), F.col("n_regionkey") == F.col("r_regionkey"))
    cust = t["customer"].join(F.broadcast(nat_reg), F.col("c_nationkey") == F.col("n_nationkey"))
    orders_star = t["orders"].join(cust, F.col("o_custkey") == F.col("c_custkey"))
    line_star = (t["lineitem"].join(orders_star, F.col("l_orderkey") == F.col("o_orderkey"))
                 .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
                 .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")))
    supp_star = t["supplier"].join(F.broadcast(nat_reg), F.col("s_nationkey") == F.col("n_nationkey"))
    ev_star = t["events"].join(t["customer"], F.col("user_id") == F.col("c_custkey"))

    def cnt(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("fact"), "n")
    return (cnt(line_star, "lineitem_star").unionByName(cnt(orders_star, "orders_star"))
            .unionByName(cnt(supp_star, "supplier_star")).unionByName(cnt(ev_star, "events_star")))


# --- J15 scalar joined to every row -----------------------------------------

@query("cross_scalar", """
WITH per_year AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS batch_id, count(*) AS n
                  FROM orders GROUP BY 1)
SELECT batch_id, n, (SELECT max(CAST(year(o_orderdate) AS INTEGER)) FROM orders) AS last_batch,
       batch_id = (SELECT max(CAST(year(o_orderdate) AS INTEGER)) FROM orders) AS is_last
FROM per_year""")
def q_cross_scalar(spark, sf_dir):
    """Per-batch counts with the highest batch id attached: a scalar subquery
    (computed once, shipped as a value), not a cross join."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("int").alias("batch_id"))
    last = o.agg(F.max("batch_id")).scalar()
    return (o.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("last_batch", last).withColumn("is_last", F.col("batch_id") == last))


# --- J18 same name, different id ---------------------------------------------

@query("duplicate_names", """
SELECT a.p_name, CAST(count(DISTINCT a.p_partkey) AS BIGINT) AS ids
FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_partkey <> b.p_partkey
GROUP BY a.p_name""")
def q_duplicate_names(spark, sf_dir):
    """Names held by several ids: a distinct count per name, not a theta self join."""
    p = table(spark, sf_dir, "part")
    return (p.groupBy("p_name").agg(F.countDistinct("p_partkey").alias("ids"))
             .where(F.col("ids") > 1))


# --- J19 containment counts -------------------------------------------------------

@query("contain_counts", "WITH " + _VER_SQL + """
, lines AS (SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, CAST(l.l_shipdate AS DATE) AS d
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT CAST(year(d) AS INTEGER) AS batch_id, count(*) AS facts,
       count(*) FILTER (WHERE EXISTS (SELECT 1 FROM ver WHERE ver.o_custkey = lines.o_custkey
                        AND lines.d >= ver.effective_date AND lines.d < ver.end_date)) AS contained
FROM lines GROUP BY 1""")
def q_contain_counts(spark, sf_dir):
    """Facts per batch whose date lies inside a version of their dimension
    key: a left as-of join, then conditional counts."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "o_custkey", F.col("l_shipdate").cast("date").alias("d"))
    hit = L.asof_lookup(lines, priority_versions(spark, sf_dir).select(
        "o_custkey", F.lit(True).alias("hit"), "effective_date", "end_date"),
        "o_custkey", "o_custkey", "d", how="left", dim_cols=["hit", "effective_date", "end_date"])
    return hit.groupBy(F.year("d").cast("int").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("facts"), F.count_if(F.col("hit").isNotNull()).alias("contained"))


# --- J20 join on computed key -------------------------------------------------

@query("expr_key_join", "WITH " + _PERSON_SQL + """
SELECT c.c_custkey, s.s_suppkey
FROM c JOIN s
  ON upper(c.no || '|' || coalesce(CAST(c.nat AS VARCHAR), '')) =
     upper(s.no || '|' || coalesce(CAST(s.nat AS VARCHAR), ''))""")
def q_expr_key_join(spark, sf_dir):
    c, s = _people(spark, sf_dir)

    def k(df):
        return F.upper(F.concat(df["no"], F.lit("|"), F.coalesce(df["nat"].cast("string"), F.lit(""))))
    ck = c.withColumn("__k", k(c))
    sk = s.withColumn("__k", k(s))
    return ck.join(sk, "__k").select("c_custkey", "s_suppkey")


# --- J21 batch against batch ----------------------------------------------

@query("batch_compare", """
WITH cnt AS (
  SELECT 'orders' AS tbl, CAST(year(o_orderdate) AS INTEGER) AS batch_id, count(*) AS n FROM orders GROUP BY 2
  UNION ALL
  SELECT 'lineitem', CAST(year(l_shipdate) AS INTEGER), count(*) FROM lineitem GROUP BY 2)
SELECT coalesce(a.tbl, b.tbl) AS tbl, coalesce(a.batch_id, b.batch_id + 1) AS batch_id,
       a.n AS n, b.n AS prev_n, coalesce(a.n, 0) >= coalesce(b.n, 0) AS not_fewer
FROM cnt a FULL OUTER JOIN cnt b ON a.tbl = b.tbl AND a.batch_id = b.batch_id + 1""")
def q_batch_compare(spark, sf_dir):
    """Row counts of each batch against the batch before (full outer join on
    batch = previous + 1, so a batch missing on either side shows)."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    cnt = (o.groupBy(F.year("o_orderdate").cast("int").alias("batch_id"))
            .agg(F.count(F.lit(1)).alias("n")).withColumn("tbl", F.lit("orders"))
            .unionByName(li.groupBy(F.year("l_shipdate").cast("int").alias("batch_id"))
                         .agg(F.count(F.lit(1)).alias("n")).withColumn("tbl", F.lit("lineitem"))))
    a = cnt.alias("a")
    b = cnt.alias("b")
    j = a.join(b, (F.col("a.tbl") == F.col("b.tbl")) & (F.col("a.batch_id") == F.col("b.batch_id") + 1),
               "full_outer")
    return j.select(F.coalesce("a.tbl", "b.tbl").alias("tbl"),
                    F.coalesce(F.col("a.batch_id"), F.col("b.batch_id") + 1).alias("batch_id"),
                    F.col("a.n").alias("n"), F.col("b.n").alias("prev_n"),
                    (F.coalesce(F.col("a.n"), F.lit(0)) >= F.coalesce(F.col("b.n"), F.lit(0)))
                    .alias("not_fewer"))


# --- J22/J23 counts over time ---------------------------------------------------

@query("monotone_counts", """
WITH snap AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS batch_id, count(*) AS n FROM orders GROUP BY 1, 2),
cum AS (SELECT o_custkey, batch_id,
               CAST(sum(n) OVER (PARTITION BY o_custkey ORDER BY batch_id) AS BIGINT) AS cum_orders
        FROM snap)
SELECT a.o_custkey, a.batch_id, a.cum_orders,
       NOT EXISTS (SELECT 1 FROM cum b WHERE b.o_custkey = a.o_custkey AND b.batch_id < a.batch_id
                   AND b.cum_orders > a.cum_orders) AS never_smaller
FROM cum a""")
def q_monotone_counts(spark, sf_dir):
    """Cumulative order count per customer and batch; a later snapshot must
    never be smaller than an earlier one.  Checked against the running max
    of earlier snapshots (linear) instead of the quadratic time self join:
    no earlier snapshot is larger exactly when that max is not larger."""
    o = table(spark, sf_dir, "orders")
    snap = o.groupBy("o_custkey", F.year("o_orderdate").cast("int").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("o_custkey").orderBy("batch_id")
    cum = snap.withColumn("cum_orders", F.sum("n").over(w).cast("bigint"))
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    mx = F.max("cum_orders").over(earlier)
    return cum.select("o_custkey", "batch_id", "cum_orders",
                      (mx.isNull() | (mx <= F.col("cum_orders"))).alias("never_smaller"))


# --- J25 subqueries ----------------------------------------------------------------

@query("in_subquery", """
SELECT o.o_orderpriority, count(*) AS n,
       count(*) FILTER (WHERE CAST(o.o_orderdate AS DATE) =
         (SELECT min(CAST(o2.o_orderdate AS DATE)) FROM orders o2 WHERE o2.o_custkey = o.o_custkey)) AS first_orders
FROM orders o
WHERE o.o_custkey IN (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
GROUP BY o.o_orderpriority""")
def q_in_subquery(spark, sf_dir):
    """IN-subquery as a semi join; correlated scalar (first order date per
    customer) as an aggregate joined back on the key."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    first = o.groupBy("o_custkey").agg(F.min(F.col("o_orderdate").cast("date")).alias("__first"))
    sel = o.join(c, o.o_custkey == c.c_custkey, "left_semi").join(first, "o_custkey")
    return sel.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderdate").cast("date") == F.col("__first")).alias("first_orders"))
