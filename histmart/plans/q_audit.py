"""Audit driver queries.  Batch = year of the date.

Expected values come from an expectation table derived from the source
tables (standing in for the generator's audit files, which the readers in
``histmart.sources`` load when present); actual values come from the
derived warehouse tables.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from histmart.operators import checks as CK
from histmart.plans.q_cdc import trade_batches
from histmart.plans.q_history import _VER_SQL, priority_versions
from histmart.plans.q_quality import _ALL_ALERTS_SQL, alerts_all_df
from histmart.plans.registry import query, table
from histmart.session import tasks_for

# --- Q6 orphan references ------------------------------------------------------------

_EDGES = (
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer.c_nationkey->nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier.s_nationkey->nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation.n_regionkey->region", "nation", "n_regionkey", "region", "r_regionkey"),
    ("events.user_id->customer", "events", "user_id", "customer", "c_custkey"),
)


@query("orphan_keys", " UNION ALL ".join(
    f"SELECT '{e}' AS edge, count(*) AS orphans FROM {ct} WHERE {ck} IS NOT NULL "
    f"AND {ck} NOT IN (SELECT {pk} FROM {pt} WHERE {pk} IS NOT NULL)"
    for e, ct, ck, pt, pk in _EDGES))
def q_orphan_keys(spark, sf_dir):
    """Each foreign-key edge of the given tables, all in one grouped count."""
    names = {n for _, child, _, parent, _ in _EDGES for n in (child, parent)}
    report = CK.reference_report({n: table(spark, sf_dir, n) for n in sorted(names)}, [e[1:] for e in _EDGES])
    return report.select(F.concat("child", F.lit("."), "column", F.lit("->"), "parent").alias("edge"), "orphans")


# --- S14 / Q11 expectation table -------------------------------------------------------

_EXPECTED_SQL = """
exp AS (
  SELECT 'Orders' AS DataSet, CAST(year(o_orderdate) AS INTEGER) AS BatchID,
         make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS "Date", 'OR_RECORDS' AS Attribute,
         count(*) AS Value, CAST(NULL AS DECIMAL(16,5)) AS DValue
  FROM orders GROUP BY 2
  UNION ALL
  SELECT 'Orders', CAST(year(o_orderdate) AS INTEGER), make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1),
         'OR_MAX_PRICE', NULL, max(CAST(o_totalprice AS DECIMAL(16,5)))
  FROM orders GROUP BY 2
  UNION ALL
  SELECT 'Lineitem', CAST(year(l_shipdate) AS INTEGER), make_date(CAST(year(l_shipdate) AS INTEGER), 1, 1),
         'LI_RECORDS', count(*), NULL
  FROM lineitem GROUP BY 2
  UNION ALL
  SELECT 'Customer', y, make_date(y, 1, 1), 'C_NEW', count(*), NULL
  FROM (SELECT o_custkey, CAST(min(year(o_orderdate)) AS INTEGER) AS y FROM orders GROUP BY 1) f GROUP BY y)"""


def expected_df(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")

    def rows(df, ds, y, attr, value=None, dvalue=None):
        g = df.groupBy(y.cast("int").alias("BatchID"))
        v = value if value is not None else F.lit(None).cast("bigint")
        d = dvalue if dvalue is not None else F.lit(None).cast("decimal(16,5)")
        return g.agg(v.alias("Value"), d.alias("DValue")).select(
            F.lit(ds).alias("DataSet"), "BatchID", F.make_date("BatchID", F.lit(1), F.lit(1)).alias("Date"),
            F.lit(attr).alias("Attribute"), "Value", "DValue")
    first = o.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("y"))
    return (rows(o, "Orders", F.year("o_orderdate"), "OR_RECORDS", F.count(F.lit(1)))
            .unionByName(rows(o, "Orders", F.year("o_orderdate"), "OR_MAX_PRICE",
                              dvalue=F.max(F.col("o_totalprice").cast("decimal(16,5)"))))
            .unionByName(rows(li, "Lineitem", F.year("l_shipdate"), "LI_RECORDS", F.count(F.lit(1))))
            .unionByName(rows(first, "Customer", F.col("y"), "C_NEW", F.count(F.lit(1)))))


@query("audit_expected", "WITH " + _EXPECTED_SQL + " SELECT * FROM exp")
def q_audit_expected(spark, sf_dir):
    """The audit expectation table (DataSet, BatchID, Date, Attribute, Value,
    DValue), one row per data set, batch and attribute."""
    return expected_df(spark, sf_dir)


# --- Q1 row counts against expected -------------------------------------------------

_ACTUAL_SQL = "WITH " + _VER_SQL + "," + _EXPECTED_SQL + """,
act AS (
  SELECT y AS batch_id, 'DimCustomer new' AS test, count(*) AS actual
  FROM (SELECT o_custkey, CAST(year(min(effective_date)) AS INTEGER) AS y FROM ver GROUP BY 1) f GROUP BY y
  UNION ALL
  SELECT CAST(year(o_orderdate) AS INTEGER), 'DimTrade rows', count(*) FROM orders GROUP BY 1
  UNION ALL
  SELECT CAST(year(l_shipdate) AS INTEGER), 'Fact line rows', count(*) FROM lineitem GROUP BY 1),
piv AS (
  SELECT BatchID,
    max(Value) FILTER (WHERE Attribute = 'C_NEW') AS c_new,
    max(Value) FILTER (WHERE Attribute = 'OR_RECORDS') AS or_records,
    max(Value) FILTER (WHERE Attribute = 'LI_RECORDS') AS li_records
  FROM exp GROUP BY BatchID)"""


@query("audit_row_counts", _ACTUAL_SQL + """
SELECT a.test, a.batch_id,
  CASE WHEN a.actual = CASE a.test WHEN 'DimCustomer new' THEN p.c_new
                                   WHEN 'DimTrade rows' THEN p.or_records ELSE p.li_records END
       THEN 'OK' ELSE 'Not OK' END AS result,
  'Row count against expected' AS description
FROM act a LEFT JOIN piv p ON a.batch_id = p.BatchID""")
def q_audit_row_counts(spark, sf_dir):
    """Counts of derived tables per batch against the pivoted expectations."""
    v = priority_versions(spark, sf_dir)
    tgt, chg = trade_batches(spark, sf_dir)
    trades = tgt.select("trade_id", "create_date").unionByName(
        chg.where(F.col("create_date").isNotNull()).select("trade_id", "create_date"))
    li = table(spark, sf_dir, "lineitem")
    act = (v.groupBy("o_custkey").agg(F.year(F.min("effective_date")).alias("batch_id"))
            .groupBy("batch_id").agg(F.count(F.lit(1)).alias("actual")).withColumn("test", F.lit("DimCustomer new"))
           .unionByName(trades.groupBy(F.year("create_date").alias("batch_id"))
                        .agg(F.count(F.lit(1)).alias("actual")).withColumn("test", F.lit("DimTrade rows")))
           .unionByName(li.groupBy(F.year("l_shipdate").alias("batch_id"))
                        .agg(F.count(F.lit(1)).alias("actual")).withColumn("test", F.lit("Fact line rows"))))
    piv = (expected_df(spark, sf_dir).where(F.col("Value").isNotNull())
           .groupBy("BatchID").pivot("Attribute", ["C_NEW", "OR_RECORDS", "LI_RECORDS"]).agg(F.max("Value")))
    j = act.join(piv, act.batch_id == piv.BatchID, "left")
    want = (F.when(F.col("test") == "DimCustomer new", F.col("C_NEW"))
            .when(F.col("test") == "DimTrade rows", F.col("OR_RECORDS")).otherwise(F.col("LI_RECORDS")))
    return j.select("test", F.col("batch_id").cast("int").alias("batch_id"),
                    CK.verdict(F.coalesce(F.col("actual") == want, F.lit(False))).alias("result"),
                    F.lit("Row count against expected").alias("description"))


# --- Q3 batches present ----------------------------------------------------------------

@query("audit_batches", "WITH " + _EXPECTED_SQL + """,
b AS (
  SELECT 'orders' AS tbl, CAST(year(o_orderdate) AS INTEGER) AS batch_id FROM orders
  UNION ALL SELECT 'lineitem', CAST(year(l_shipdate) AS INTEGER) FROM lineitem),
exp_b AS (SELECT count(DISTINCT BatchID) AS n, min(BatchID) AS lo, max(BatchID) AS hi FROM exp)
SELECT tbl, count(DISTINCT batch_id) AS batches, min(batch_id) AS first_batch, max(batch_id) AS last_batch,
  CASE WHEN count(DISTINCT batch_id) = (SELECT n FROM exp_b) AND min(batch_id) = (SELECT lo FROM exp_b)
        AND max(batch_id) = (SELECT hi FROM exp_b) THEN 'OK' ELSE 'Not OK' END AS result
FROM b GROUP BY tbl""")
def q_audit_batches(spark, sf_dir):
    """Distinct batch set of each table against the expectation's batches."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    b = (o.select(F.lit("orders").alias("tbl"), F.year("o_orderdate").cast("int").alias("batch_id"))
         .unionByName(li.select(F.lit("lineitem").alias("tbl"), F.year("l_shipdate").cast("int").alias("batch_id"))))
    exp = expected_df(spark, sf_dir)
    n, lo, hi = (exp.agg(F.countDistinct("BatchID")).scalar(), exp.agg(F.min("BatchID")).scalar(),
                 exp.agg(F.max("BatchID")).scalar())
    g = b.groupBy("tbl").agg(F.countDistinct("batch_id").alias("batches"),
                             F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"))
    return g.withColumn("result", CK.verdict((F.col("batches") == n) & (F.col("first_batch") == lo)
                                             & (F.col("last_batch") == hi)))


# --- Q7 dates inside the batch window ------------------------------------------------

@query("audit_windows", "WITH " + _EXPECTED_SQL + """,
win AS (SELECT BatchID, min("Date") AS first_day FROM exp GROUP BY BatchID),
win2 AS (SELECT BatchID, first_day, lead(first_day) OVER (ORDER BY BatchID) AS next_first FROM win),
lines AS (SELECT CAST(year(o.o_orderdate) AS INTEGER) AS batch_id, CAST(l.l_shipdate AS DATE) AS d
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT lines.batch_id, count(*) AS facts,
  count(*) FILTER (WHERE d < w.first_day OR (w.next_first IS NOT NULL AND d >= w.next_first)) AS outside
FROM lines JOIN win2 w ON lines.batch_id = w.BatchID GROUP BY lines.batch_id""")
def q_audit_windows(spark, sf_dir):
    """Ship dates of each order's lines against the window of the order's
    batch ([first day, next batch's first day)).  The window table has one
    row per batch, so its single-partition ``lead`` is bounded."""
    win = expected_df(spark, sf_dir).groupBy("BatchID").agg(F.min("Date").alias("first_day"))
    win = win.withColumn("next_first", F.lead("first_day").over(Window.orderBy("BatchID")))
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("int").alias("batch_id"))
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select("batch_id", F.col("l_shipdate").cast("date").alias("d"))
    j = lines.join(F.broadcast(win), lines.batch_id == win.BatchID)
    outside = (F.col("d") < F.col("first_day")) | (F.col("next_first").isNotNull() & (F.col("d") >= F.col("next_first")))
    return j.groupBy("batch_id").agg(F.count(F.lit(1)).alias("facts"), F.count_if(outside).alias("outside"))


# --- Q8 price order on the market table ---------------------------------------------

_PRICE_SQL = """
daily AS (
  SELECT l_partkey, CAST(l_shipdate AS DATE) AS day,
         max(CAST(l_extendedprice AS DECIMAL(15,2))) AS day_high,
         min(CAST(l_extendedprice AS DECIMAL(15,2))) AS day_low,
         arg_max(CAST(l_extendedprice AS DECIMAL(15,2)), l_orderkey * 100 + l_linenumber) AS close
  FROM lineitem GROUP BY 1, 2),
roll AS (
  SELECT daily.*, max(day_high) OVER w AS high_365, min(day_low) OVER w AS low_365 FROM daily
  WINDOW w AS (PARTITION BY l_partkey ORDER BY day RANGE BETWEEN INTERVAL 364 DAYS PRECEDING AND CURRENT ROW))"""


@query("check_price_order", "WITH " + _PRICE_SQL + """
SELECT CAST(year(day) AS INTEGER) AS batch_id, 'low_le_daylow' AS "check", count(*) AS rows,
       count(*) FILTER (WHERE NOT coalesce(low_365 <= day_low, false)) AS violations FROM roll GROUP BY 1
UNION ALL SELECT CAST(year(day) AS INTEGER), 'daylow_le_close', count(*),
       count(*) FILTER (WHERE NOT coalesce(day_low <= close, false)) FROM roll GROUP BY 1
UNION ALL SELECT CAST(year(day) AS INTEGER), 'close_le_dayhigh', count(*),
       count(*) FILTER (WHERE NOT coalesce(close <= day_high, false)) FROM roll GROUP BY 1
UNION ALL SELECT CAST(year(day) AS INTEGER), 'dayhigh_le_high', count(*),
       count(*) FILTER (WHERE NOT coalesce(day_high <= high_365, false)) FROM roll GROUP BY 1""")
def q_check_price_order(spark, sf_dir):
    """low <= day low <= close <= day high <= high on the rolling market table."""
    from histmart.operators.facts import rolling_extremes
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    tasks = tasks_for(li)
    lines = li.select("l_partkey", F.col("l_shipdate").cast("date").alias("day"), price.alias("price"),
                      (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line"))
    # dealt before they are grouped: a task's groups don't grow with the table
    daily = lines.repartition(tasks, "l_partkey", "day").groupBy("l_partkey", "day").agg(
        F.max("price").alias("day_high"), F.min("price").alias("day_low"), F.max_by("price", "line").alias("close"))
    r = rolling_extremes(daily, "l_partkey", "day", "day_high", "day_low", tasks=tasks)
    return CK.count_violations(r, {
        "low_le_daylow": F.col("low_365") <= F.col("day_low"),
        "daylow_le_close": F.col("day_low") <= F.col("close"),
        "close_le_dayhigh": F.col("close") <= F.col("day_high"),
        "dayhigh_le_high": F.col("day_high") <= F.col("high_365")},
        batch=F.year("day").cast("int"))


# --- Q9 message log against expected -------------------------------------------------

@query("audit_log", _ALL_ALERTS_SQL + """,
logged AS (
  SELECT message_source, message_text, batch_id, count(*) AS logged FROM (
    SELECT * FROM a_range UNION ALL SELECT * FROM a_domain UNION ALL SELECT * FROM a_amount
    UNION ALL SELECT * FROM a_missing) m GROUP BY 1, 2, 3),
expect AS (
  SELECT 'DimCustomer' AS message_source, 'Invalid customer tier' AS message_text, 1 AS batch_id,
         (SELECT count(*) FROM customer WHERE c_custkey % 5 IN (0, 4)) AS expected
  UNION ALL SELECT 'DimTrade', 'Invalid trade commission', 1,
         (SELECT count(*) FROM lineitem WHERE CAST(l_discount AS DECIMAL(4,2)) * 12 > 1)
  UNION ALL SELECT 'DimTrade', 'Invalid trade fee', 1,
         (SELECT count(*) FROM lineitem WHERE CAST(l_tax AS DECIMAL(4,2)) * 15 > 1))
SELECT l.message_source, l.message_text, l.batch_id, l.logged, e.expected,
  CASE WHEN e.expected IS NULL THEN 'No expectation' WHEN e.expected = l.logged THEN 'OK' ELSE 'Not OK' END AS result
FROM logged l LEFT JOIN expect e ON l.message_source = e.message_source AND l.message_text = e.message_text
  AND l.batch_id = e.batch_id""")
def q_audit_log(spark, sf_dir):
    """Message log grouped by source, text and batch, joined to counts the
    rules imply when computed straight from the sources."""
    logged = alerts_all_df(spark, sf_dir).groupBy("message_source", "message_text", "batch_id") \
        .agg(F.count(F.lit(1)).alias("logged"))
    c, li = table(spark, sf_dir, "customer"), table(spark, sf_dir, "lineitem")
    expect = (c.agg(F.count_if((F.col("c_custkey") % 5).isin(0, 4)).alias("expected"))
               .select(F.lit("DimCustomer").alias("message_source"), F.lit("Invalid customer tier").alias("message_text"),
                       "expected")
              .unionByName(li.agg(F.count_if(F.col("l_discount").cast("decimal(4,2)") * 12 > 1).alias("expected"))
                           .select(F.lit("DimTrade").alias("message_source"),
                                   F.lit("Invalid trade commission").alias("message_text"), "expected"))
              .unionByName(li.agg(F.count_if(F.col("l_tax").cast("decimal(4,2)") * 15 > 1).alias("expected"))
                           .select(F.lit("DimTrade").alias("message_source"),
                                   F.lit("Invalid trade fee").alias("message_text"), "expected"))
              .withColumn("batch_id", F.lit(1)))
    j = logged.join(expect, ["message_source", "message_text", "batch_id"], "left")
    return j.select("message_source", "message_text", "batch_id", "logged", "expected",
                    F.when(F.col("expected").isNull(), F.lit("No expectation"))
                     .when(F.col("expected") == F.col("logged"), F.lit("OK")).otherwise(F.lit("Not OK")).alias("result"))
