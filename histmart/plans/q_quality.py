"""Data-quality alert and domain-check driver queries (SURVEY 2.9 L1-L6, K9,
K10, T18).  Batch 1 is the historical load, batch date 2000-01-01."""

from __future__ import annotations

from pyspark.sql import functions as F

from histmart.functions.clean import valid_rating
from histmart.operators import checks as CK
from histmart.operators import quality as Q
from histmart.plans import adapter as A
from histmart.plans.q_cdc import prospect_files
from histmart.plans.q_facts import _QTR_SQL, _quarters
from histmart.operators.facts import prior_quarter_start
from histmart.plans.q_sources import CMP_SQL, _VALID_SQL
from histmart.plans.registry import query, table
from histmart.sources import readers as R

BATCH_DATE = "2000-01-01"

# --- L1 / L2 ---------------------------------------------------------------------

_CUST_ALERT_SQL = f"""
cust AS (SELECT c_custkey, CAST(c_custkey % 5 AS INTEGER) AS tier,
                DATE '1890-01-01' + CAST((c_custkey * 53) % 40500 AS INTEGER) AS dob FROM customer),
a_range AS (
  SELECT 1 AS batch_id, 'DimCustomer' AS message_source, 'Invalid customer tier' AS message_text,
         'Alert' AS message_type,
         'C_ID = ' || CAST(c_custkey AS VARCHAR) || ', C_TIER = ' || CAST(tier AS VARCHAR) AS message_data
  FROM cust WHERE tier NOT IN (1, 2, 3)
  UNION ALL
  SELECT 1, 'DimCustomer', 'DOB out of range', 'Alert',
         'C_ID = ' || CAST(c_custkey AS VARCHAR) || ', C_DOB = ' || CAST(dob AS VARCHAR)
  FROM cust WHERE dob < DATE '{BATCH_DATE}' - INTERVAL 100 YEAR OR dob > DATE '{BATCH_DATE}')"""


def alert_range_df(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_custkey") % 5).cast("int").alias("tier"),
        F.date_add(F.lit("1890-01-01").cast("date"), ((F.col("c_custkey") * 53) % 40500).cast("int")).alias("dob"))
    batch = F.lit(BATCH_DATE).cast("date")
    tier = Q.alerts(c, Q.invalid_domain(F.col("tier"), [1, 2, 3]), "DimCustomer", "Invalid customer tier",
                    [("C_ID", F.col("c_custkey")), ("C_TIER", F.col("tier"))], 1)
    dob = Q.alerts(c, Q.dob_out_of_range(F.col("dob"), batch), "DimCustomer", "DOB out of range",
                   [("C_ID", F.col("c_custkey")), ("C_DOB", F.col("dob"))], 1)
    return Q.union_messages([tier, dob])


@query("alert_range", "WITH " + _CUST_ALERT_SQL + " SELECT * FROM a_range")
def q_alert_range(spark, sf_dir):
    return alert_range_df(spark, sf_dir)


# --- L3 ---------------------------------------------------------------------------

_RATING_ALERT_SQL = CMP_SQL + f""",
a_domain AS (
  SELECT 1 AS batch_id, 'DimCompany' AS message_source, 'Invalid SPRating' AS message_text,
         'Alert' AS message_type,
         'CO_ID = ' || CAST(CAST(CIK AS BIGINT) AS VARCHAR) || ', CO_SP_RATE = ' || SPrating AS message_data
  FROM cmp WHERE SPrating NOT IN {_VALID_SQL})"""


def alert_domain_df(spark, sf_dir):
    cmp_ = R.fixed_width_records(R.parse_fixed_width(A.cmp_lines(spark, sf_dir)), "CMP")
    return Q.alerts(cmp_, ~valid_rating(F.col("SPrating")), "DimCompany", "Invalid SPRating",
                    [("CO_ID", F.col("CIK").cast("long")), ("CO_SP_RATE", F.col("SPrating"))], 1)


@query("alert_domain", "WITH " + _RATING_ALERT_SQL + " SELECT * FROM a_domain")
def q_alert_domain(spark, sf_dir):
    """Ratings outside the 22 valid S&P grades, read from parsed CMP records."""
    return alert_domain_df(spark, sf_dir)


# --- L4 / L5 ----------------------------------------------------------------------

_AMOUNT_ALERT_SQL = """
tr AS (SELECT l_orderkey * 10 + l_linenumber AS t_id, CAST(l_extendedprice AS DECIMAL(15,2)) AS amount,
              CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2)) * 12 AS comm,
              CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(4,2)) * 15 AS fee
       FROM lineitem),
a_amount AS (
  SELECT 1 AS batch_id, 'DimTrade' AS message_source, 'Invalid trade commission' AS message_text,
         'Alert' AS message_type,
         'T_ID = ' || CAST(t_id AS VARCHAR) || ', T_COMM = ' || CAST(comm AS VARCHAR) AS message_data
  FROM tr WHERE comm > amount
  UNION ALL
  SELECT 1, 'DimTrade', 'Invalid trade fee', 'Alert',
         'T_ID = ' || CAST(t_id AS VARCHAR) || ', T_CHRG = ' || CAST(fee AS VARCHAR)
  FROM tr WHERE fee > amount)"""


def alert_amount_df(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    amount = F.col("l_extendedprice").cast("decimal(15,2)")
    tr = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("t_id"), amount.alias("amount"),
                   (amount * F.col("l_discount").cast("decimal(4,2)") * 12).alias("comm"),
                   (amount * F.col("l_tax").cast("decimal(4,2)") * 15).alias("fee"))
    # rule D7: both limits are price x quantity (the line amount)
    comm = Q.alerts(tr, F.col("comm") > F.col("amount"), "DimTrade", "Invalid trade commission",
                    [("T_ID", F.col("t_id")), ("T_COMM", F.col("comm"))], 1)
    fee = Q.alerts(tr, F.col("fee") > F.col("amount"), "DimTrade", "Invalid trade fee",
                   [("T_ID", F.col("t_id")), ("T_CHRG", F.col("fee"))], 1)
    return Q.union_messages([comm, fee])


@query("alert_amount", "WITH " + _AMOUNT_ALERT_SQL + " SELECT * FROM a_amount")
def q_alert_amount(spark, sf_dir):
    return alert_amount_df(spark, sf_dir)


# --- L6 ---------------------------------------------------------------------------

_MISSING_ALERT_SQL = _QTR_SQL + """,
a_missing AS (
  SELECT 1 AS batch_id, 'FactMarketHistory' AS message_source, 'No earnings for company' AS message_text,
         'Alert' AS message_type,
         'O_ID = ' || CAST(o.o_orderkey AS VARCHAR) || ', C_ID = ' || CAST(o.o_custkey AS VARCHAR) AS message_data
  FROM orders o LEFT JOIN t4 ON o.o_custkey = t4.o_custkey
    AND t4.qtr >= CAST(o.o_orderdate AS DATE) - INTERVAL 3 MONTH AND t4.qtr < CAST(o.o_orderdate AS DATE)
  WHERE t4.trailing_4q IS NULL OR t4.trailing_4q = 0)"""


def alert_missing_df(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", prior_quarter_start(F.col("o_orderdate").cast("date")).alias("__q"))
    t4 = _quarters(spark, sf_dir).select(F.col("o_custkey").alias("__c"), "qtr", "trailing_4q")
    j = o.join(t4, (o.o_custkey == t4.__c) & (o.__q == t4.qtr), "left")
    return Q.alerts(j, F.col("trailing_4q").isNull() | (F.col("trailing_4q") == 0), "FactMarketHistory",
                    "No earnings for company", [("O_ID", F.col("o_orderkey")), ("C_ID", F.col("o_custkey"))], 1)


@query("alert_missing", "WITH " + _MISSING_ALERT_SQL + " SELECT * FROM a_missing")
def q_alert_missing(spark, sf_dir):
    return alert_missing_df(spark, sf_dir)


# --- K9 all alerts of the batch, one union ----------------------------------------

_ALL_ALERTS_SQL = ("WITH " + _CUST_ALERT_SQL + "," + _RATING_ALERT_SQL + "," + _AMOUNT_ALERT_SQL + ","
                   + _MISSING_ALERT_SQL)


def alerts_all_df(spark, sf_dir):
    return Q.union_messages([alert_range_df(spark, sf_dir), alert_domain_df(spark, sf_dir),
                             alert_amount_df(spark, sf_dir), alert_missing_df(spark, sf_dir)])


@query("alerts_all", _ALL_ALERTS_SQL + """
SELECT * FROM a_range UNION ALL SELECT * FROM a_domain UNION ALL SELECT * FROM a_amount
UNION ALL SELECT * FROM a_missing""")
def q_alerts_all(spark, sf_dir):
    """Every alert of the batch as one DataFrame: one append to the log."""
    return alerts_all_df(spark, sf_dir)


# --- T18 load counters -------------------------------------------------------------

@query("load_counters", """
WITH p1 AS (SELECT c_custkey AS k, upper(c_name) AS ln, c_nationkey AS nat,
                   CAST(c_acctbal AS DECIMAL(15,2)) AS nw, c_custkey % 3 = 0 AS is_cust
            FROM customer WHERE c_custkey % 4 <> 3),
p2 AS (SELECT c_custkey AS k, upper(c_name) AS ln, c_nationkey AS nat,
              CAST(CAST(c_acctbal AS DECIMAL(15,2)) + CASE WHEN c_custkey % 5 = 0 THEN 100 ELSE 0 END
                   AS DECIMAL(15,2)) AS nw, c_custkey % 2 = 0 AS is_cust
       FROM customer WHERE c_custkey % 4 <> 1)
SELECT 2 AS batch_id, 'Source rows' AS counter, count(*) AS value FROM p2
UNION ALL
SELECT 2, 'Inserted rows', count(*) FROM p2 WHERE k NOT IN (SELECT k FROM p1)
UNION ALL
SELECT 2, 'Updated rows', count(*) FROM p2 JOIN p1 USING (k)
WHERE p1.ln IS DISTINCT FROM p2.ln OR p1.nat IS DISTINCT FROM p2.nat OR p1.nw IS DISTINCT FROM p2.nw""")
def q_load_counters(spark, sf_dir):
    """Prospect load counters of batch 2; a row whose only change is the
    is-customer flag does not count as updated (rule D21: all three
    counters every batch)."""
    p1, p2 = prospect_files(spark, sf_dir)
    p1 = p1.withColumn("is_cust", F.col("agency_id") % 3 == 0)
    p2 = p2.withColumn("is_cust", F.col("agency_id") % 2 == 0)
    a, b = p1.alias("a"), p2.alias("b")
    j = b.join(a, F.col("a.agency_id") == F.col("b.agency_id"), "left")
    changed = F.lit(False)
    for c in ("last_name", "nation", "net_worth"):
        changed = changed | ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    agg = j.agg(F.count(F.lit(1)).alias("src"),
                F.count_if(F.col("a.agency_id").isNull()).alias("ins"),
                F.count_if(F.col("a.agency_id").isNotNull() & changed).alias("upd"))
    stack = F.explode(F.array(
        F.struct(F.lit("Source rows").alias("counter"), F.col("src").alias("value")),
        F.struct(F.lit("Inserted rows").alias("counter"), F.col("ins").alias("value")),
        F.struct(F.lit("Updated rows").alias("counter"), F.col("upd").alias("value"))))
    return agg.select(F.lit(2).alias("batch_id"), stack.alias("s")).select("batch_id", "s.counter", "s.value")


# --- K10 / Q5 domain checks -------------------------------------------------------

_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _in(vals):
    return "(" + ", ".join(f"'{v}'" for v in vals) + ")"


@query("check_domain", f"""
SELECT CAST(NULL AS INTEGER) AS batch_id, 'order_status' AS "check", count(*) AS rows,
       count(*) FILTER (WHERE NOT coalesce(o_orderstatus IN ('F', 'O', 'P'), false)) AS violations FROM orders
UNION ALL SELECT NULL, 'order_priority', count(*),
       count(*) FILTER (WHERE NOT coalesce(o_orderpriority IN {_in(_PRIORITIES)}, false)) FROM orders
UNION ALL SELECT NULL, 'return_flag', count(*),
       count(*) FILTER (WHERE NOT coalesce(l_returnflag IN ('A', 'N', 'R'), false)) FROM lineitem
UNION ALL SELECT NULL, 'line_status', count(*),
       count(*) FILTER (WHERE NOT coalesce(l_linestatus IN ('F', 'O'), false)) FROM lineitem
UNION ALL SELECT NULL, 'market_segment', count(*),
       count(*) FILTER (WHERE NOT coalesce(c_mktsegment IN {_in(_SEGMENTS)}, false)) FROM customer
UNION ALL SELECT NULL, 'part_size', count(*),
       count(*) FILTER (WHERE NOT coalesce(p_size BETWEEN 1 AND 50, false)) FROM part
UNION ALL SELECT NULL, 'balance_positive', count(*),
       count(*) FILTER (WHERE NOT coalesce(c_acctbal > 0, false)) FROM customer""")
def q_check_domain(spark, sf_dir):
    """Value-domain checks (the DDL CHECK constraints) as one
    ``count_if(not predicate)`` pass per table."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    c, p = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    parts = [
        CK.count_violations(o, {"order_status": F.col("o_orderstatus").isin("F", "O", "P"),
                                "order_priority": F.col("o_orderpriority").isin(*_PRIORITIES)}),
        CK.count_violations(li, {"return_flag": F.col("l_returnflag").isin("A", "N", "R"),
                                 "line_status": F.col("l_linestatus").isin("F", "O")}),
        CK.count_violations(c, {"market_segment": F.col("c_mktsegment").isin(*_SEGMENTS),
                                "balance_positive": F.col("c_acctbal") > 0}),
        CK.count_violations(p, {"part_size": F.col("p_size").between(1, 50)}),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out

