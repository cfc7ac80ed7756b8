"""Source-reader driver queries: the adapter encodes the given
tables as raw text with Spark, the readers parse it back; the SQL twin
computes the same fields straight from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from histmart.functions.clean import VALID_SP_RATINGS
from histmart.plans import adapter as A
from histmart.plans.registry import query
from histmart.session import materialize
from histmart.sources import readers as R

_RATINGS_SQL = "[" + ", ".join(f"'{r}'" for r in A.RATING_CYCLE) + "]"
_VALID_SQL = "(" + ", ".join(f"'{r}'" for r in VALID_SP_RATINGS) + ")"

# Company records of the adapter, in SQL.
CMP_SQL = f"""
yrs AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders),
cmp0 AS (
  SELECT s.*, unnest(range(yrs.lo - 1, yrs.hi + 1)) AS year, 0 AS seq FROM supplier s, yrs
  UNION ALL SELECT s.*, 1998 AS year, 1 AS seq FROM supplier s WHERE s_suppkey % 7 = 0),
cmp AS (
  SELECT s_suppkey, year, seq,
    make_timestamp(year, 1, 1, 0, 0, 0) + to_days(CAST(s_suppkey % 90 AS INTEGER))
      + to_hours(CAST(s_suppkey % 20 + seq AS INTEGER)) AS pts,
    s_name AS CompanyName, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS CIK,
    CASE WHEN seq = 1 THEN 'INAC' ELSE 'ACTV' END AS Status,
    lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS IndustryID,
    list_element({_RATINGS_SQL}, CAST((s_suppkey + (year - (SELECT lo FROM yrs) + 1) // 2) % 25 + 1 AS INTEGER)) AS SPrating,
    CASE WHEN s_suppkey % 5 = 0 THEN NULL
         ELSE DATE '1970-01-01' + CAST((s_suppkey * 11) % 9000 AS INTEGER) END AS FoundingDate,
    'Street ' || CAST(s_nationkey AS VARCHAR) AS AddrLine1,
    lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS PostalCode,
    'City ' || CAST(s_nationkey AS VARCHAR) AS City,
    'CEO of ' || s_name AS CEOname,
    'Company ' || CAST(s_suppkey AS VARCHAR) || CASE WHEN year >= 2000 THEN ' (renamed)' ELSE '' END AS Description
  FROM cmp0)"""

FIN_SQL = """
finq AS (
  SELECT l_suppkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS qstart,
         sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS rev,
         sum(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2))) AS earn
  FROM lineitem GROUP BY 1, 2),
fin AS (
  SELECT f.l_suppkey, f.qstart, f.rev, f.earn, s.s_name,
         CAST(f.qstart + INTERVAL 3 MONTH AS DATE) + CAST(f.l_suppkey % 20 AS INTEGER) AS posting,
         CASE WHEN (f.l_suppkey + quarter(f.qstart)) % 2 = 0 THEN lpad(CAST(f.l_suppkey AS VARCHAR), 10, '0')
              ELSE s.s_name END AS CoNameOrCIK
  FROM finq f JOIN supplier s ON f.l_suppkey = s.s_suppkey)"""

SEC_SQL = """
nsup AS (SELECT max(s_suppkey) + 1 AS n FROM supplier),
sec0 AS (SELECT p.*, 0 AS seq FROM part p UNION ALL SELECT p.*, 1 FROM part p WHERE p_partkey % 9 = 0),
sec AS (
  SELECT p_partkey, seq, p_partkey % (SELECT n FROM nsup) AS company,
    make_timestamp(1994, 6, 1, 9, 30, 0) + to_days(CAST(p_partkey % 180 + seq * 600 AS INTEGER)) AS pts,
    'S' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS Symbol,
    CASE WHEN seq = 1 THEN 'INAC' ELSE 'ACTV' END AS Status, p_name AS Name,
    CAST(CAST(p_retailprice AS DECIMAL(15,2)) * 0.01 AS DECIMAL(12,4)) AS Dividend,
    CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(p_partkey % (SELECT n FROM nsup) AS VARCHAR), 10, '0')
         ELSE s.s_name END AS CoNameOrCIK
  FROM sec0 JOIN supplier s ON s.s_suppkey = sec0.p_partkey % (SELECT n FROM nsup))"""


# --- S1-S3: delimited -------------------------------------------------------------

@query("scan_delimited", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders""")
def q_scan_delimited(spark, sf_dir):
    """Orders written as pipe-separated text, parsed back with the typed
    delimited reader's options (``from_csv``)."""
    text = A.orders_text(spark, sf_dir)
    return text.select(F.from_csv("value", A.ORDERS_TEXT_SCHEMA,
                                  {"sep": "|", "timestampFormat": R.TS_FORMAT}).alias("r")).select("r.*")


# --- S4-S7: fixed width -----------------------------------------------------------

@query("fixed_width_records", "WITH " + CMP_SQL + "," + FIN_SQL + "," + SEC_SQL + """
SELECT 'CMP' AS rec_type, pts, CIK AS ref, CompanyName AS name FROM cmp
UNION ALL
SELECT 'FIN', make_timestamp(year(posting), month(posting), day(posting), 6, 0, 0),
       CoNameOrCIK, CAST(year(qstart) AS VARCHAR) || 'Q' || CAST(quarter(qstart) AS VARCHAR) FROM fin
UNION ALL
SELECT 'SEC', pts, Symbol, Name FROM sec""")
def q_fixed_width_records(spark, sf_dir):
    """FINWIRE text parsed once (posting time and record type split off),
    staged, then branched into the three layouts."""
    parsed = materialize(R.parse_fixed_width(A.finwire_lines(spark, sf_dir)), "finwire")
    cmp_ = R.fixed_width_records(parsed, "CMP").select(
        F.lit("CMP").alias("rec_type"), "PTS", F.col("CIK").alias("ref"), F.col("CompanyName").alias("name"))
    fin = R.fixed_width_records(parsed, "FIN").select(
        F.lit("FIN").alias("rec_type"), "PTS", F.col("CoNameOrCIK").alias("ref"),
        F.concat("Year", F.lit("Q"), "Quarter").alias("name"))
    sec = R.fixed_width_records(parsed, "SEC").select(
        F.lit("SEC").alias("rec_type"), "PTS", F.col("Symbol").alias("ref"), F.col("Name").alias("name"))
    return (cmp_.unionByName(fin).unionByName(sec)
            .select("rec_type", F.col("PTS").cast("timestamp_ntz").alias("pts"), "ref", "name"))


# --- S8 / S9: XML actions and their account lists -------------------------------

_ACTIONS_SQL = """
firsts AS (SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_key,
                  arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_key
           FROM orders GROUP BY o_custkey),
act0 AS (
  SELECT CASE WHEN o.o_orderkey = f.first_key THEN 'NEW'
              WHEN o.o_orderkey = f.last_key AND o.o_orderstatus = 'F' THEN 'INACT'
              ELSE CASE o.o_orderkey % 10 WHEN 3 THEN 'ADDACCT' WHEN 7 THEN 'UPDACCT' WHEN 9 THEN 'CLOSEACCT' ELSE 'UPDCUST' END
         END AS action_type,
         o.o_orderdate AS action_ts, o.o_orderkey, o.o_orderkey AS ok, o.o_custkey, o.o_custkey AS k, c.c_nationkey, c.c_nationkey AS n,
         c.c_name, o.o_orderpriority, o.o_orderkey = f.first_key AS is_new, lpad(CAST(c.c_custkey % 10000 AS VARCHAR), 4, '0') AS num
  FROM orders o JOIN firsts f ON o.o_custkey = f.o_custkey JOIN customer c ON o.o_custkey = c.c_custkey),
act AS (
  SELECT *, CASE WHEN of_customer AND (is_new OR ok % 5 = 0) THEN 'T' || k || '-' || ok % 7 END AS tax_id,
    CASE WHEN of_customer AND (is_new OR ok % 7 = 0) THEN list_element(['m', 'F', 'x', ''], CAST((k + ok) % 4 + 1 AS INTEGER)) END AS gender,
    CASE WHEN of_customer AND (is_new OR ok % 3 = 0) THEN CAST(k % 5 AS INTEGER) END AS tier,
    CASE WHEN is_new THEN DATE '1930-01-01' + CAST((k * 37) % 25000 AS INTEGER) END AS dob,
    CASE WHEN of_customer AND (is_new OR ok % 2 = 0) THEN c_name END AS l_name,
    CASE WHEN of_customer AND (is_new OR ok % 6 = 0) THEN 'F' || n END AS f_name,
    CASE WHEN is_new THEN 'M' WHEN of_customer AND ok % 10 = 0 THEN '' END AS m_name,
    CASE WHEN is_new THEN 'Street ' || n END AS adline1,
    CASE WHEN is_new AND k % 3 = 0 THEN 'Apt ' || k WHEN is_new AND k % 3 = 1 THEN '' END AS adline2,
    CASE WHEN is_new THEN lpad(CAST(n AS VARCHAR), 5, '0') END AS zip,
    CASE WHEN is_new THEN 'City' WHEN of_customer AND ok % 8 = 0 THEN 'Town ' || n END AS city,
    CASE WHEN is_new THEN 'ST' END AS state, CASE WHEN is_new THEN 'Country' END AS country,
    CASE WHEN NOT of_customer THEN NULL WHEN ok % 4 = 0 THEN '' ELSE 'c' || k || '@' || lower(substr(o_orderpriority, 3, 20)) || '.com' END AS email,
    CASE WHEN of_customer AND ok % 9 = 0 THEN 'alt' || k || '@x.org' END AS email2,
    CASE WHEN is_new THEN '+1 (' || lpad(CAST(n AS VARCHAR), 3, '0') || ') 555' || num END AS phone1,
    CASE WHEN is_new AND k % 2 = 0 THEN '(200) 666' || num || '7' END AS phone2,
    CASE WHEN of_customer AND ok % 11 = 0 THEN '444' || num END AS phone3,
    CASE WHEN is_new THEN 'TX' || lpad(CAST(n AS VARCHAR), 2, '0') WHEN of_customer AND ok % 12 = 0 THEN 'TX' || lpad(CAST((n + 1) % 25 AS VARCHAR), 2, '0') END AS lcl_tx,
    CASE WHEN is_new THEN 'TX' || lpad(CAST((n + 5) % 25 AS VARCHAR), 2, '0') END AS nat_tx
  FROM (SELECT *, action_type IN ('NEW', 'UPDCUST', 'INACT') AS of_customer FROM act0)),
own AS (
  SELECT action_ts, ok, action_type, k, k * 2 + i AS ca_id, CAST(i + 1 AS INTEGER) AS ca_tax_st, CAST(n AS BIGINT) AS ca_b_id, 'Account ' || i AS ca_name
  FROM act, (VALUES (0), (1)) t(i) WHERE action_type = 'NEW'
  UNION ALL
  SELECT action_ts, ok, action_type, k, 1000000000 + ok, 1, n, 'Added ' || ok FROM act WHERE action_type = 'ADDACCT'
  UNION ALL
  SELECT action_ts, ok, action_type, k, k * 2, CASE WHEN ok % 3 = 0 THEN CAST(ok % 2 + 1 AS INTEGER) END, CASE WHEN ok % 20 = 7 THEN (n + 1) % 25 END,
    CASE WHEN ok % 4 <> 1 THEN 'Renamed ' || ok END
  FROM act WHERE action_type = 'UPDACCT'
  UNION ALL
  SELECT action_ts, ok, action_type, k, k * 2 + 1, NULL, NULL, NULL FROM act WHERE action_type = 'CLOSEACCT')"""


@query("xml_actions", "WITH " + _ACTIONS_SQL + """
SELECT action_type, action_ts, o_custkey AS c_id, tier, l_name, email,
       tax_id, dob, phone1 IS NOT NULL AS has_phone1, nat_tx, CASE WHEN is_new THEN 2 WHEN of_customer THEN 0 ELSE 1 END AS n_accounts
FROM act""")
def q_xml_actions(spark, sf_dir):
    """Customer actions as XML elements parsed with ``from_xml`` and the
    action schema: attributes, nested structs, absent vs empty elements."""
    a = R.parse_actions(A.action_xml(spark, sf_dir), "value", "seq")
    acct = F.col("Customer.Account")
    return a.select(
        F.col("_ActionType").alias("action_type"), F.col("_ActionTS").cast("timestamp_ntz").alias("action_ts"),
        F.col("Customer._C_ID").alias("c_id"), F.col("Customer._C_TIER").alias("tier"),
        F.col("Customer.Name.C_L_NAME").alias("l_name"),
        F.col("Customer.ContactInfo.C_PRIM_EMAIL").alias("email"),
        F.col("Customer._C_TAX_ID").alias("tax_id"), F.col("Customer._C_DOB").alias("dob"),
        F.col("Customer.ContactInfo.C_PHONE_1.C_LOCAL").isNotNull().alias("has_phone1"),
        F.col("Customer.TaxInfo.C_NAT_TX_ID").alias("nat_tx"),
        F.when(acct.isNull(), F.lit(0)).otherwise(F.size(acct)).alias("n_accounts"))


@query("explode_children", "WITH " + _ACTIONS_SQL + " SELECT k AS c_id, ca_id, ca_tax_st, ca_b_id, ca_name, action_ts FROM own")
def q_explode_children(spark, sf_dir):
    a = R.parse_actions(A.action_xml(spark, sf_dir), "value", "seq")
    e = R.explode_accounts(a)
    return e.select(F.col("C_ID").alias("c_id"), F.col("CA_ID").alias("ca_id"),
                    F.col("CA_TAX_ST").alias("ca_tax_st"), F.col("CA_B_ID").alias("ca_b_id"),
                    F.col("CA_NAME").alias("ca_name"), F.col("_ActionTS").cast("timestamp_ntz").alias("action_ts"))
