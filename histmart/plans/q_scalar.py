"""Projection, predicate and scalar-function driver queries.

Raw-looking inputs (codes in mixed case, blanks, missing phone parts) are
derived from the customer table by fixed rules on the key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from histmart.functions import clean as CL
from histmart.plans.registry import query, table


def _k(n):
    return F.col("c_custkey") % n


# --- P1-P3, P8 -----------------------------------------------------------------

@query("project_filter", """
SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_id,
       true AS is_current, 1 AS batch_id, DATE '9999-12-31' AS end_date
FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey <> 3""")
def q_project_filter(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return (c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_nationkey") != 3))
             .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
                     F.col("c_nationkey").alias("nation_id"), F.lit(True).alias("is_current"),
                     F.lit(1).alias("batch_id"), F.lit("9999-12-31").cast("date").alias("end_date")))


# --- P4 -----------------------------------------------------------------------------

@query("case_when", """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Pending' END AS status_name,
  CASE WHEN o_totalprice > 400000 THEN 'URGENT' ELSE o_orderpriority END AS priority,
  CASE WHEN o_totalprice >= 300000 THEN 1 WHEN o_totalprice >= 100000 THEN 2 ELSE 3 END AS tier
FROM orders""")
def q_case_when(spark, sf_dir):
    """Conditional update under a mask as ``when/otherwise``."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "Completed").when(F.col("o_orderstatus") == "O", "Open")
         .when(F.col("o_orderstatus") == "P", "Pending").alias("status_name"),
        F.when(F.col("o_totalprice") > 400000, F.lit("URGENT")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_totalprice") >= 300000, 1).when(F.col("o_totalprice") >= 100000, 2).otherwise(3)
         .alias("tier"))


# --- P5-P7 -------------------------------------------------------------------------

@query("normalise_codes", """
WITH raw AS (
  SELECT c_custkey,
    list_element(['m', 'F', 'x', '', NULL], CAST(c_custkey % 5 + 1 AS INTEGER)) AS g,
    list_element(['s', 'M', 'd', 'W', 'q', 'w'], CAST(c_custkey % 6 + 1 AS INTEGER)) AS ms,
    list_element(['o', 'R', 'x'], CAST(c_custkey % 3 + 1 AS INTEGER)) AS orf,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS ln,
    CASE WHEN c_custkey % 11 = 0 THEN '   ' ELSE 'City ' || CAST(c_nationkey AS VARCHAR) END AS city
  FROM customer)
SELECT c_custkey,
  CASE WHEN upper(g) IN ('M', 'F') THEN upper(g) ELSE 'U' END AS gender,
  CASE WHEN upper(ms) IN ('S', 'M', 'D', 'W') THEN upper(ms) ELSE 'U' END AS marital_status,
  CASE WHEN upper(orf) IN ('O', 'R') THEN upper(orf) ELSE 'U' END AS own_or_rent,
  coalesce(ln, '') AS last_name,
  CASE WHEN trim(city) = '' THEN NULL ELSE city END AS city
FROM raw""")
def q_normalise_codes(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    raw = c.select(
        "c_custkey",
        F.element_at(F.array(F.lit("m"), F.lit("F"), F.lit("x"), F.lit(""), F.lit(None).cast("string")),
                     (_k(5) + 1).cast("int")).alias("g"),
        F.element_at(F.array(*[F.lit(x) for x in ("s", "M", "d", "W", "q", "w")]), (_k(6) + 1).cast("int")).alias("ms"),
        F.element_at(F.array(*[F.lit(x) for x in ("o", "R", "x")]), (_k(3) + 1).cast("int")).alias("orf"),
        F.when(_k(7) == 0, F.lit(None)).otherwise(F.col("c_name")).alias("ln"),
        F.when(_k(11) == 0, F.lit("   ")).otherwise(F.concat(F.lit("City "), F.col("c_nationkey").cast("string")))
         .alias("city"))
    return raw.select(
        "c_custkey",
        CL.normalise_code("g", CL.GENDER_CODES).alias("gender"),
        CL.normalise_code("ms", CL.MARITAL_CODES).alias("marital_status"),
        CL.normalise_code("orf", CL.OWN_RENT_CODES).alias("own_or_rent"),
        CL.null_to_empty("ln").alias("last_name"),
        CL.blank_to_null("city").alias("city"))


# --- F4 nameplate tags -----------------------------------------------------------

_TAG_INPUT_SQL = """
t AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE (c_custkey * 7919) % 2000001 END AS net_worth,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE (c_custkey * 104729) % 300001 END AS income,
    CAST(c_custkey % 6 AS INTEGER) AS children,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST((c_custkey // 3) % 9 AS INTEGER) END AS cards,
    CAST(18 + c_custkey % 70 AS INTEGER) AS age,
    CAST(300 + (c_custkey * 13) % 550 AS INTEGER) AS credit_rating,
    CAST((c_custkey // 7) % 6 AS INTEGER) AS cars
  FROM customer)"""


def tag_inputs(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.when(_k(10) == 0, F.lit(None)).otherwise((F.col("c_custkey") * 7919) % 2000001).alias("net_worth"),
        F.when(_k(13) == 0, F.lit(None)).otherwise((F.col("c_custkey") * 104729) % 300001).alias("income"),
        _k(6).cast("int").alias("children"),
        F.when(_k(17) == 0, F.lit(None)).otherwise((F.floor(F.col("c_custkey") / 3) % 9).cast("int")).alias("cards"),
        (18 + _k(70)).cast("int").alias("age"),
        (300 + (F.col("c_custkey") * 13) % 550).cast("int").alias("credit_rating"),
        (F.floor(F.col("c_custkey") / 7) % 6).cast("int").alias("cars"))


@query("nameplate_tags", "WITH " + _TAG_INPUT_SQL + """
SELECT c_custkey, nullif(concat_ws('+',
  CASE WHEN net_worth IS NOT NULL AND income IS NOT NULL AND (net_worth > 1000000 OR income > 200000) THEN 'HighValue' END,
  CASE WHEN children IS NOT NULL AND cards IS NOT NULL AND (children > 3 OR cards > 5) THEN 'Expenses' END,
  CASE WHEN age IS NOT NULL AND age > 45 THEN 'Boomer' END,
  CASE WHEN income IS NOT NULL AND credit_rating IS NOT NULL AND net_worth IS NOT NULL
        AND (income < 50000 OR credit_rating < 600 OR net_worth < 100000) THEN 'MoneyAlert' END,
  CASE WHEN cars IS NOT NULL AND cards IS NOT NULL AND (cars > 3 OR cards > 7) THEN 'Spender' END,
  CASE WHEN age IS NOT NULL AND net_worth IS NOT NULL AND age < 25 AND net_worth > 1000000 THEN 'Inherited' END
), '') AS tags
FROM t""")
def q_nameplate_tags(spark, sf_dir):
    t = tag_inputs(spark, sf_dir)
    return t.select("c_custkey", CL.nameplate_tags("net_worth", "income", "children", "cards", "age",
                                                   "credit_rating", "cars").alias("tags"))


# --- F3 phone format -------------------------------------------------------------------

_PHONE_SQL = """
ph AS (
  SELECT c_custkey,
    CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '1' END AS ctry,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END AS area,
    CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN ''
         ELSE lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0') END AS loc,
    CASE c_custkey % 3 WHEN 0 THEN lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0')
         WHEN 1 THEN '' ELSE NULL END AS ext
  FROM customer),
phone AS (
  SELECT c_custkey,
    CASE WHEN coalesce(ext, '') <> '' THEN base || ext ELSE base END AS phone
  FROM (SELECT c_custkey, ext,
          CASE WHEN coalesce(ctry, '') <> '' AND coalesce(area, '') <> '' AND coalesce(loc, '') <> ''
                 THEN '+' || ctry || ' (' || area || ') ' || loc
               WHEN coalesce(area, '') <> '' AND coalesce(loc, '') <> '' THEN '(' || area || ') ' || loc
               WHEN coalesce(loc, '') <> '' THEN loc END AS base
        FROM ph) x)"""


def phone_parts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        F.when(_k(4) == 0, F.lit(None)).when(_k(4) == 1, F.lit("")).otherwise(F.lit("1")).alias("ctry"),
        F.when(_k(5) == 0, F.lit(None)).otherwise(F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("area"),
        F.when(_k(9) == 0, F.lit(None)).when(_k(9) == 1, F.lit(""))
         .otherwise(F.lpad((F.col("c_custkey") % 10000000).cast("string"), 7, "0")).alias("loc"),
        F.when(_k(3) == 0, F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"))
         .when(_k(3) == 1, F.lit("")).alias("ext"))


@query("phone_format", "WITH " + _PHONE_SQL + " SELECT c_custkey, phone FROM phone")
def q_phone_format(spark, sf_dir):
    p = phone_parts(spark, sf_dir)
    return p.select("c_custkey", CL.format_phone("ctry", "area", "loc", "ext").alias("phone"))


# --- F1-F12 in one projection ------------------------------------------------------

@query("scalar_suite", """
SELECT o_orderkey,
  trim('  ' || o_orderpriority || ' ') AS trimmed,
  upper(lower(o_orderstatus)) AS status_upper,
  CAST(length(o_orderpriority) AS INTEGER) AS priority_len,
  regexp_matches(o_orderpriority, '^(1|2)-') AS is_high,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority || '/' || o_orderstatus END AS poisoned,
  CAST(o_orderdate AS DATE) AS order_date,
  strftime(o_orderdate, '%H:%M:%S') AS order_time,
  CAST(o_orderdate AS DATE) - 1 AS day_before,
  CAST(CAST(o_orderdate AS DATE) - INTERVAL 100 YEAR AS DATE) AS century_before,
  CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
  CAST(day(o_orderdate) AS INTEGER) AS d,
  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority_no,
  CAST(o_totalprice AS DOUBLE) / NULLIF(CAST(o_orderkey % 3 AS DOUBLE), 0) AS share,
  coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END, '?') AS status_or_q,
  (CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END) IS NOT NULL AS has_status,
  strftime(o_orderdate, '%Y%m%d') AS date_key
FROM orders""")
def q_scalar_suite(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ts = F.col("o_orderdate")
    maybe = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    return o.select(
        "o_orderkey",
        F.trim(F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))).alias("trimmed"),
        F.upper(F.lower("o_orderstatus")).alias("status_upper"),
        F.length("o_orderpriority").alias("priority_len"),
        F.col("o_orderpriority").rlike("^(1|2)-").alias("is_high"),
        F.concat(F.col("o_orderpriority"), F.lit("/"),
                 F.when(F.col("o_orderkey") % 2 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))).alias("poisoned"),
        F.to_date(ts).alias("order_date"),
        F.date_format(ts, "HH:mm:ss").alias("order_time"),
        F.date_sub(F.to_date(ts), 1).alias("day_before"),
        F.add_months(F.to_date(ts), -1200).alias("century_before"),
        F.year(ts).alias("y"), F.month(ts).alias("m"), F.dayofmonth(ts).alias("d"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("priority_no"),
        F.try_divide(F.col("o_totalprice"), (F.col("o_orderkey") % 3).cast("double")).alias("share"),
        F.coalesce(maybe, F.lit("?")).alias("status_or_q"),
        maybe.isNotNull().alias("has_status"),
        F.date_format(ts, "yyyyMMdd").alias("date_key"))


# --- P9 LIKE patterns ---------------------------------------------------------------

@query("format_checks", "WITH " + _PHONE_SQL + """
SELECT 'customer_name' AS check_name, count(*) AS total,
       count(*) FILTER (WHERE c_name LIKE 'Customer#_________') AS matching FROM customer
UNION ALL
SELECT 'supplier_name', count(*), count(*) FILTER (WHERE s_name LIKE 'Supplier#%') FROM supplier
UNION ALL
SELECT 'phone_full', count(*), count(*) FILTER (WHERE phone LIKE '+_ (___) _______%') FROM phone
UNION ALL
SELECT 'phone_area', count(*), count(*) FILTER (WHERE phone LIKE '(___) _______%') FROM phone
UNION ALL
SELECT 'phone_local', count(*), count(*) FILTER (WHERE phone LIKE '_______%' AND phone NOT LIKE '%(%') FROM phone
UNION ALL
SELECT 'part_brand', count(*), count(*) FILTER (WHERE p_brand LIKE 'Brand#_%') FROM part""")
def q_format_checks(spark, sf_dir):
    c, s, p = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    ph = phone_parts(spark, sf_dir).select(CL.format_phone("ctry", "area", "loc", "ext").alias("phone"))

    def chk(df, name, pred):
        return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.coalesce(pred, F.lit(False))).alias("matching")) \
                 .select(F.lit(name).alias("check_name"), "total", "matching")
    phone = F.col("phone")
    return (chk(c, "customer_name", F.col("c_name").like("Customer#_________"))
            .unionByName(chk(s, "supplier_name", F.col("s_name").like("Supplier#%")))
            .unionByName(chk(ph, "phone_full", phone.like("+_ (___) _______%")))
            .unionByName(chk(ph, "phone_area", phone.like("(___) _______%")))
            .unionByName(chk(ph, "phone_local", phone.like("_______%") & ~phone.like("%(%")))
            .unionByName(chk(p, "part_brand", F.col("p_brand").like("Brand#_%"))))


# --- P10 / P11 --------------------------------------------------------------------

@query("check_financials", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS batch_id, count(*) AS lines,
  count(*) FILTER (WHERE l_discount NOT BETWEEN 0.02 AND 0.08) AS discount_outside,
  count(*) FILTER (WHERE l_tax IS NULL OR l_tax = 0) AS untaxed,
  count(*) FILTER (WHERE (l_quantity > 45 AND l_discount > 0.07) OR (l_returnflag = 'R' AND l_linestatus = 'O')) AS compound
FROM lineitem GROUP BY 1""")
def q_check_financials(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.year("l_shipdate").cast("int").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~F.col("l_discount").between(0.02, 0.08)).alias("discount_outside"),
        F.count_if(F.col("l_tax").isNull() | (F.col("l_tax") == 0)).alias("untaxed"),
        F.count_if(((F.col("l_quantity") > 45) & (F.col("l_discount") > 0.07))
                   | ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))).alias("compound"))
