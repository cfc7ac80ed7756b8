"""Warehouse driver queries (T1-T17) through the shape adapter.

Each builder runs the real transform of ``histmart.plans.warehouse`` on the
raw-shaped extracts the adapter derives from the given tables; each SQL twin
computes the same table straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from histmart.plans import adapter as A
from histmart.plans import warehouse as W
from histmart.plans.q_sources import _ACTIONS_SQL, _VALID_SQL, CMP_SQL, FIN_SQL, SEC_SQL
from histmart.plans.registry import query, table
from histmart.session import compiled_methods, materialize, tasks_for
from histmart.sources import readers as R

BATCH_DATE = "2000-01-01"

# --- shared builders ----------------------------------------------------------------------


def _first_day(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.min(F.col("o_orderdate").cast("date"))).scalar()


def _finwire(spark, sf_dir):
    """Parsed FINWIRE lines feed three dimensions: staged once."""
    return materialize(R.parse_fixed_width(A.finwire_lines(spark, sf_dir)), "finwire")


def build_company(spark, sf_dir, parsed=None):
    parsed = parsed if parsed is not None else _finwire(spark, sf_dir)
    return W.dim_company(R.fixed_width_records(parsed, "CMP"), W.status_types(spark), A.industries(spark, sf_dir))


def build_security(spark, sf_dir, company=None, parsed=None):
    parsed = parsed if parsed is not None else _finwire(spark, sf_dir)
    company = company if company is not None else build_company(spark, sf_dir, parsed)
    return W.dim_security(R.fixed_width_records(parsed, "SEC"), company, W.status_types(spark))


def build_financial(spark, sf_dir, company=None, parsed=None):
    parsed = parsed if parsed is not None else _finwire(spark, sf_dir)
    company = company if company is not None else build_company(spark, sf_dir, parsed)
    return W.fact_financial(R.fixed_width_records(parsed, "FIN"), company)


def _actions(spark, sf_dir):
    """Parsed customer actions feed customer and account: staged once."""
    with compiled_methods(spark):
        return materialize(R.parse_actions(A.action_xml(spark, sf_dir), "value", "seq"), "actions")


def build_customer(spark, sf_dir, actions=None):
    actions = actions if actions is not None else _actions(spark, sf_dir)
    return W.dim_customer(actions, A.tax_rates(spark, sf_dir), W.prospect_rows(A.prospect_records(spark, sf_dir)))


def build_broker(spark, sf_dir):
    return W.dim_broker(A.hr_records(spark, sf_dir), _first_day(spark, sf_dir))


def build_account(spark, sf_dir, actions=None, customer=None):
    actions = actions if actions is not None else _actions(spark, sf_dir)
    customer = customer if customer is not None else build_customer(spark, sf_dir, actions)
    return W.dim_account(actions, customer, build_broker(spark, sf_dir))


def build_trade(spark, sf_dir):
    parsed = _finwire(spark, sf_dir)
    company = build_company(spark, sf_dir, parsed)
    security = build_security(spark, sf_dir, company, parsed)
    account = build_account(spark, sf_dir, _actions(spark, sf_dir))
    return W.dim_trade(A.trade_records(spark, sf_dir), A.trade_history(spark, sf_dir), security, account,
                       W.status_types(spark), W.trade_types(spark))


# --- shared SQL -------------------------------------------------------------------------------

DATE_KEY = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"

COMPANY_SQL = CMP_SQL + f""",
c1 AS (
  SELECT CAST(s_suppkey AS BIGINT) AS company_id, pts, CompanyName AS name,
    CASE Status WHEN 'ACTV' THEN 'Active' WHEN 'INAC' THEN 'Inactive' END AS status,
    'Industry ' || n.n_name AS industry,
    CASE WHEN SPrating IN {_VALID_SQL} THEN SPrating END AS sp_rating,
    CASE WHEN SPrating IN {_VALID_SQL} THEN NOT (SPrating LIKE 'A%' OR SPrating LIKE 'BBB%') END AS is_lowgrade,
    CEOname AS ceo, AddrLine1 AS address_line1, CAST(NULL AS VARCHAR) AS address_line2,
    PostalCode AS postal_code, City AS city, 'ST' AS state_prov, 'Country' AS country,
    Description AS description, CAST(FoundingDate AS DATE) AS founding_date
  FROM cmp LEFT JOIN nation n ON cmp.IndustryID = lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')),
c2 AS (SELECT *, LEAD(CAST(pts AS DATE)) OVER (PARTITION BY company_id ORDER BY pts) AS nd FROM c1),
c3 AS (SELECT *, CAST(pts AS DATE) AS effective_date FROM c2 WHERE nd IS NULL OR nd > CAST(pts AS DATE)),
c4 AS (SELECT *, ROW(name, status, industry, sp_rating, is_lowgrade, ceo, address_line1, address_line2,
                      postal_code, city, state_prov, country, description, founding_date) AS attrs FROM c3),
c5 AS (SELECT * FROM (SELECT *, attrs IS DISTINCT FROM LAG(attrs) OVER (PARTITION BY company_id
                       ORDER BY effective_date) AS changed FROM c4) WHERE changed),
company AS (
  SELECT company_id, name, status, industry, sp_rating, is_lowgrade, ceo, address_line1, address_line2,
    postal_code, city, state_prov, country, description, founding_date, effective_date,
    COALESCE(LEAD(effective_date) OVER (PARTITION BY company_id ORDER BY effective_date), DATE '9999-12-31') AS end_date,
    1 AS batch_id, row_number() OVER (ORDER BY company_id, effective_date) AS sk_companyid
  FROM c5)"""

_COMPANY_COLS = ("sk_companyid, company_id, name, status, industry, sp_rating, is_lowgrade, ceo, address_line1, "
                 "address_line2, postal_code, city, state_prov, country, description, founding_date, "
                 "end_date = DATE '9999-12-31' AS is_current, batch_id, effective_date, end_date")

FINANCIAL_PART = """
financial AS (
  SELECT c.sk_companyid, CAST(year(f.qstart) AS INTEGER) AS fi_year, CAST(quarter(f.qstart) AS INTEGER) AS fi_qtr,
    f.qstart AS fi_qtr_start_date, CAST(f.rev AS DECIMAL(15,2)) AS fi_revenue,
    CAST(f.earn AS DECIMAL(18,4)) AS fi_net_earn,
    CAST(CAST((CAST(f.earn * 10000 AS BIGINT) * 2 + 100000) // 200000 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS fi_basic_eps,
    CAST(CAST((CAST(f.earn * 10000 AS BIGINT) * 2 + 110000) // 220000 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS fi_dilut_eps,
    CASE WHEN f.rev <> 0 THEN CAST(CAST((CAST(f.earn * 10000 AS BIGINT) * 2 + CAST(f.rev * 100 AS BIGINT))
         // (CAST(f.rev * 100 AS BIGINT) * 2) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) END AS fi_margin,
    CAST(0 AS DECIMAL(15,2)) AS fi_inventory, CAST(f.rev AS DECIMAL(15,2)) AS fi_assets,
    CAST(f.earn AS DECIMAL(18,4)) AS fi_liability, CAST(1000 AS BIGINT) AS fi_out_basic,
    CAST(1100 AS BIGINT) AS fi_out_dilut
  FROM fin f JOIN company c
    ON ((length(f.CoNameOrCIK) = 10 AND CAST(f.CoNameOrCIK AS BIGINT) = c.company_id)
        OR (length(f.CoNameOrCIK) <> 10 AND f.CoNameOrCIK = c.name))
   AND f.posting >= c.effective_date AND f.posting < c.end_date)"""
FINANCIAL_SQL = COMPANY_SQL + "," + FIN_SQL + "," + FINANCIAL_PART

SECURITY_PART = """
s1 AS (
  SELECT sec.Symbol AS symbol, sec.pts, 'COMMON' AS issue,
    CASE sec.Status WHEN 'ACTV' THEN 'Active' WHEN 'INAC' THEN 'Inactive' END AS status, sec.Name AS name,
    'NYSE' AS exchange_id, c.sk_companyid, CAST(p.p_size * 1000 AS BIGINT) AS shares_outstanding,
    DATE '1995-01-01' AS first_trade, DATE '1995-01-01' AS first_trade_on_exchange, sec.Dividend AS dividend
  FROM sec JOIN part p ON p.p_partkey = sec.p_partkey JOIN company c
    ON ((length(sec.CoNameOrCIK) = 10 AND CAST(sec.CoNameOrCIK AS BIGINT) = c.company_id)
        OR (length(sec.CoNameOrCIK) <> 10 AND sec.CoNameOrCIK = c.name))
   AND CAST(sec.pts AS DATE) >= c.effective_date AND CAST(sec.pts AS DATE) < c.end_date),
s2 AS (SELECT *, LEAD(CAST(pts AS DATE)) OVER (PARTITION BY symbol ORDER BY pts) AS nd FROM s1),
security AS (
  SELECT symbol, issue, status, name, exchange_id, sk_companyid, shares_outstanding, first_trade,
    first_trade_on_exchange, dividend, CAST(pts AS DATE) AS effective_date,
    COALESCE(LEAD(CAST(pts AS DATE)) OVER (PARTITION BY symbol ORDER BY pts), DATE '9999-12-31') AS end_date,
    1 AS batch_id, row_number() OVER (ORDER BY symbol, CAST(pts AS DATE)) AS sk_securityid
  FROM s2 WHERE nd IS NULL OR nd > CAST(pts AS DATE))"""
SECURITY_SQL = COMPANY_SQL + "," + SEC_SQL + "," + SECURITY_PART


# --- T1 ---------------------------------------------------------------------------------------

@query("load_reference", """
WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
dd AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_dateid, d AS date_value,
  strftime(d, '%B %-d, %Y') AS date_desc, CAST(year(d) AS INTEGER) AS calendar_year_id,
  CAST(year(d) * 10 + quarter(d) AS INTEGER) AS calendar_qtr_id,
  CAST(year(d) * 100 + month(d) AS INTEGER) AS calendar_month_id, monthname(d) AS calendar_month_desc,
  CAST(year(d) * 100 + weekofyear(d) AS INTEGER) AS calendar_week_id,
  CAST(isodow(d) AS INTEGER) AS day_of_week_num, dayname(d) AS day_of_week_desc,
  CAST(year(d + INTERVAL 6 MONTH) AS INTEGER) AS fiscal_year_id,
  CAST(year(d + INTERVAL 6 MONTH) * 10 + quarter(d + INTERVAL 6 MONTH) AS INTEGER) AS fiscal_qtr_id,
  (month(d) = 1 AND day(d) = 1) OR (month(d) = 12 AND day(d) = 25) AS holiday_flag
FROM dd""")
def q_load_reference(spark, sf_dir):
    """Calendar dimension over the span of the order dates."""
    span = table(spark, sf_dir, "orders").agg(F.min(F.col("o_orderdate").cast("date")).alias("lo"),
                                              F.max(F.col("o_orderdate").cast("date")).alias("hi"))
    return W.dim_date("lo", "hi", span)


# --- T2 ---------------------------------------------------------------------------------------

@query("dim_broker", """
SELECT row_number() OVER (ORDER BY n.n_nationkey) AS sk_brokerid, CAST(n.n_nationkey AS BIGINT) AS broker_id,
  CAST(n.n_regionkey AS BIGINT) AS manager_id, n.n_name AS first_name, r.r_name AS last_name,
  CAST(NULL AS VARCHAR) AS middle_initial, 'Branch ' || CAST(n.n_regionkey AS VARCHAR) AS branch,
  'Office ' || CAST(n.n_nationkey AS VARCHAR) AS office, '555-' || lpad(CAST(n.n_nationkey AS VARCHAR), 4, '0') AS phone,
  true AS is_current, 1 AS batch_id, (SELECT CAST(min(o_orderdate) AS DATE) FROM orders) AS effective_date,
  DATE '9999-12-31' AS end_date
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE n.n_regionkey <> 0""")
def q_dim_broker(spark, sf_dir):
    """HR rows parsed from comma-separated text; job code 314 only; one
    version from the first calendar day."""
    return build_broker(spark, sf_dir)


# --- T3 ---------------------------------------------------------------------------------------

@query("dim_company", "WITH " + COMPANY_SQL + f" SELECT {_COMPANY_COLS} FROM company")
def q_dim_company(spark, sf_dir):
    """CMP records parsed from fixed width -> versioned company dimension."""
    return build_company(spark, sf_dir).select(*[c.strip().split(" AS ")[-1].split(" ")[-1]
                                                 for c in _COMPANY_COLS.split(",")])


# --- T4 ---------------------------------------------------------------------------------------

_FIN_COLS = ("sk_companyid, fi_year, fi_qtr, fi_qtr_start_date, fi_revenue, fi_net_earn, fi_basic_eps, "
             "fi_dilut_eps, fi_margin, fi_inventory, fi_assets, fi_liability, fi_out_basic, fi_out_dilut")


@query("fact_financial", "WITH " + FINANCIAL_SQL + f" SELECT {_FIN_COLS} FROM financial")
def q_fact_financial(spark, sf_dir):
    """FIN records tied to the company version at their posting date by id or name."""
    return build_financial(spark, sf_dir).select(*[c.strip() for c in _FIN_COLS.split(",")])


# --- T5 ---------------------------------------------------------------------------------------

_SEC_COLS = ("sk_securityid, symbol, issue, status, name, exchange_id, sk_companyid, shares_outstanding, "
             "first_trade, first_trade_on_exchange, dividend, batch_id, effective_date, end_date")


@query("dim_security", "WITH " + SECURITY_SQL + f"""
SELECT {_SEC_COLS}, end_date = DATE '9999-12-31' AS is_current FROM security""")
def q_dim_security(spark, sf_dir):
    """SEC records -> versioned security dimension, company at record date."""
    return build_security(spark, sf_dir).select(*[c.strip() for c in _SEC_COLS.split(",")], "is_current")


# --- T6, T7: prospects and customers ------------------------------------------------------------

def _prospect_sql(name: str, batch: int | None = None) -> str:
    """Rows of the prospect file (of batch 1, of batch 2, or whole) as a CTE."""
    where = {None: "true", 1: "c_custkey % 8 <> 3", 2: "c_custkey % 4 <> 1"}[batch]
    worth = "CASE WHEN c_custkey % 10 <> 0 THEN CAST((c_custkey * 7919) % 2000001 AS BIGINT) END"
    employer, city = "CASE WHEN c_custkey % 4 = 0 THEN 'Employer ' || c_nationkey END", "'City'"
    if batch == 2:
        worth = f"CASE WHEN c_custkey % 5 = 0 THEN coalesce({worth}, 0) + 100 ELSE {worth} END"
        employer = f"CASE WHEN c_custkey % 14 = 0 THEN 'New Employer' ELSE {employer} END"
        city = "CASE WHEN c_custkey % 22 = 0 THEN 'Village' ELSE 'City' END"
    return f"""
{name}0 AS (
  SELECT 'P' || CAST(c_custkey AS VARCHAR) AS agency_id,
    CASE WHEN c_custkey % 6 = 0 THEN c_name || ' Jr' ELSE c_name END AS last_name, 'F' || CAST(c_nationkey AS VARCHAR) AS first_name,
    CAST(NULL AS VARCHAR) AS middle_initial, list_element(['m', 'F', 'x', '', NULL], CAST(c_custkey % 5 + 1 AS INTEGER)) AS g,
    list_element(['s', 'M', 'd', 'W', 'q', 'w'], CAST(c_custkey % 6 + 1 AS INTEGER)) AS ms,
    list_element(['o', 'R', 'x'], CAST(c_custkey % 3 + 1 AS INTEGER)) AS orf,
    'Street ' || c_nationkey AS address_line1, CAST(NULL AS VARCHAR) AS address_line2, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS postal_code,
    {city} AS city, 'ST' AS state, 'Country' AS country, CASE WHEN c_custkey % 3 = 0 THEN '555-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') END AS phone,
    {employer} AS employer,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST((c_custkey * 104729) % 300001 AS BIGINT) END AS income,
    CAST((c_custkey // 7) % 6 AS INTEGER) AS number_cars, CAST(c_custkey % 6 AS INTEGER) AS number_children,
    CAST(18 + c_custkey % 70 AS INTEGER) AS age, CAST(300 + (c_custkey * 13) % 550 AS INTEGER) AS credit_rating,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST((c_custkey // 3) % 9 AS INTEGER) END AS number_credit_cards,
    {worth} AS net_worth
  FROM customer WHERE {where}),
{name} AS (
  SELECT * EXCLUDE (g, ms, orf), CASE WHEN upper(g) IN ('M', 'F') THEN upper(g) ELSE 'U' END AS gender,
    CASE WHEN upper(ms) IN ('S', 'M', 'D', 'W') THEN upper(ms) ELSE 'U' END AS marital_status,
    CASE WHEN upper(orf) IN ('O', 'R') THEN upper(orf) ELSE 'U' END AS own_or_rent,
    nullif(concat_ws('+',
      CASE WHEN net_worth IS NOT NULL AND income IS NOT NULL AND (net_worth > 1000000 OR income > 200000) THEN 'HighValue' END,
      CASE WHEN number_children IS NOT NULL AND number_credit_cards IS NOT NULL AND (number_children > 3 OR number_credit_cards > 5) THEN 'Expenses' END,
      CASE WHEN age IS NOT NULL AND age > 45 THEN 'Boomer' END,
      CASE WHEN income IS NOT NULL AND credit_rating IS NOT NULL AND net_worth IS NOT NULL
            AND (income < 50000 OR credit_rating < 600 OR net_worth < 100000) THEN 'MoneyAlert' END,
      CASE WHEN number_cars IS NOT NULL AND number_credit_cards IS NOT NULL AND (number_cars > 3 OR number_credit_cards > 7) THEN 'Spender' END,
      CASE WHEN age IS NOT NULL AND net_worth IS NOT NULL AND age < 25 AND net_worth > 1000000 THEN 'Inherited' END
    ), '') AS marketing_nameplate
  FROM {name}0)"""


_PERSON = ("first_name", "last_name", "address_line1", "address_line2", "postal_code")


def _same_person(a: str, b: str) -> str:
    return " AND ".join(f"upper({a}.{c}) IS NOT DISTINCT FROM upper({b}.{c})" for c in _PERSON)


_SENT = {"tax_id": "tax_id", "last_name": "l_name", "first_name": "f_name", "middle_initial": "m_name", "gender_raw": "gender", "tier": "tier", "dob": "dob",
         "address_line1": "adline1", "address_line2": "adline2", "postal_code": "zip", "city": "city", "state_prov": "state", "country": "country",
         "phone1": "phone1", "phone2": "phone2", "phone3": "phone3", "email1": "email", "email2": "email2", "nat": "nat_tx", "lcl": "lcl_tx"}
_FILLED = ",\n    ".join(f"last_value({c} IGNORE NULLS) OVER w AS {n}" for n, c in _SENT.items())
_BLANK = ", ".join(f"nullif(trim({n}), '') AS {n}" if n not in ("tier", "dob", "gender_raw", "nat", "lcl") else n for n in _SENT)
_ATTRS = ("tax_id, status, last_name, first_name, middle_initial, gender, tier, dob, address_line1, address_line2, postal_code, city, state_prov, country, "
          "phone1, phone2, phone3, email1, email2, national_tax_rate_desc, national_tax_rate, local_tax_rate_desc, local_tax_rate")
_MATCHED = "agency_id, credit_rating, net_worth, marketing_nameplate"

STATES_SQL = _ACTIONS_SQL + f""",
tax AS (SELECT 'TX' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS tx, 'Tax of ' || n_name AS tx_name,
               CAST(0.01 + n_nationkey * 0.005 AS DECIMAL(6,5)) AS tx_rate FROM nation),
cs0 AS (
  SELECT o_custkey AS customer_id, action_ts AS ts, ok AS seq, action_type,
    last_value(CASE action_type WHEN 'INACT' THEN 'INACTIVE' WHEN 'NEW' THEN 'ACTIVE' END IGNORE NULLS) OVER w AS status,
    {_FILLED}
  FROM act WHERE of_customer
  WINDOW w AS (PARTITION BY o_custkey ORDER BY action_ts, ok ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cs AS (
  SELECT customer_id, ts, seq, action_type, status, {_BLANK},
    CASE WHEN upper(gender_raw) IN ('M', 'F') THEN upper(gender_raw) ELSE 'U' END AS gender,
    t1.tx_name AS national_tax_rate_desc, t1.tx_rate AS national_tax_rate, t2.tx_name AS local_tax_rate_desc, t2.tx_rate AS local_tax_rate
  FROM cs0 LEFT JOIN tax t1 ON t1.tx = nullif(trim(nat), '') LEFT JOIN tax t2 ON t2.tx = nullif(trim(lcl), ''))"""


def _versions_sql(name: str, prospects: str, before: str = "true") -> str:
    """Customer versions from the states that meet a condition; the current ones are matched."""
    return f"""
{name}2 AS (SELECT *, LEAD(CAST(ts AS DATE)) OVER (PARTITION BY customer_id ORDER BY ts, seq) AS nd FROM cs WHERE {before}),
{name}3 AS (SELECT * EXCLUDE (nd), coalesce(nd, DATE '9999-12-31') AS end_date, CAST(ts AS DATE) AS effective_date
            FROM {name}2 WHERE nd IS NULL OR nd > CAST(ts AS DATE)),
{name} AS (
  SELECT v.customer_id, {", ".join("v." + c.strip() for c in _ATTRS.split(","))}, p.agency_id, p.credit_rating, p.net_worth, p.marketing_nameplate,
    v.effective_date, v.end_date, 1 AS batch_id, row_number() OVER (ORDER BY v.customer_id, v.effective_date) AS sk_customerid
  FROM {name}3 v LEFT JOIN {prospects} p ON v.end_date = DATE '9999-12-31' AND {_same_person("v", "p")})"""


CUSTOMER_SQL = STATES_SQL + "," + _prospect_sql("pr") + "," + _versions_sql("customer_v", "pr")

_CUSTOMER_COLS = f"sk_customerid, customer_id, {_ATTRS}, {_MATCHED}, batch_id, effective_date, end_date"


@query("dim_customer", "WITH " + CUSTOMER_SQL + f"""
SELECT {_CUSTOMER_COLS}, end_date = DATE '9999-12-31' AS is_current FROM customer_v""")
def q_dim_customer(spark, sf_dir):
    """Customer actions parsed from XML, forward-filled in file order (absent
    fields take the running state, empty ones are values), one version per
    action day, with phones, tax names and rates, and, for current versions,
    the prospect who is that person."""
    return build_customer(spark, sf_dir).select(*[c.strip() for c in _CUSTOMER_COLS.split(",")], "is_current")


# --- T10 account ------------------------------------------------------------------------------

def _accounts_sql(name: str, customer: str, before: str = "true") -> str:
    """Account versions from the actions that meet a condition on action_ts."""
    return f"""
{name}_own AS (SELECT * FROM own WHERE {before}),
{name}_open AS (SELECT ca_id, arg_min(k, (action_ts, ok)) AS k, min((action_ts, ok)) AS opened FROM {name}_own GROUP BY ca_id),
{name}_ev AS (
  SELECT ca_id, action_ts AS ts, ok AS seq, action_type, k, ca_tax_st, ca_b_id, ca_name, CASE action_type WHEN 'CLOSEACCT' THEN 'INACTIVE' ELSE 'ACTIVE' END AS st
  FROM {name}_own
  UNION ALL
  SELECT o.ca_id, a.action_ts, a.ok, a.action_type, NULL, NULL, NULL, NULL, CASE a.action_type WHEN 'INACT' THEN 'INACTIVE' END
  FROM act a JOIN {name}_open o ON a.k = o.k WHERE a.action_type IN ('UPDCUST', 'INACT') AND (a.action_ts, a.ok) > o.opened AND {before}),
{name}_st AS (
  SELECT ca_id AS account_id, ts, seq, action_type, last_value(k IGNORE NULLS) OVER w AS customer_id, last_value(ca_tax_st IGNORE NULLS) OVER w AS tax_status,
    last_value(ca_b_id IGNORE NULLS) OVER w AS broker_id, last_value(ca_name IGNORE NULLS) OVER w AS account_desc, last_value(st IGNORE NULLS) OVER w AS status
  FROM {name}_ev WINDOW w AS (PARTITION BY ca_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{name}_nd AS (SELECT *, LEAD(CAST(ts AS DATE)) OVER (PARTITION BY account_id ORDER BY ts, seq) AS nd FROM {name}_st),
{name} AS (
  SELECT a.account_id, b.sk_brokerid, c.sk_customerid, a.customer_id, a.broker_id, a.status, a.account_desc, a.tax_status, 1 AS batch_id,
    CAST(a.ts AS DATE) AS effective_date, coalesce(a.nd, DATE '9999-12-31') AS end_date,
    row_number() OVER (ORDER BY a.account_id, a.ts) AS sk_accountid
  FROM {name}_nd a
  LEFT JOIN {customer} c ON a.customer_id = c.customer_id AND CAST(a.ts AS DATE) >= c.effective_date AND CAST(a.ts AS DATE) < c.end_date
  LEFT JOIN broker b ON a.broker_id = b.broker_id AND CAST(a.ts AS DATE) >= b.effective_date AND CAST(a.ts AS DATE) < b.end_date
  WHERE a.nd IS NULL OR a.nd > CAST(a.ts AS DATE))"""


_BROKER_SQL = """
broker AS (SELECT row_number() OVER (ORDER BY n_nationkey) AS sk_brokerid, CAST(n_nationkey AS BIGINT) AS broker_id,
                  (SELECT CAST(min(o_orderdate) AS DATE) FROM orders) AS effective_date, DATE '9999-12-31' AS end_date
           FROM nation WHERE n_regionkey <> 0)"""
ACCOUNT_SQL = CUSTOMER_SQL + "," + _BROKER_SQL + "," + _accounts_sql("account_v", "customer_v")

_ACCOUNT_COLS = ("sk_accountid, account_id, sk_brokerid, sk_customerid, status, account_desc, tax_status, "
                 "batch_id, effective_date, end_date")


@query("dim_account", "WITH " + ACCOUNT_SQL + f"""
SELECT {_ACCOUNT_COLS}, end_date = DATE '9999-12-31' AS is_current FROM account_v""")
def q_dim_account(spark, sf_dir):
    """Accounts opened, changed and closed by their own actions, and reached by
    those on their customer, replayed as one stream; customer and broker as
    of the start of each version."""
    return build_account(spark, sf_dir).select(*[c.strip() for c in _ACCOUNT_COLS.split(",")], "is_current")


# --- T6 prospect ------------------------------------------------------------------------------

_PROSPECT_COLS = ("agency_id, last_name, first_name, middle_initial, gender, address_line1, address_line2, postal_code, city, state, country, phone, income, "
                  "number_cars, number_children, marital_status, age, credit_rating, own_or_rent, employer, number_credit_cards, net_worth, marketing_nameplate")


def _is_customer(customer: str, p: str = "pr") -> str:
    return (f"EXISTS (SELECT 1 FROM {customer} cv WHERE cv.end_date = DATE '9999-12-31' AND cv.status = 'ACTIVE' AND {_same_person('cv', p)}) AS is_customer")


@query("prospect_load", "WITH " + CUSTOMER_SQL + f"""
SELECT {_PROSPECT_COLS}, 20000101 AS sk_recorddateid, 20000101 AS sk_updatedateid, 1 AS batch_id, {_is_customer("customer_v")} FROM pr""")
def q_prospect_load(spark, sf_dir):
    """Prospect file: all columns, normalised codes, marketing tags, and the
    is-customer flag against current active customers (five fields, null-safe)."""
    return W.prospect_load(A.prospect_records(spark, sf_dir), W.current_active(build_customer(spark, sf_dir)), BATCH_DATE)


# --- T12 trade ------------------------------------------------------------------------------

TRADE_SQL = (COMPANY_SQL + "," + SEC_SQL + "," + SECURITY_PART + "," + ACCOUNT_SQL.split(_ACTIONS_SQL, 1)[0]
             + _ACTIONS_SQL + ACCOUNT_SQL.split(_ACTIONS_SQL, 1)[1] + """,
ol AS (SELECT l_orderkey, CAST(sum(l_quantity) AS INTEGER) AS qty, min(l_partkey) AS part,
              max(l_shipdate) AS max_ship,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS comm,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS tax
       FROM lineitem GROUP BY 1),
tr AS (SELECT o.o_orderkey AS t_id, o.o_orderdate, o.o_orderstatus, o.o_custkey, o.o_totalprice, ol.*
       FROM orders o JOIN ol ON o.o_orderkey = ol.l_orderkey),
th AS (SELECT t_id, o_orderdate AS ts, CASE WHEN t_id % 2 = 0 THEN 'PNDG' ELSE 'SBMT' END AS st FROM tr
       UNION ALL
       SELECT t_id, greatest(max_ship, o_orderdate) + INTERVAL 12 HOUR,
              CASE WHEN o_orderstatus = 'F' THEN 'CMPT' ELSE 'CNCL' END
       FROM tr WHERE o_orderstatus IN ('F', 'P')),
life AS (SELECT t_id, min(ts) FILTER (WHERE st IN ('PNDG', 'SBMT')) AS create_ts,
                max(ts) FILTER (WHERE st IN ('CMPT', 'CNCL')) AS close_ts FROM th GROUP BY t_id),
trade AS (
  SELECT tr.t_id AS trade_id, a.sk_brokerid,
    CAST(strftime(l.create_ts, '%Y%m%d') AS INTEGER) AS sk_createdateid,
    CAST(hour(l.create_ts) * 3600 + minute(l.create_ts) * 60 + second(l.create_ts) AS INTEGER) AS sk_createtimeid,
    CAST(strftime(l.close_ts, '%Y%m%d') AS INTEGER) AS sk_closedateid,
    CAST(hour(l.close_ts) * 3600 + minute(l.close_ts) * 60 + second(l.close_ts) AS INTEGER) AS sk_closetimeid,
    CASE tr.o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Canceled' ELSE 'Submitted' END AS status,
    list_element(['Limit-Buy', 'Limit-Sell', 'Market Buy', 'Market Sell'], CAST(tr.t_id % 4 + 1 AS INTEGER)) AS type,
    tr.t_id % 3 <> 0 AS cash_flag, s.sk_securityid, s.sk_companyid, tr.qty AS quantity,
    CAST(tr.o_totalprice AS DECIMAL(10,2)) AS bid_price, a.sk_customerid, a.sk_accountid,
    'exec ' || CAST(tr.t_id % 10 AS VARCHAR) AS executed_by,
    CASE WHEN tr.o_orderstatus = 'F' THEN CAST(tr.o_totalprice AS DECIMAL(10,2)) END AS trade_price,
    CAST(tr.qty AS DECIMAL(10,2)) AS fee, tr.comm AS commission, tr.tax, 1 AS batch_id
  FROM tr JOIN life l ON tr.t_id = l.t_id
  JOIN security s ON s.symbol = 'S' || lpad(CAST(tr.part AS VARCHAR), 9, '0')
   AND CAST(l.create_ts AS DATE) >= s.effective_date AND CAST(l.create_ts AS DATE) < s.end_date
  JOIN account_v a ON a.account_id = tr.o_custkey * 2 + tr.t_id % 2
   AND CAST(l.create_ts AS DATE) >= a.effective_date AND CAST(l.create_ts AS DATE) < a.end_date)""")


@query("dim_trade", "WITH " + TRADE_SQL + " SELECT * FROM trade")
def q_dim_trade(spark, sf_dir):
    """Trades with lifecycle stamps from their history, code names, and the
    security and account versions in force at creation."""
    return build_trade(spark, sf_dir)


# --- T14 cash ---------------------------------------------------------------------------------

@query("fact_cash", "WITH " + ACCOUNT_SQL + """,
ct AS (SELECT user_id * 2 + event_id % 2 AS ca_id, ts,
              CASE WHEN event_type = 'purchase' THEN -CAST(value AS DECIMAL(15,2))
                   ELSE CAST(value AS DECIMAL(15,2)) END AS amt FROM events),
daily AS (SELECT ca_id, CAST(ts AS DATE) AS day, CAST(sum(amt) AS DECIMAL(38,2)) AS day_net FROM ct GROUP BY 1, 2),
bal AS (SELECT *, CAST(sum(day_net) OVER (PARTITION BY ca_id ORDER BY day
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS cash FROM daily)
SELECT a.sk_customerid, a.sk_accountid, CAST(strftime(bal.day, '%Y%m%d') AS INTEGER) AS sk_dateid,
       bal.cash, 1 AS batch_id
FROM bal JOIN account_v a ON a.account_id = bal.ca_id AND bal.day >= a.effective_date AND bal.day < a.end_date""")
def q_fact_cash(spark, sf_dir):
    """Cash transactions -> one row per account and day, running balance,
    keys of the account version of that day."""
    return W.fact_cash(A.cash_records(spark, sf_dir), build_account(spark, sf_dir))


# --- T15 holdings ------------------------------------------------------------------------------

@query("fact_holdings", "WITH " + TRADE_SQL + """
SELECT l.l_orderkey AS trade_id, l.l_orderkey AS current_trade_id, t.sk_customerid, t.sk_accountid,
       t.sk_securityid, t.sk_companyid, t.trade_price AS current_price,
       CAST(l.l_quantity AS INTEGER) AS current_holding, t.sk_closedateid AS sk_dateid,
       t.sk_closetimeid AS sk_timeid, 1 AS batch_id
FROM lineitem l JOIN trade t ON l.l_orderkey = t.trade_id""")
def q_fact_holdings(spark, sf_dir):
    """Holding changes enriched with the keys and price of their trade."""
    return W.fact_holdings(A.holding_records(spark, sf_dir), build_trade(spark, sf_dir))


# --- T16 market history ---------------------------------------------------------------------

@query("fact_market", "WITH " + COMPANY_SQL + "," + FIN_SQL + "," + FINANCIAL_PART + "," + SEC_SQL + ","
       + SECURITY_PART + """,
dm AS (SELECT 'S' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS sym, CAST(l_shipdate AS DATE) AS day,
              arg_max(CAST(l_extendedprice AS DECIMAL(15,2)), l_orderkey * 100 + l_linenumber) AS close,
              max(CAST(l_extendedprice AS DECIMAL(15,2))) AS hi, min(CAST(l_extendedprice AS DECIMAL(15,2))) AS lo,
              CAST(sum(l_quantity) AS BIGINT) AS vol
       FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE)),
roll AS (SELECT dm.*, max(hi) OVER w AS high_365, min(lo) OVER w AS low_365 FROM dm
         WINDOW w AS (PARTITION BY sym ORDER BY day RANGE BETWEEN INTERVAL 364 DAYS PRECEDING AND CURRENT ROW)),
roll2 AS (SELECT r.*,
  (SELECT max(d.day) FROM dm d WHERE d.sym = r.sym AND d.day > r.day - INTERVAL 365 DAY AND d.day <= r.day
     AND d.hi = r.high_365) AS high_date,
  (SELECT max(d.day) FROM dm d WHERE d.sym = r.sym AND d.day > r.day - INTERVAL 365 DAY AND d.day <= r.day
     AND d.lo = r.low_365) AS low_date
  FROM roll r),
eps AS (SELECT c.company_id, f.fi_qtr_start_date AS q, sum(f.fi_basic_eps) AS eps
        FROM financial f JOIN company c ON f.sk_companyid = c.sk_companyid GROUP BY 1, 2),
eps4 AS (SELECT company_id, q, sum(eps) OVER (PARTITION BY company_id ORDER BY q
                ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS eps_4q FROM eps),
mk AS (SELECT s.sk_securityid, s.sk_companyid, s.dividend, c.company_id, r.*
       FROM roll2 r JOIN security s ON s.symbol = r.sym AND r.day >= s.effective_date AND r.day < s.end_date
       LEFT JOIN company c ON c.sk_companyid = s.sk_companyid)
SELECT mk.sk_securityid, mk.sk_companyid, CAST(strftime(mk.day, '%Y%m%d') AS INTEGER) AS sk_dateid,
  CAST(mk.close AS DOUBLE) / NULLIF(CAST(e.eps_4q AS DOUBLE), 0) AS pe_ratio,
  CAST(mk.dividend AS DOUBLE) / NULLIF(CAST(mk.close AS DOUBLE), 0) * 100 AS yield,
  mk.high_365 AS fifty_two_week_high, CAST(strftime(mk.high_date, '%Y%m%d') AS INTEGER) AS sk_fiftytwoweekhighdate,
  mk.low_365 AS fifty_two_week_low, CAST(strftime(mk.low_date, '%Y%m%d') AS INTEGER) AS sk_fiftytwoweeklowdate,
  mk.close AS close_price, mk.hi AS day_high, mk.lo AS day_low, mk.vol AS volume, 1 AS batch_id
FROM mk LEFT JOIN eps4 e ON e.company_id = mk.company_id AND e.q >= mk.day - INTERVAL 3 MONTH AND e.q < mk.day""")
def q_fact_market(spark, sf_dir):
    """Daily market with 52-week extremes and their dates, yield, and P/E on
    the company's trailing four quarters of EPS."""
    parsed = _finwire(spark, sf_dir)
    company = build_company(spark, sf_dir, parsed)
    security = build_security(spark, sf_dir, company, parsed)
    financial = build_financial(spark, sf_dir, company, parsed)
    return W.fact_market(A.market_records(spark, sf_dir), security, company, financial, tasks_for(table(spark, sf_dir, "lineitem")))


# --- T17 watches ------------------------------------------------------------------------------

@query("fact_watches", "WITH " + COMPANY_SQL + "," + SEC_SQL + "," + SECURITY_PART + "," + CUSTOMER_SQL + """,
w AS (SELECT user_id AS c_id,
             'S' || lpad(CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % (SELECT count(*) FROM part) AS VARCHAR), 9, '0') AS sym,
             ts, CASE WHEN event_type = 'click' THEN 'ACTV' ELSE 'CNCL' END AS act
      FROM events WHERE event_type IN ('click', 'error')),
wg AS (SELECT c_id, sym, min(ts) FILTER (WHERE act = 'ACTV') AS placed,
              max(ts) FILTER (WHERE act = 'CNCL') AS removed FROM w GROUP BY 1, 2)
SELECT cv.sk_customerid, s.sk_securityid, CAST(strftime(wg.placed, '%Y%m%d') AS INTEGER) AS sk_dateid_dateplaced,
       CAST(strftime(wg.removed, '%Y%m%d') AS INTEGER) AS sk_dateid_dateremoved, 1 AS batch_id
FROM wg JOIN customer_v cv ON cv.customer_id = wg.c_id
   AND CAST(wg.placed AS DATE) >= cv.effective_date AND CAST(wg.placed AS DATE) < cv.end_date
JOIN security s ON s.symbol = wg.sym
   AND CAST(wg.placed AS DATE) >= s.effective_date AND CAST(wg.placed AS DATE) < s.end_date
WHERE wg.placed IS NOT NULL""")
def q_fact_watches(spark, sf_dir):
    """Watch actions collapsed per (customer, symbol): first placement, last
    cancel; customer and security versions of the placement day."""
    parsed = _finwire(spark, sf_dir)
    security = build_security(spark, sf_dir, None, parsed)
    return W.fact_watches(A.watch_records(spark, sf_dir), build_customer(spark, sf_dir), security)


# --- change batch 2: T8, T11, T13 ----------------------------------------------------------

B2_LO, B2_HI, B2_DATE = "2000-01-01", "2100-01-01", "2002-01-01"  # everything after the first batch


def _first_batch(spark, sf_dir, actions):
    """Customers after batch 1, and the two prospect files."""
    first, second = (W.prospect_rows(A.prospect_records(spark, sf_dir, b)) for b in (1, 2))
    before = actions.where(F.col("_ActionTS") < F.lit(B2_LO).cast("timestamp"))
    return before, materialize(W.dim_customer(before, A.tax_rates(spark, sf_dir), first), "customers"), first, second


def build_customer_cdc(spark, sf_dir, actions, base, first, second):
    """Current customers after batch 2, and those that it closed."""
    from histmart.sources import schemas as S

    text = A.customer_cdc_text(W.customer_states(actions), B2_LO, B2_HI)
    rows = R.parse_delimited(text, "value", S.CUSTOMER_CDC)
    return W.dim_customer_cdc(base.where("is_current"), rows, B2_DATE, A.tax_rates(spark, sf_dir), first, second, 2,
                              base.agg(F.max("sk_customerid")))


def _with_closed(base, merged):
    return base.where("not is_current").unionByName(merged)


_CDC_CUST_SQL = STATES_SQL + "," + _prospect_sql("pr1", 1) + "," + _prospect_sql("pr2", 2) + "," + _versions_sql("cbase", "pr1", f"ts < TIMESTAMP '{B2_LO}'") + f""",
cchg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC, seq DESC) AS rn
                        FROM cs WHERE ts >= TIMESTAMP '{B2_LO}' AND ts < TIMESTAMP '{B2_HI}') x WHERE rn = 1),
customer2 AS (
  SELECT b.* REPLACE (CASE WHEN b.end_date = DATE '9999-12-31' AND c.customer_id IS NOT NULL THEN DATE '{B2_DATE}' ELSE b.end_date END AS end_date)
  FROM cbase b LEFT JOIN cchg c ON b.customer_id = c.customer_id
  UNION ALL
  SELECT v.customer_id, {", ".join("v." + c.strip() for c in _ATTRS.split(","))},
    CASE WHEN p1.agency_id IS NOT NULL THEN p1.agency_id ELSE p2.agency_id END, CASE WHEN p1.agency_id IS NOT NULL THEN p1.credit_rating ELSE p2.credit_rating END,
    CASE WHEN p1.agency_id IS NOT NULL THEN p1.net_worth ELSE p2.net_worth END,
    CASE WHEN p1.agency_id IS NOT NULL THEN p1.marketing_nameplate ELSE p2.marketing_nameplate END,
    DATE '{B2_DATE}', DATE '9999-12-31', 2, (SELECT count(*) FROM cbase) + row_number() OVER (ORDER BY v.customer_id)
  FROM cchg v LEFT JOIN pr1 p1 ON {_same_person("v", "p1")} LEFT JOIN pr2 p2 ON {_same_person("v", "p2")})"""


@query("dim_customer_cdc", "WITH " + _CDC_CUST_SQL + f"""
SELECT {_CUSTOMER_COLS}, end_date = DATE '9999-12-31' AS is_current FROM customer2""")
def q_dim_customer_cdc(spark, sf_dir):
    """Batch 2 of the customer dimension: the customer changes of the batch
    written as a 35-column CDC file, parsed, reduced to the highest DSN per
    customer and merged into the batch-1 dimension (new versions from the
    batch date, new keys above the maximum); persons are matched with the
    prospects of the earlier file first, then with those of the batch."""
    actions = _actions(spark, sf_dir)
    _, base, first, second = _first_batch(spark, sf_dir, actions)
    merged = build_customer_cdc(spark, sf_dir, actions, base, first, second)
    return _with_closed(base, merged).select(*[c.strip() for c in _CUSTOMER_COLS.split(",")], "is_current")


@query("dim_account_cdc", "WITH " + _CDC_CUST_SQL + "," + _BROKER_SQL + "," + _accounts_sql("abase", "cbase", f"action_ts < TIMESTAMP '{B2_LO}'") + ","
       + _accounts_sql("aall", "customer2", f"action_ts < TIMESTAMP '{B2_HI}'") + f""",
arow AS (SELECT * FROM (SELECT account_id, customer_id, broker_id, account_desc, tax_status, status,
                               row_number() OVER (PARTITION BY account_id ORDER BY ts DESC, seq DESC) AS rn
                        FROM aall_st WHERE ts >= TIMESTAMP '{B2_LO}' AND action_type IN ('NEW', 'ADDACCT', 'UPDACCT', 'CLOSEACCT')) x WHERE rn = 1),
-- accounts of batch 1 as they are, those with a row of their own as that row has them; a broker without a version isn't known any more
alist AS (
  SELECT account_id, customer_id, broker_id, account_desc, tax_status, status AS own_status, true AS in_batch FROM arow
  UNION ALL
  SELECT account_id, customer_id, CASE WHEN sk_brokerid IS NOT NULL THEN broker_id END, account_desc, tax_status, NULL, false
  FROM abase WHERE end_date = DATE '9999-12-31' AND account_id NOT IN (SELECT account_id FROM arow)),
anew AS (
  SELECT a.account_id, b.sk_brokerid, c.sk_customerid, coalesce(a.own_status, c.status) AS status, a.account_desc, a.tax_status
  FROM alist a JOIN customer2 c ON a.customer_id = c.customer_id AND c.end_date = DATE '9999-12-31' AND (c.batch_id = 2 OR a.in_batch)
  LEFT JOIN broker b ON a.broker_id = b.broker_id AND b.end_date = DATE '9999-12-31'),
account2 AS (
  SELECT ab.account_id, ab.sk_brokerid, ab.sk_customerid, ab.status, ab.account_desc, ab.tax_status,
    ab.effective_date,
    CASE WHEN ab.end_date = DATE '9999-12-31' AND EXISTS (SELECT 1 FROM anew WHERE anew.account_id = ab.account_id)
         THEN DATE '{B2_DATE}' ELSE ab.end_date END AS end_date,
    1 AS batch_id, ab.sk_accountid
  FROM abase ab
  UNION ALL
  SELECT account_id, sk_brokerid, sk_customerid, status, account_desc, tax_status, DATE '{B2_DATE}',
    DATE '9999-12-31', 2, (SELECT count(*) FROM abase) + row_number() OVER (ORDER BY account_id)
  FROM anew)
SELECT {_ACCOUNT_COLS}, end_date = DATE '9999-12-31' AS is_current FROM account2""")
def q_dim_account_cdc(spark, sf_dir):
    """Batch 2 of the account dimension: the account rows of the batch written
    as a CDC file and parsed; an account gets a version by a row of its own,
    also if its customer didn't change, or by a new version of its customer."""
    from histmart.sources import schemas as S

    actions = _actions(spark, sf_dir)
    before, customer, first, second = _first_batch(spark, sf_dir, actions)
    broker = build_broker(spark, sf_dir)
    base = W.dim_account(before, customer, broker)  # read from its numbered stage
    customer2 = build_customer_cdc(spark, sf_dir, actions, customer, first, second).where("is_current")
    # the rows decide which accounts change, as the batch sends them and as they were: staged once
    rows = materialize(R.parse_delimited(A.account_cdc_text(W.account_states(actions), B2_LO, B2_HI), "value", S.ACCOUNT_CDC), "account_rows")
    current = base.where("is_current")
    accounts = W.account_changes(current, customer.where("is_current"), broker, rows)
    merged = W.dim_account_cdc(current, accounts, customer2, broker, B2_DATE, 2, base.agg(F.max("sk_accountid")))
    return _with_closed(base, merged).select(*[c.strip() for c in _ACCOUNT_COLS.split(",")], "is_current")


_TRADE_HIST_SQL = """
ol AS (SELECT l_orderkey, max(l_shipdate) AS max_ship FROM lineitem GROUP BY 1),
tr AS (SELECT o.o_orderkey AS t_id, o.o_orderdate, o.o_orderstatus, ol.max_ship
       FROM orders o JOIN ol ON o.o_orderkey = ol.l_orderkey),
th AS (SELECT t_id, o_orderdate AS ts, CASE WHEN t_id % 2 = 0 THEN 'PNDG' ELSE 'SBMT' END AS st FROM tr
       UNION ALL
       SELECT t_id, greatest(max_ship, o_orderdate) + INTERVAL 12 HOUR,
              CASE WHEN o_orderstatus = 'F' THEN 'CMPT' ELSE 'CNCL' END
       FROM tr WHERE o_orderstatus IN ('F', 'P'))"""


@query("dim_trade_cdc", "WITH " + _TRADE_HIST_SQL + f""",
lf AS (SELECT t_id, min(ts) FILTER (WHERE st IN ('PNDG', 'SBMT')) AS create_ts,
              max(ts) FILTER (WHERE st IN ('CMPT', 'CNCL')) AS close_ts, arg_max(st, ts) AS st
       FROM th WHERE ts < TIMESTAMP '{B2_HI}' GROUP BY t_id)
SELECT t_id AS trade_id,
  CASE st WHEN 'PNDG' THEN 'Pending' WHEN 'SBMT' THEN 'Submitted' WHEN 'CMPT' THEN 'Completed'
          WHEN 'CNCL' THEN 'Canceled' END AS status,
  CAST(strftime(create_ts, '%Y%m%d') AS INTEGER) AS sk_createdateid,
  CAST(hour(create_ts) * 3600 + minute(create_ts) * 60 + second(create_ts) AS INTEGER) AS sk_createtimeid,
  CAST(strftime(close_ts, '%Y%m%d') AS INTEGER) AS sk_closedateid,
  CAST(hour(close_ts) * 3600 + minute(close_ts) * 60 + second(close_ts) AS INTEGER) AS sk_closetimeid,
  CASE WHEN create_ts >= TIMESTAMP '{B2_LO}' THEN 2 ELSE 1 END AS batch_id
FROM lf WHERE create_ts IS NOT NULL""")
def q_dim_trade_cdc(spark, sf_dir):
    """Batch 2 of the trade table: insert rows create trades, completion and
    cancel rows close them; batch-1 trades keep their create stamps."""
    hist = A.trade_history(spark, sf_dir)
    base_hist = hist.where(F.col("TH_DTS") < F.lit(B2_LO).cast("timestamp_ntz"))
    rows = R.parse_delimited(A.trade_cdc_text(hist, B2_LO, B2_HI), "value",
                             StructType.fromDDL(A.TRADE_CDC_SHORT))
    return W.dim_trade_cdc(base_hist, rows, W.status_types(spark), B2_LO)
