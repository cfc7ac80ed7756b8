"""Shape adapter: present the driver's tables as raw brokerage extracts.

The raw files are not available, so every extract is derived
from the given tables by a Spark job (one row of output per row or group of
input; no driver-side data), then parsed back with the real readers.  Work
therefore grows with the input tables.

Mapping (SURVEY 7.3):
  CMP records   supplier x year (plus a same-day second record for some)
  FIN records   quarterly revenue per l_suppkey
  SEC records   part; company = p_partkey mod number of suppliers
  actions       one per order: NEW at a customer's first order, else one of the other five
  trades        orders; history rows from order date and line ship dates
  daily market  per l_partkey and ship day
  cash, watches events
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.functions.clean import VALID_SP_RATINGS
from histmart.plans.registry import table
from histmart.session import tasks_for
from histmart.sources import schemas as S

# Three invalid ratings appended to the 22 valid ones so that
# a rating cycle of 25 produces invalid-rating alerts.
RATING_CYCLE = VALID_SP_RATINGS + ("XX", "ZZ", "Q")


def fw(c: Column, width: int) -> Column:
    """Left-aligned fixed-width text field, blank padded; a longer value is an error."""
    s = F.coalesce(c.cast("string"), F.lit(""))
    long = F.raise_error(F.concat(F.lit(f"longer than {width}: "), s)).cast("string")
    return F.when(F.length(s) > width, long).otherwise(F.rpad(s, width, " "))


def padded(c: Column, width: int) -> Column:
    """Number as text with leading zeros; longer ones stay whole."""
    s = c.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def _line(fields: list[Column]) -> Column:
    return F.concat(*fields)


def _pts(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd-HHmmss")


def cik(c) -> Column:
    return padded(F.col(c) if isinstance(c, str) else c, 10)


# --- companies (CMP) ------------------------------------------------------------

def company_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CMP record per supplier and year of the order span; suppliers with
    key divisible by 7 send a second record on the same day in 1998."""
    s = table(spark, sf_dir, "supplier")
    years = table(spark, sf_dir, "orders").agg(
        F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi"))
    # scalar subqueries: evaluated inside the plan, not as driver-side jobs
    lo, hi = years.select("lo").scalar(), years.select("hi").scalar()
    # one year before the first order, so securities and trades of the first
    # year find a company version
    rec = s.select("*", F.explode(F.sequence(lo - 1, hi)).alias("year"))
    extra = s.where((F.col("s_suppkey") % 7) == 0).select("*", F.lit(1998).alias("year"))
    rec = rec.withColumn("seq", F.lit(0)).unionByName(extra.withColumn("seq", F.lit(1)))
    day = F.date_add(F.make_date(F.col("year"), F.lit(1), F.lit(1)), (F.col("s_suppkey") % 90).cast("int"))
    ts = F.make_timestamp(F.year(day), F.month(day), F.dayofmonth(day),
                          (F.col("s_suppkey") % 20).cast("int") + F.col("seq"), F.lit(0), F.lit(0))
    ratings = F.array(*[F.lit(r) for r in RATING_CYCLE])
    rating_ix = ((F.col("s_suppkey") + F.floor((F.col("year") - F.lit(lo) + 1) / 2)) % len(RATING_CYCLE)) + 1
    return rec.select(
        "s_suppkey", "year", "seq", ts.cast("timestamp_ntz").alias("pts"),
        F.col("s_name").alias("CompanyName"), cik("s_suppkey").alias("CIK"),
        F.when(F.col("seq") == 1, F.lit("INAC")).otherwise(F.lit("ACTV")).alias("Status"),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("IndustryID"),
        F.element_at(ratings, rating_ix.cast("int")).alias("SPrating"),
        F.when(F.col("s_suppkey") % 5 == 0, F.lit(""))
         .otherwise(F.date_format(F.date_add(F.lit("1970-01-01").cast("date"),
                                             ((F.col("s_suppkey") * 11) % 9000).cast("int")), "yyyyMMdd"))
         .alias("FoundingDate"),
        F.concat(F.lit("Street "), F.col("s_nationkey").cast("string")).alias("AddrLine1"),
        F.lit("").alias("AddrLine2"),
        F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("PostalCode"),
        F.concat(F.lit("City "), F.col("s_nationkey").cast("string")).alias("City"),
        F.lit("ST").alias("StateProvince"), F.lit("Country").alias("Country"),
        F.concat(F.lit("CEO of "), F.col("s_name")).alias("CEOname"),
        F.concat(F.lit("Company "), F.col("s_suppkey").cast("string"),
                 F.when(F.col("year") >= 2000, F.lit(" (renamed)")).otherwise(F.lit(""))).alias("Description"),
    )


def cmp_lines(spark, sf_dir) -> DataFrame:
    r = company_records(spark, sf_dir)
    fields = [fw(F.col(n), w) for n, w in S.FINWIRE_LAYOUTS["CMP"]]
    return r.select(_line([_pts(F.col("pts")), F.lit("CMP"), *fields]).alias("value"))


# --- financials (FIN) -------------------------------------------------------------

def _half_up(num: Column, den) -> Column:
    """``num / den`` rounded half up to whole cents, as text with 2 decimals.

    Exact integer arithmetic on non-negative inputs: ``a - pmod(a, b)`` is a
    multiple of ``b``, so the division is exact.
    """
    den = den if isinstance(den, Column) else F.lit(den).cast("long")
    a, b = (num * 2 + den).cast("long"), (den * 2).cast("long")
    cents = ((a - F.pmod(a, b)) / b).cast("long")
    return (cents.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")).cast("string")


def financial_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    q = li.groupBy("l_suppkey", F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("qstart")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("rev"),
        F.sum(F.col("l_extendedprice").cast("decimal(15,2)") * F.col("l_discount").cast("decimal(4,2)"))
        .alias("earn"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    q = q.join(s, q.l_suppkey == s.s_suppkey, "inner").withColumns({
        "earn4": (F.col("earn") * 10000).cast("long"), "rev_c": (F.col("rev") * 100).cast("long")})
    posting = F.date_add(F.add_months(F.col("qstart"), 3), (F.col("l_suppkey") % 20).cast("int"))
    quarter = F.quarter("qstart")
    return q.select(
        "l_suppkey", F.col("qstart"),
        F.make_timestamp(F.year(posting), F.month(posting), F.dayofmonth(posting), F.lit(6), F.lit(0),
                         F.lit(0)).cast("timestamp_ntz").alias("pts"),
        F.year("qstart").cast("string").alias("Year"), quarter.cast("string").alias("Quarter"),
        F.date_format("qstart", "yyyyMMdd").alias("QtrStartDate"),
        F.date_format(posting, "yyyyMMdd").alias("PostingDate"),
        F.col("rev").cast("string").alias("Revenue"), F.col("earn").cast("decimal(18,4)").cast("string").alias("Earnings"),
        _half_up(F.col("earn4"), 100000).alias("EPS"),
        _half_up(F.col("earn4"), 110000).alias("DilutedEPS"),
        F.when(F.col("rev_c") != 0, _half_up(F.col("earn4"), F.col("rev_c"))).alias("Margin"),
        F.lit("0").alias("Inventory"), F.col("rev").cast("string").alias("Assets"),
        F.col("earn").cast("decimal(18,4)").cast("string").alias("Liabilities"),
        F.lit("1000").alias("ShOut"), F.lit("1100").alias("DilutedShOut"),
        F.when(((F.col("l_suppkey") + quarter) % 2) == 0, cik("l_suppkey"))
         .otherwise(F.col("s_name")).alias("CoNameOrCIK"))


def fin_lines(spark, sf_dir) -> DataFrame:
    r = financial_records(spark, sf_dir)
    fields = [fw(F.col(n), w) for n, w in S.FINWIRE_LAYOUTS["FIN"]]
    return r.select(_line([_pts(F.col("pts")), F.lit("FIN"), *fields]).alias("value"))


# --- securities (SEC) -------------------------------------------------------------

def security_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One SEC record per part; parts divisible by 9 send a later second
    record (a new version with another status)."""
    p = table(spark, sf_dir, "part")
    s = table(spark, sf_dir, "supplier")
    n_supp = s.agg(F.max("s_suppkey") + 1).scalar()
    base = p.withColumn("seq", F.lit(0)).unionByName(
        p.where(F.col("p_partkey") % 9 == 0).withColumn("seq", F.lit(1)))
    base = base.withColumn("company", F.pmod(F.col("p_partkey"), n_supp))
    base = base.join(s.select("s_suppkey", "s_name"), F.col("company") == F.col("s_suppkey"), "inner")
    day = F.date_add(F.lit("1994-06-01").cast("date"),
                     ((F.col("p_partkey") % 180) + F.col("seq") * 600).cast("int"))
    return base.select(
        "p_partkey", "seq", "company",
        F.make_timestamp(F.year(day), F.month(day), F.dayofmonth(day), F.lit(9), F.lit(30), F.lit(0))
        .cast("timestamp_ntz").alias("pts"),
        F.concat(F.lit("S"), padded(F.col("p_partkey"), 9)).alias("Symbol"),
        F.lit("COMMON").alias("IssueType"),
        F.when(F.col("seq") == 1, F.lit("INAC")).otherwise(F.lit("ACTV")).alias("Status"),
        F.col("p_name").alias("Name"), F.lit("NYSE").alias("ExID"),
        (F.col("p_size") * 1000).cast("string").alias("ShOut"),
        F.lit("19950101").alias("FirstTradeDate"), F.lit("19950101").alias("FirstTradeExchg"),
        (F.col("p_retailprice").cast("decimal(15,2)") * F.lit(0.01).cast("decimal(3,2)"))
        .cast("decimal(12,4)").cast("string").alias("Dividend"),
        F.when(F.col("p_partkey") % 2 == 0, cik("company")).otherwise(F.col("s_name")).alias("CoNameOrCIK"))


def sec_lines(spark, sf_dir) -> DataFrame:
    r = security_records(spark, sf_dir)
    fields = [fw(F.col(n), w) for n, w in S.FINWIRE_LAYOUTS["SEC"]]
    return r.select(_line([_pts(F.col("pts")), F.lit("SEC"), *fields]).alias("value"))


def finwire_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three record types in one text DataFrame, as the FINWIRE files."""
    return cmp_lines(spark, sf_dir).unionByName(fin_lines(spark, sf_dir)).unionByName(sec_lines(spark, sf_dir))


# --- customer actions (XML) ------------------------------------------------------

def action_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One action per order, numbered by the order key: NEW at the customer's
    first order (listing two accounts), INACT at a later last order that is
    finished, else by the key's last digit ADDACCT (3), UPDACCT (7), CLOSEACCT
    (9) or UPDCUST.  A customer action after the first sends only some fields,
    by divisors of the order key; some of what it sends is empty."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    ends = o.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("__f"),
                                      F.max(F.struct("o_orderdate", "o_orderkey")).alias("__l"))
    j = (o.join(ends, "o_custkey")
          .join(c, o.o_custkey == c.c_custkey, "inner"))
    k, ok, n = F.col("c_custkey"), F.col("o_orderkey"), F.col("c_nationkey")
    new = ok == F.col("__f.o_orderkey")
    is_inact = (~new & (ok == F.col("__l.o_orderkey")) & (F.col("o_orderstatus") == "F"))
    digit = ok % 10
    kind = (F.when(new, "NEW").when(is_inact, "INACT").when(digit == 3, "ADDACCT").when(digit == 7, "UPDACCT")
            .when(digit == 9, "CLOSEACCT").otherwise("UPDCUST"))
    j = j.withColumn("action_type", kind)
    customer = F.col("action_type").isin("NEW", "UPDCUST", "INACT")
    text = lambda x: x.cast("string")
    tx = lambda x: F.concat(F.lit("TX"), padded(x, 2))
    number = padded(k % 10000, 4)
    fields = {
        "tax_id": F.when(new | (ok % 5 == 0), F.concat(F.lit("T"), text(k), F.lit("-"), text(ok % 7))),
        "gender": F.when(new | (ok % 7 == 0), F.element_at(F.array(*[F.lit(x) for x in ("m", "F", "x", "")]), ((k + ok) % 4 + 1).cast("int"))),
        "tier": F.when(new | (ok % 3 == 0), (k % 5).cast("int")),
        "dob": F.when(new, F.date_add(F.lit("1930-01-01").cast("date"), ((k * 37) % 25000).cast("int"))),
        "l_name": F.when(new | (ok % 2 == 0), F.col("c_name")),
        "f_name": F.when(new | (ok % 6 == 0), F.concat(F.lit("F"), text(n))),
        "m_name": F.when(new, "M").when(ok % 10 == 0, ""),
        "adline1": F.when(new, F.concat(F.lit("Street "), text(n))),
        "adline2": F.when(new & (k % 3 == 0), F.concat(F.lit("Apt "), text(k))).when(new & (k % 3 == 1), ""),
        "zip": F.when(new, F.lpad(text(n), 5, "0")),
        "city": F.when(new, "City").when(ok % 8 == 0, F.concat(F.lit("Town "), text(n))),
        "state": F.when(new, "ST"), "country": F.when(new, "Country"),
        "email": F.when(ok % 4 == 0, "").otherwise(F.concat(F.lit("c"), text(k), F.lit("@"), F.lower(F.col("o_orderpriority").substr(3, 20)), F.lit(".com"))),
        "email2": F.when(ok % 9 == 0, F.concat(F.lit("alt"), text(k), F.lit("@x.org"))),
        "area1": F.when(new, padded(n, 3)), "local1": F.when(new, F.concat(F.lit("555"), number)),
        "local2": F.when(new & (k % 2 == 0), F.concat(F.lit("666"), number)),
        "local3": F.when(ok % 11 == 0, F.concat(F.lit("444"), number)),
        "lcl_tx": F.when(new, tx(n)).when(ok % 12 == 0, tx((n + 1) % 25)),
        "nat_tx": F.when(new, tx((n + 5) % 25)),
    }
    sent = [F.when(customer, v).alias(name) for name, v in fields.items()]
    return j.select("action_type", F.col("o_orderdate").alias("action_ts"), "o_orderkey", "o_custkey", *sent, "c_nationkey")


def _attr(name: str, c: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f' {name}="'), c.cast("string"), F.lit('"')), F.lit(""))


def _elem(name: str, c: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"<{name}>"), c.cast("string"), F.lit(f"</{name}>")), F.lit(""))


def _group(name: str, *elems: Column) -> Column:
    """An element around others, absent if they all are."""
    inner = F.concat(*elems)
    return F.when(inner != "", F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>"))).otherwise("")


def _account(account_id: Column, tax: Column, broker: Column, desc: Column) -> Column:
    return F.concat(F.lit("<Account"), _attr("CA_ID", account_id), _attr("CA_TAX_ST", tax), F.lit(">"),
                    _elem("CA_B_ID", broker), _elem("CA_NAME", desc), F.lit("</Account>"))


def _account_elements() -> Column:
    """NEW lists two accounts; ADDACCT adds one, numbered by the order key;
    UPDACCT changes some fields of the first one, CLOSEACCT names the second."""
    cust, ok, n = F.col("o_custkey"), F.col("o_orderkey"), F.col("c_nationkey")
    null = F.lit(None).cast("string")
    opened = F.concat(*[_account(cust * 2 + i, F.lit(i + 1), n, F.lit(f"Account {i}")) for i in (0, 1)])
    added = _account(F.lit(1000000000) + ok, F.lit(1), n, F.concat(F.lit("Added "), ok.cast("string")))
    changed = _account(cust * 2, F.when(ok % 3 == 0, (ok % 2 + 1).cast("int")), F.when(ok % 20 == 7, (n + 1) % 25),
                       F.when(ok % 4 != 1, F.concat(F.lit("Renamed "), ok.cast("string"))))
    kind = F.col("action_type")
    return (F.when(kind == "NEW", opened).when(kind == "ADDACCT", added).when(kind == "UPDACCT", changed)
            .when(kind == "CLOSEACCT", _account(cust * 2 + 1, null, null, null)).otherwise(""))


def _phone(name: str, local: Column, **parts: Column) -> Column:
    """The phone element of a local number; its other parts come with it."""
    given = F.concat(*[_elem(x, c) for x, c in parts.items()], _elem("C_LOCAL", local))
    return F.when(local.isNotNull(), F.concat(F.lit(f"<{name}>"), given, F.lit(f"</{name}>"))).otherwise("")


def action_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<Action>`` text and number (``seq``) per action record, for the XML reader."""
    a = action_records(spark, sf_dir)
    col = F.col
    contact = [_elem("C_PRIM_EMAIL", col("email")), _elem("C_ALT_EMAIL", col("email2")),
               _phone("C_PHONE_1", col("local1"), C_CTRY_CODE=F.lit("1"), C_AREA_CODE=col("area1")),
               _phone("C_PHONE_2", col("local2"), C_AREA_CODE=F.lit("200"), C_EXT=F.lit("7")),
               _phone("C_PHONE_3", col("local3"))]
    xml = F.concat(
        F.lit('<Action ActionType="'), col("action_type"), F.lit('" ActionTS="'),
        F.date_format("action_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('">'),
        F.lit('<Customer C_ID="'), col("o_custkey").cast("string"), F.lit('"'),
        _attr("C_TAX_ID", col("tax_id")), _attr("C_GNDR", col("gender")), _attr("C_TIER", col("tier")), _attr("C_DOB", col("dob")), F.lit(">"),
        _group("Name", _elem("C_L_NAME", col("l_name")), _elem("C_F_NAME", col("f_name")), _elem("C_M_NAME", col("m_name"))),
        _group("Address", _elem("C_ADLINE1", col("adline1")), _elem("C_ADLINE2", col("adline2")), _elem("C_ZIPCODE", col("zip")),
               _elem("C_CITY", col("city")), _elem("C_STATE_PROV", col("state")), _elem("C_CTRY", col("country"))),
        _group("ContactInfo", *contact),
        _group("TaxInfo", _elem("C_LCL_TX_ID", col("lcl_tx")), _elem("C_NAT_TX_ID", col("nat_tx"))),
        _account_elements(), F.lit("</Customer></Action>"))
    # XML parsing is CPU-bound per row while the text is small in bytes, so
    # AQE would coalesce it into very few tasks: spread it over the shuffle
    # partitions (an explicit count is kept by AQE), by hash: dealing them out
    # in turn would sort the texts first
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return a.select(xml.alias("value"), col("o_orderkey").alias("seq")).repartition(n, "seq", "value")


# --- orders as delimited text -----------------------------------------------------

def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cols = [F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"),
            F.col("o_totalprice").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
            F.col("o_orderpriority")]
    return o.select(F.concat_ws("|", *cols).alias("value"))


ORDERS_TEXT_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice decimal(15,2), "
                      "o_orderdate timestamp_ntz, o_orderpriority string")


# --- code tables ------------------------------------------------------------------

def industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Industry code table: one code per nation (bounded by the nation table)."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("IN_ID"),
                    F.concat(F.lit("Industry "), F.col("n_name")).alias("IN_NAME"),
                    F.lit("SC").alias("IN_SC_ID"))


def tax_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tax rate table: one code per nation, rates from 0.01 in steps of 0.005."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("TX"), padded(F.col("n_nationkey"), 2)).alias("TX_ID"),
                    F.concat(F.lit("Tax of "), F.col("n_name")).alias("TX_NAME"),
                    (F.lit(0.01).cast("decimal(6,5)") + F.col("n_nationkey") * F.lit(0.005).cast("decimal(6,5)")).cast("decimal(6,5)").alias("TX_RATE"))


# --- HR.csv -----------------------------------------------------------------------------

def hr_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One employee per nation, written as comma-separated text and parsed
    back with the HR schema; nations of region 0 have another job code."""
    from histmart.sources.readers import parse_delimited

    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "inner")
    text = j.select(F.concat_ws(
        ",", F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string"), F.col("n_name"),
        F.col("r_name"), F.lit(""),
        F.when(F.col("n_regionkey") == 0, F.lit("315")).otherwise(F.lit("314")),
        F.concat(F.lit("Branch "), F.col("n_regionkey").cast("string")),
        F.concat(F.lit("Office "), F.col("n_nationkey").cast("string")),
        F.concat(F.lit("555-"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0"))).alias("value"))
    return parse_delimited(text, "value", S.HR, sep=",")


# --- Prospect.csv -----------------------------------------------------------------------

def prospect_records(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    """One prospect per customer; every sixth one under a changed last name.
    The file of batch 1 lacks some; that of batch 2 has these, lacks others,
    and has other values in a few fields, each in some of its rows."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    if batch == 1:
        c = c.where("c_custkey % 8 <> 3")
    changed = lambda every, then, else_: F.when(k % every == 0, then).otherwise(else_) if batch == 2 else else_
    if batch == 2:
        c = c.where("c_custkey % 4 <> 1")
    return c.select(
        F.concat(F.lit("P"), k.cast("string")).alias("AgencyID"),
        F.when(k % 6 == 0, F.concat(F.col("c_name"), F.lit(" Jr"))).otherwise(F.col("c_name")).alias("LastName"),
        F.concat(F.lit("F"), F.col("c_nationkey").cast("string")).alias("FirstName"),
        F.lit(None).cast("string").alias("MiddleInitial"),
        F.element_at(F.array(F.lit("m"), F.lit("F"), F.lit("x"), F.lit(""), F.lit(None).cast("string")),
                     (k % 5 + 1).cast("int")).alias("Gender"),
        F.concat(F.lit("Street "), F.col("c_nationkey").cast("string")).alias("AddressLine1"),
        F.lit(None).cast("string").alias("AddressLine2"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("PostalCode"),
        changed(22, F.lit("Village"), F.lit("City")).alias("City"), F.lit("ST").alias("State"), F.lit("Country").alias("Country"),
        F.when(k % 3 == 0, F.concat(F.lit("555-"), padded(k, 6))).alias("Phone"),
        F.when(k % 13 == 0, F.lit(None)).otherwise((k * 104729) % 300001).cast("long").alias("Income"),
        (F.floor(k / 7) % 6).cast("int").alias("NumberCars"), (k % 6).cast("int").alias("NumberChildren"),
        F.element_at(F.array(*[F.lit(x) for x in ("s", "M", "d", "W", "q", "w")]), (k % 6 + 1).cast("int"))
         .alias("MaritalStatus"),
        (18 + k % 70).cast("int").alias("Age"), (300 + (k * 13) % 550).cast("int").alias("CreditRating"),
        F.element_at(F.array(*[F.lit(x) for x in ("o", "R", "x")]), (k % 3 + 1).cast("int")).alias("OwnOrRentFlag"),
        changed(14, F.lit("New Employer"), F.when(k % 4 == 0, F.concat(F.lit("Employer "), F.col("c_nationkey").cast("string")))).alias("Employer"),
        F.when(k % 17 == 0, F.lit(None)).otherwise((F.floor(k / 3) % 9)).cast("int").alias("NumberCreditCards"),
        changed(5, F.coalesce(F.when(k % 10 != 0, (k * 7919) % 2000001), F.lit(0)) + 100,
                F.when(k % 10 != 0, (k * 7919) % 2000001)).cast("long").alias("NetWorth"))


# --- trades and their history -----------------------------------------------------------

def _order_lines(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    return li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").cast("int").alias("qty"), F.min("l_partkey").alias("part"),
        F.max("l_shipdate").alias("max_ship"),
        F.sum(price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,4)").alias("comm"),
        F.sum(price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(18,4)").alias("tax"))


def trade_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade rows (Trade.txt shape): one per order that has lines."""
    o = table(spark, sf_dir, "orders")
    agg = _order_lines(spark, sf_dir)
    t = o.join(agg, o.o_orderkey == agg.l_orderkey, "inner")
    k = F.col("o_orderkey")
    status = (F.when(F.col("o_orderstatus") == "F", F.lit("CMPT"))
              .when(F.col("o_orderstatus") == "P", F.lit("CNCL")).otherwise(F.lit("SBMT")))
    price = F.col("o_totalprice").cast("decimal(10,2)")
    return t.select(
        k.alias("T_ID"), F.col("o_orderdate").alias("T_DTS"), status.alias("T_ST_ID"),
        F.element_at(F.array(*[F.lit(x) for x in ("TLB", "TLS", "TMB", "TMS")]), (k % 4 + 1).cast("int"))
         .alias("T_TT_ID"),
        (k % 3 != 0).cast("int").alias("T_IS_CASH"),
        F.concat(F.lit("S"), padded(F.col("part"), 9)).alias("T_S_SYMB"),
        F.col("qty").alias("T_QTY"), price.alias("T_BID_PRICE"),
        (F.col("o_custkey") * 2 + k % 2).alias("T_CA_ID"),
        F.concat(F.lit("exec "), (k % 10).cast("string")).alias("T_EXEC_NAME"),
        F.when(F.col("o_orderstatus") == "F", price).alias("T_TRADE_PRICE"),
        F.col("qty").cast("decimal(10,2)").alias("T_CHRG"), F.col("comm").alias("T_COMM"),
        F.col("tax").alias("T_TAX"))


def trade_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History rows (TradeHistory.txt shape): opened at the order date
    (pending or submitted), closed 12 hours after the later of the last ship
    date and the order date when finished (completed) or pending (canceled)."""
    o = table(spark, sf_dir, "orders")
    agg = _order_lines(spark, sf_dir).select("l_orderkey", "max_ship")
    t = o.join(agg, o.o_orderkey == agg.l_orderkey, "inner")
    k = F.col("o_orderkey")
    opened = t.select(k.alias("TH_T_ID"), F.col("o_orderdate").alias("TH_DTS"),
                      F.when(k % 2 == 0, F.lit("PNDG")).otherwise(F.lit("SBMT")).alias("TH_ST_ID"))
    closed = t.where(F.col("o_orderstatus").isin("F", "P")).select(
        k.alias("TH_T_ID"),
        (F.greatest("max_ship", "o_orderdate") + F.expr("INTERVAL 12 HOURS")).alias("TH_DTS"),
        F.when(F.col("o_orderstatus") == "F", F.lit("CMPT")).otherwise(F.lit("CNCL")).alias("TH_ST_ID"))
    return opened.unionByName(closed)


def cash_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cash transactions from events: purchases debit, everything else credits."""
    e = table(spark, sf_dir, "events")
    amt = F.col("value").cast("decimal(15,2)")
    return e.select((F.col("user_id") * 2 + F.col("event_id") % 2).alias("CT_CA_ID"), F.col("ts").alias("CT_DTS"),
                    F.when(F.col("event_type") == "purchase", -amt).otherwise(amt).alias("CT_AMT"),
                    F.col("event_type").alias("CT_NAME"))


def holding_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("HH_H_T_ID"), F.col("l_orderkey").alias("HH_T_ID"),
                     F.lit(0).alias("HH_BEFORE_QTY"), F.col("l_quantity").cast("int").alias("HH_AFTER_QTY"))


def market_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily market rows per part and ship day (DailyMarket.txt shape)."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    lines = li.select("l_partkey", F.col("l_shipdate").cast("date").alias("DM_DATE"), price.alias("price"), "l_quantity",
                      (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line"))
    # dealt before they are grouped: a task's groups don't grow with the table
    d = lines.repartition(tasks_for(li), "l_partkey", "DM_DATE").groupBy("l_partkey", "DM_DATE").agg(
        F.max_by("price", "line").alias("DM_CLOSE"), F.max("price").alias("DM_HIGH"), F.min("price").alias("DM_LOW"),
        F.sum("l_quantity").cast("long").alias("DM_VOL"))
    return d.select("DM_DATE", F.concat(F.lit("S"), padded(F.col("l_partkey"), 9))
                    .alias("DM_S_SYMB"), "DM_CLOSE", "DM_HIGH", "DM_LOW", "DM_VOL")


def watch_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watch actions from events: a click places, an error cancels."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "error"))
    sym = F.get_json_object("props", "$.k").cast("long") % table(spark, sf_dir, "part").agg(F.count("*").alias("n")).scalar()
    return e.select(F.col("user_id").alias("W_C_ID"),
                    F.concat(F.lit("S"), padded(sym, 9)).alias("W_S_SYMB"),
                    F.col("ts").alias("W_DTS"),
                    F.when(F.col("event_type") == "click", F.lit("ACTV")).otherwise(F.lit("CNCL")).alias("W_ACTION"))


# --- change-data files of batch 2 ----------------------------------------------------------

def _dsn(ts: Column, seq: Column) -> Column:
    """A change sequence number that follows time: seconds since the epoch,
    then the record's own id in 19 digits."""
    return F.concat(F.unix_seconds(ts.cast("timestamp")).cast("string"), F.lpad(seq.cast("string"), 19, "0")).cast("decimal(38,0)")


def _in_window(df: DataFrame, lo: str, hi: str) -> DataFrame:
    return df.where((F.col("ts") >= F.lit(lo).cast("timestamp")) & (F.col("ts") < F.lit(hi).cast("timestamp")))


def _change_line(flag: Column, ts: Column, seq: Column, fields: list[Column]) -> Column:
    return F.concat_ws("|", flag, *[F.coalesce(c.cast("string"), F.lit("")) for c in (_dsn(ts, seq), *fields)])


def customer_cdc_text(states: DataFrame, lo: str, hi: str) -> DataFrame:
    """Customer.txt of a change batch: the full customer state after every
    action in [lo, hi), 2 CDC columns + 33 customer columns, pipe-separated."""
    col, none = F.col, F.lit(None)
    status = F.when(col("status") == "INACTIVE", "INAC").when(col("status") == "ACTIVE", "ACTV")
    phones = [x for n in (1, 2, 3) for x in (none, none, col(f"phone{n}"), none)]
    fields = [col("customer_id"), col("tax_id"), status, col("last_name"), col("first_name"), col("middle_initial"), col("gender"), col("tier"), col("dob"),
              col("address_line1"), col("address_line2"), col("postal_code"), col("city"), col("state_prov"), col("country"), *phones,
              col("email1"), col("email2"), col("lcl_tax_id"), col("nat_tax_id")]
    flag = F.when(col("action") == "NEW", F.lit("I")).otherwise(F.lit("U"))
    return _in_window(states, lo, hi).select(_change_line(flag, col("ts"), col("seq"), fields).alias("value"))


def account_cdc_text(states: DataFrame, lo: str, hi: str) -> DataFrame:
    """Account.txt of a change batch: the full account state after every
    action on the account itself in [lo, hi)."""
    col = F.col
    status = F.when(col("status") == "INACTIVE", "INAC").otherwise("ACTV")
    fields = [col("account_id"), col("broker_id"), col("customer_id"), col("account_desc"), col("tax_status"), status]
    flag = F.when(col("action").isin("NEW", "ADDACCT"), F.lit("I")).otherwise(F.lit("U"))
    own = states.where(col("action").isin("NEW", "ADDACCT", "UPDACCT", "CLOSEACCT"))
    return _in_window(own, lo, hi).select(_change_line(flag, col("ts"), col("seq"), fields).alias("value"))


TRADE_CDC_SHORT = "CDC_FLAG string, CDC_DSN decimal(38,0), T_ID long, T_DTS timestamp_ntz, T_ST_ID string"


def trade_cdc_text(history: DataFrame, lo: str, hi: str) -> DataFrame:
    """Trade change rows of a batch: an insert at creation, an update at
    completion or cancel (flag, DSN, id, time, status)."""
    h = history.where((F.col("TH_DTS") >= F.lit(lo).cast("timestamp_ntz"))
                      & (F.col("TH_DTS") < F.lit(hi).cast("timestamp_ntz")))
    flag = F.when(F.col("TH_ST_ID").isin("PNDG", "SBMT"), F.lit("I")).otherwise(F.lit("U"))
    return h.select(F.concat_ws("|", flag, _dsn(F.col("TH_DTS"), F.col("TH_T_ID")).cast("string"),
                                F.col("TH_T_ID").cast("string"),
                                F.date_format("TH_DTS", "yyyy-MM-dd HH:mm:ss"), F.col("TH_ST_ID")).alias("value"))
