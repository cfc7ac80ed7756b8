"""Warehouse transforms T1-T17: raw-shaped DataFrames in, warehouse tables out.

Each transform is a composition of histmart operators (SURVEY 2.9); nothing
here collects rows or loops on the driver.  ``historical_load`` wires them
in dependency order: calendar and codes -> broker -> company -> financial
-> security -> prospect -> customer -> account -> trade -> cash ->
holdings -> market -> watches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.functions import clean as CL
from histmart.operators import facts as FX
from histmart.operators import history as H
from histmart.operators import lookup as L
from histmart.operators.keys import assign_keys
from histmart.session import compiled_methods

EOT = H.END_OF_TIME

# Status codes and their names.
STATUS_TYPES = (("ACTV", "Active"), ("CMPT", "Completed"), ("CNCL", "Canceled"),
                ("PNDG", "Pending"), ("SBMT", "Submitted"), ("INAC", "Inactive"))
# Trade types (id, name, is sell, is market).
TRADE_TYPES = (("TLB", "Limit-Buy", 0, 0), ("TLS", "Limit-Sell", 1, 0),
               ("TMB", "Market Buy", 0, 1), ("TMS", "Market Sell", 1, 1), ("TSL", "Stop Loss", 1, 0))
BROKER_JOB_CODE = 314


def status_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATUS_TYPES), "ST_ID string, ST_NAME string")


def trade_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TRADE_TYPES), "TT_ID string, TT_NAME string, TT_IS_SELL int, TT_IS_MRKT int")


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def _eot() -> Column:
    return F.lit(EOT).cast("date")


# --- T1 calendar -------------------------------------------------------------------------

def dim_date(first: Column | str, last: Column | str, span: DataFrame) -> DataFrame:
    """One row per day between the two dates of the one-row ``span`` frame."""
    days = span.select(F.explode(F.sequence(F.col(first) if isinstance(first, str) else first,
                                            F.col(last) if isinstance(last, str) else last)).alias("d"))
    iso_dow = ((F.dayofweek("d") + 5) % 7 + 1).cast("int")
    fiscal = F.add_months("d", 6)
    return days.select(
        date_key(F.col("d")).alias("sk_dateid"), F.col("d").alias("date_value"),
        F.date_format("d", "MMMM d, yyyy").alias("date_desc"),
        F.year("d").alias("calendar_year_id"),
        (F.year("d") * 10 + F.quarter("d")).alias("calendar_qtr_id"),
        (F.year("d") * 100 + F.month("d")).alias("calendar_month_id"),
        F.date_format("d", "MMMM").alias("calendar_month_desc"),
        (F.year("d") * 100 + F.weekofyear("d")).alias("calendar_week_id"),
        iso_dow.alias("day_of_week_num"), F.date_format("d", "EEEE").alias("day_of_week_desc"),
        F.year(fiscal).alias("fiscal_year_id"), (F.year(fiscal) * 10 + F.quarter(fiscal)).alias("fiscal_qtr_id"),
        (((F.month("d") == 1) & (F.dayofmonth("d") == 1)) | ((F.month("d") == 12) & (F.dayofmonth("d") == 25)))
        .alias("holiday_flag"))


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per second of the day (bounded domain)."""
    sec = F.col("id")
    h, m, s = (sec / 3600).cast("int"), ((sec % 3600) / 60).cast("int"), (sec % 60).cast("int")
    return spark.range(0, 86400).select(
        sec.cast("int").alias("sk_timeid"), F.format_string("%02d:%02d:%02d", h, m, s).alias("time_value"),
        h.alias("hour_id"), m.alias("minute_id"), s.alias("second_id"),
        ((h >= 9) & (h < 16)).alias("market_hours_flag"), ((h >= 8) & (h < 17)).alias("office_hours_flag"))


# --- T2 broker ---------------------------------------------------------------------------

def dim_broker(hr: DataFrame, effective) -> DataFrame:
    """Employees with job code 314; one version from the first calendar day."""
    b = hr.where(F.col("EmployeeJobCode") == BROKER_JOB_CODE).select(
        F.col("EmployeeID").alias("broker_id"), F.col("ManagerID").alias("manager_id"),
        F.col("EmployeeFirstName").alias("first_name"), F.col("EmployeeLastName").alias("last_name"),
        F.col("EmployeeMI").alias("middle_initial"), F.col("EmployeeBranch").alias("branch"),
        F.col("EmployeeOffice").alias("office"), F.col("EmployeePhone").alias("phone"))
    b = b.withColumns({"is_current": F.lit(True), "batch_id": F.lit(1),
                       "effective_date": F.lit(effective).cast("date"), "end_date": _eot()})
    return assign_keys(b, ["broker_id"], "sk_brokerid")


# --- T3 company ----------------------------------------------------------------------

COMPANY_ATTRS = ["name", "status", "industry", "sp_rating", "is_lowgrade", "ceo", "address_line1",
                 "address_line2", "postal_code", "city", "state_prov", "country", "description",
                 "founding_date"]


def dim_company(cmp_records: DataFrame, statuses: DataFrame, industries: DataFrame) -> DataFrame:
    """CMP records -> type-2 company dimension with change detection on 14
    attributes; invalid ratings become null (the alert is raised apart)."""
    c = CL.blanks_to_null(cmp_records, ["CompanyName", "Status", "IndustryID", "SPrating", "FoundingDate",
                                        "AddrLine1", "AddrLine2", "PostalCode", "City", "StateProvince",
                                        "Country", "CEOname", "Description"])
    c = L.lookup_code(c, statuses, "Status", "ST_ID")
    c = L.lookup_code(c, industries, "IndustryID", "IN_ID")
    rating = F.when(CL.valid_rating(F.col("SPrating")), F.col("SPrating"))
    c = c.select(
        F.col("CIK").cast("long").alias("company_id"), "PTS",
        F.col("CompanyName").alias("name"), F.col("ST_NAME").alias("status"), F.col("IN_NAME").alias("industry"),
        rating.alias("sp_rating"), F.when(rating.isNotNull(), CL.low_grade(rating)).alias("is_lowgrade"),
        F.col("CEOname").alias("ceo"), F.col("AddrLine1").alias("address_line1"),
        F.col("AddrLine2").alias("address_line2"), F.col("PostalCode").alias("postal_code"),
        F.col("City").alias("city"), F.col("StateProvince").alias("state_prov"), F.col("Country").alias("country"),
        F.col("Description").alias("description"), CL.parse_yyyymmdd("FoundingDate").alias("founding_date"))
    v = H.scd2_intervals(c, "company_id", "PTS", attrs=COMPANY_ATTRS)
    v = v.drop("PTS").withColumn("batch_id", F.lit(1))
    return assign_keys(v, ["company_id", "effective_date"], "sk_companyid")


# --- T4 financial -------------------------------------------------------------------

def fact_financial(fin_records: DataFrame, company: DataFrame) -> DataFrame:
    """FIN records, each tied to the company version at its own posting date,
    by id or by name (J6, rule D25)."""
    f = fin_records.withColumn("__d", F.to_date("PTS"))
    hit = L.asof_dual_key(f, "CoNameOrCIK", "__d", company, "company_id", "name",
                          dim_cols=["sk_companyid", "effective_date", "end_date"])
    return hit.select(
        "sk_companyid", F.col("Year").cast("int").alias("fi_year"), F.col("Quarter").cast("int").alias("fi_qtr"),
        CL.parse_yyyymmdd("QtrStartDate").alias("fi_qtr_start_date"),
        CL.to_decimal("Revenue", 15, 2).alias("fi_revenue"), CL.to_decimal("Earnings", 18, 4).alias("fi_net_earn"),
        CL.to_decimal("EPS", 10, 2).alias("fi_basic_eps"), CL.to_decimal("DilutedEPS", 10, 2).alias("fi_dilut_eps"),
        CL.to_decimal("Margin", 10, 2).alias("fi_margin"), CL.to_decimal("Inventory", 15, 2).alias("fi_inventory"),
        CL.to_decimal("Assets", 15, 2).alias("fi_assets"), CL.to_decimal("Liabilities", 18, 4).alias("fi_liability"),
        F.col("ShOut").try_cast("long").alias("fi_out_basic"),
        F.col("DilutedShOut").try_cast("long").alias("fi_out_dilut"))


# --- T5 security ------------------------------------------------------------------------

def dim_security(sec_records: DataFrame, company: DataFrame, statuses: DataFrame) -> DataFrame:
    """SEC records: every later record of a symbol is a new version (no change
    test); the company is the version in force at the record's date."""
    s = L.lookup_code(sec_records.withColumn("__d", F.to_date("PTS")), statuses, "Status", "ST_ID")
    hit = L.asof_dual_key(s, "CoNameOrCIK", "__d", company, "company_id", "name",
                          dim_cols=["sk_companyid", "effective_date", "end_date"]).drop("effective_date", "end_date")
    sec = hit.select(
        F.col("Symbol").alias("symbol"), "PTS", F.col("IssueType").alias("issue"), F.col("ST_NAME").alias("status"),
        F.col("Name").alias("name"), F.col("ExID").alias("exchange_id"), "sk_companyid",
        F.col("ShOut").try_cast("long").alias("shares_outstanding"),
        CL.parse_yyyymmdd("FirstTradeDate").alias("first_trade"),
        CL.parse_yyyymmdd("FirstTradeExchg").alias("first_trade_on_exchange"),
        CL.to_decimal("Dividend", 12, 4).alias("dividend"))
    v = H.scd2_intervals(sec, "symbol", "PTS").drop("PTS").withColumn("batch_id", F.lit(1))
    return assign_keys(v, ["symbol", "effective_date"], "sk_securityid")


# --- T6 prospect ---------------------------------------------------------------------------

PERSON = ["first_name", "last_name", "address_line1", "address_line2", "postal_code"]


def prospect_rows(prospects: DataFrame) -> DataFrame:
    """The file's rows with normalised codes and marketing tags."""
    text = {"middle_initial": "MiddleInitial", "address_line1": "AddressLine1", "address_line2": "AddressLine2", "postal_code": "PostalCode",
            "city": "City", "state": "State", "country": "Country", "phone": "Phone", "employer": "Employer"}
    plain = {"income": "Income", "number_cars": "NumberCars", "number_children": "NumberChildren", "age": "Age", "credit_rating": "CreditRating",
             "number_credit_cards": "NumberCreditCards", "net_worth": "NetWorth"}
    return prospects.select(
        F.col("AgencyID").alias("agency_id"), CL.null_to_empty("LastName").alias("last_name"), CL.null_to_empty("FirstName").alias("first_name"),
        CL.normalise_code("Gender", CL.GENDER_CODES).alias("gender"), CL.normalise_code("MaritalStatus", CL.MARITAL_CODES).alias("marital_status"),
        CL.normalise_code("OwnOrRentFlag", CL.OWN_RENT_CODES).alias("own_or_rent"),
        *[CL.blank_to_null(c).alias(n) for n, c in text.items()], *[F.col(c).alias(n) for n, c in plain.items()],
        CL.nameplate_tags("NetWorth", "Income", "NumberChildren", "NumberCreditCards", "Age",
                          "CreditRating", "NumberCars").alias("marketing_nameplate"))


def current_active(customer: DataFrame) -> DataFrame:
    return customer.where(F.col("is_current") & (F.col("status") == "ACTIVE")).select(*PERSON)


def prospect_load(prospects: DataFrame, customers: DataFrame, batch_date, batch_id: int = 1) -> DataFrame:
    """Prospect table of one file: ``prospect_rows`` with the is-customer flag
    (T9: five fields, ignoring case, null equal to null, against ``customers``)."""
    p = prospect_rows(prospects)
    pairs = [(F.upper(p[c]), F.upper(customers[c])) for c in PERSON]
    d = date_key(F.lit(batch_date).cast("date"))
    return L.exists_flag(p, customers, pairs, flag="is_customer").withColumns(
        {"sk_recorddateid": d, "sk_updatedateid": d, "batch_id": F.lit(batch_id)})


# --- T7 customer -------------------------------------------------------------------------

# what an action may leave out; the running state fills it in
CUSTOMER_FILLED = ["tax_id", "status", "last_name", "first_name", "middle_initial", "gender", "tier", "dob", "address_line1", "address_line2",
                   "postal_code", "city", "state_prov", "country", "phone1", "phone2", "phone3", "email1", "email2", "nat_tax_id", "lcl_tax_id"]
_CUSTOMER_TEXT = [c for c in CUSTOMER_FILLED if c not in ("status", "gender", "tier", "dob")]
CUSTOMER_LOOKED_UP = ["national_tax_rate_desc", "national_tax_rate", "local_tax_rate_desc", "local_tax_rate",
                      "agency_id", "credit_rating", "net_worth", "marketing_nameplate"]
CUSTOMER_ATTRS = [c for c in CUSTOMER_FILLED if c not in ("nat_tax_id", "lcl_tax_id")] + CUSTOMER_LOOKED_UP


def _phone(struct: str) -> Column:
    """A phone that was sent, '' if without a number; null if it wasn't."""
    parts = [F.col(f"{struct}.{p}") for p in ("C_CTRY_CODE", "C_AREA_CODE", "C_LOCAL", "C_EXT")]
    return F.when(F.col(struct).isNotNull(), F.coalesce(CL.format_phone(*parts), F.lit("")))


def _clean_customer(df: DataFrame) -> DataFrame:
    """Empty text turns null and the gender code is normalised, after the fill."""
    return df.withColumns({c: CL.blank_to_null(c) for c in _CUSTOMER_TEXT} | {"gender": CL.normalise_code("gender", CL.GENDER_CODES)})


def customer_states(actions: DataFrame) -> DataFrame:
    """Customer actions in time order with absent fields filled from the
    running state (W8, rule D2); empty ones are values until after the fill."""
    return _customer_states(actions)[0]


def _customer_states(actions: DataFrame) -> tuple[DataFrame, bool]:
    """The states, and whether a task may sort all of a customer's."""
    col = F.col
    sent = {
        "tax_id": col("Customer._C_TAX_ID"), "last_name": col("Customer.Name.C_L_NAME"), "first_name": col("Customer.Name.C_F_NAME"),
        "middle_initial": col("Customer.Name.C_M_NAME"), "gender": col("Customer._C_GNDR"), "tier": col("Customer._C_TIER"), "dob": col("Customer._C_DOB"),
        "address_line1": col("Customer.Address.C_ADLINE1"), "address_line2": col("Customer.Address.C_ADLINE2"),
        "postal_code": col("Customer.Address.C_ZIPCODE"), "city": col("Customer.Address.C_CITY"), "state_prov": col("Customer.Address.C_STATE_PROV"),
        "country": col("Customer.Address.C_CTRY"), **{f"phone{n}": _phone(f"Customer.ContactInfo.C_PHONE_{n}") for n in (1, 2, 3)},
        "email1": col("Customer.ContactInfo.C_PRIM_EMAIL"), "email2": col("Customer.ContactInfo.C_ALT_EMAIL"),
        "nat_tax_id": col("Customer.TaxInfo.C_NAT_TX_ID"), "lcl_tax_id": col("Customer.TaxInfo.C_LCL_TX_ID"),
        "status": F.when(col("_ActionType") == "INACT", F.lit("INACTIVE")).when(col("_ActionType") == "NEW", F.lit("ACTIVE"))}
    a = actions.where(col("_ActionType").isin("NEW", "UPDCUST", "INACT")).select(
        col("Customer._C_ID").alias("customer_id"), col("_ActionTS").alias("ts"), col("_ActionType").alias("action"), "seq",
        *[c.alias(n) for n, c in sent.items()])
    whole = H.whole_keys(a, "customer_id")
    return _clean_customer(H.carry_forward(a, "customer_id", ["ts", "seq"], CUSTOMER_FILLED, whole=whole)), whole


def tax_lookups(df: DataFrame, tax_rates: DataFrame) -> DataFrame:
    """Name and rate of the national and the local tax code."""
    for kind, code in (("national", "nat_tax_id"), ("local", "lcl_tax_id")):
        rates = tax_rates.select(F.col("TX_ID").alias("__tx"), F.col("TX_NAME").alias(f"{kind}_tax_rate_desc"), F.col("TX_RATE").alias(f"{kind}_tax_rate"))
        df = L.lookup_code(df, rates, code, "__tx")
    return df


def match_prospects(people: DataFrame, earlier: DataFrame, this_batch: DataFrame | None = None) -> DataFrame:
    """Agency, rating, worth and tags of the prospect who is that person.

    Five fields, ignoring case, null equal to null; a prospect of an earlier
    batch goes before one of this batch, and of several the highest agency id
    wins.  One winner a person is chosen by a partial aggregate before the
    join, so people whose five fields are all null meet one row.
    """
    cols = ["agency_id", "credit_rating", "net_worth", "marketing_nameplate", *PERSON]
    candidates = earlier.select(*cols, F.lit(1).alias("__rank"))
    if this_batch is not None:
        candidates = candidates.unionByName(this_batch.select(*cols, F.lit(0).alias("__rank")))
    candidates = candidates.withColumn("__found", F.struct("agency_id", F.col("credit_rating").cast("int").alias("credit_rating"),
                                                           F.col("net_worth").cast("long").alias("net_worth"), "marketing_nameplate"))
    out = L.match_person(people, candidates, [(c, c) for c in PERSON], "__found", "__rank", "__match")
    return out.select("*", *[F.col(f"__match.{c}").alias(c) for c in CUSTOMER_LOOKED_UP[4:]]).drop("__match")


def dim_customer(actions: DataFrame, tax_rates: DataFrame, prospects: DataFrame) -> DataFrame:
    """One version per action day (last action of a day wins), no change test;
    ``prospects`` are ``prospect_rows``, matched by current versions only (D1)."""
    s, whole = _customer_states(actions)
    v = tax_lookups(H.scd2_intervals(s, "customer_id", "ts", order=["seq"], whole=whole), tax_rates)
    # numbered first: a person has one prospect, and both kinds of versions are read from the numbered stage
    with compiled_methods(actions.sparkSession):
        v = assign_keys(v, ["customer_id", "effective_date"], "sk_customerid")
    current = match_prospects(v.where("is_current"), prospects)
    closed = v.where("not is_current").select("*", *[F.lit(None).cast(current.schema[c].dataType).alias(c) for c in CUSTOMER_LOOKED_UP[4:]])
    return closed.unionByName(current).select("customer_id", *CUSTOMER_ATTRS, "is_current", F.lit(1).alias("batch_id"), "effective_date", "end_date",
                                              "sk_customerid")


# --- T10 account -----------------------------------------------------------------------

ACCOUNT_FILLED = ["customer_id", "account_desc", "tax_status", "broker_id", "status"]
ACCOUNT_OWN = ("NEW", "ADDACCT", "UPDACCT", "CLOSEACCT")


def account_states(actions: DataFrame) -> DataFrame:
    return _account_states(actions)[0]


def _account_states(actions: DataFrame) -> tuple[DataFrame, bool]:
    """The state of every account after each action that reaches it.

    Two streams are replayed as one.  An account's own actions (NEW, ADDACCT,
    UPDACCT, CLOSEACCT) send some of its fields; UPDACCT leaves it active and
    CLOSEACCT inactive.  An action on its customer (UPDCUST, INACT) reaches
    every account that the customer has opened by then (rule D23) and sends
    nothing but the status of INACT.  Fields that aren't sent come from the
    account's running state.  The customer stream meets its accounts by an
    equi join on the customer, a row for each version the account gets.

    Also given: whether a task may sort all states of an account.  These are
    at most its own actions and those on the one customer that opened it.
    """
    from histmart.sources.readers import explode_accounts

    status = F.when(F.col("_ActionType") == "CLOSEACCT", "INACTIVE").otherwise("ACTIVE")
    own = explode_accounts(actions.where(F.col("_ActionType").isin(*ACCOUNT_OWN))).select(
        F.col("CA_ID").alias("account_id"), F.col("_ActionTS").alias("ts"), "seq", F.col("_ActionType").alias("action"), F.col("C_ID").alias("customer_id"),
        F.col("CA_NAME").alias("account_desc"), F.col("CA_TAX_ST").alias("tax_status"), F.col("CA_B_ID").alias("broker_id"), status.alias("status"))
    opened = own.groupBy("account_id").agg(F.min(F.struct("ts", "seq")).alias("__opened"), F.min_by("customer_id", F.struct("ts", "seq")).alias("customer_id"))
    of_customer = actions.where(F.col("_ActionType").isin("UPDCUST", "INACT")).select(
        F.col("Customer._C_ID").alias("customer_id"), F.col("_ActionTS").alias("ts"), "seq", F.col("_ActionType").alias("action"))
    reached = of_customer.join(opened, "customer_id").where(F.struct("ts", "seq") > F.col("__opened")).select(
        "account_id", "ts", "seq", "action", F.lit(None).cast("long").alias("customer_id"), F.lit(None).cast("string").alias("account_desc"),
        F.lit(None).cast("int").alias("tax_status"), F.lit(None).cast("long").alias("broker_id"),
        F.when(F.col("action") == "INACT", "INACTIVE").alias("status"))
    whole = all(H.whole_keys(df, key, H.HOT_ROWS // 2) for df, key in ((own, "account_id"), (of_customer, "customer_id")))
    filled = H.carry_forward(own.unionByName(reached), "account_id", ["ts", "seq"], ACCOUNT_FILLED, whole=whole)
    return filled.withColumn("account_desc", CL.blank_to_null("account_desc")), whole


def dim_account(actions: DataFrame, customer: DataFrame, broker: DataFrame) -> DataFrame:
    """One version per account and day on which an action reaches it (the last
    of a day wins, D15), with the customer and the broker version in force."""
    states, whole = _account_states(actions)
    v = H.scd2_intervals(states, "account_id", "ts", order=["seq"], whole=whole)
    for dim, key, sk in ((customer, "customer_id", "sk_customerid"), (broker, "broker_id", "sk_brokerid")):
        d = dim.select(F.col(key).alias("__key"), sk, F.col("effective_date").alias("__eff"), F.col("end_date").alias("__end"))
        v = L.asof_lookup(v, d, key, "__key", "effective_date", eff="__eff", end="__end", how="left", dim_cols=[sk, "__eff", "__end"]).drop("__eff", "__end")
    v = v.select("account_id", "sk_brokerid", "sk_customerid", "status", "account_desc", "tax_status",
                 "is_current", F.lit(1).alias("batch_id"), "effective_date", "end_date")
    with compiled_methods(actions.sparkSession):
        return assign_keys(v, ["account_id", "effective_date"], "sk_accountid")


# --- T12 trade ----------------------------------------------------------------------------

def dim_trade(trades: DataFrame, history: DataFrame, security: DataFrame, account: DataFrame,
              statuses: DataFrame, types: DataFrame) -> DataFrame:
    """Trade rows with create / close stamps from their history (G11), status
    and type names (J2), security and account versions at the create time
    (J4), calendar keys (J3 by formula on the date and time parts)."""
    life = FX.lifecycle_collapse(history, "TH_T_ID", "TH_DTS", "TH_ST_ID", ["PNDG", "SBMT"], ["CMPT", "CNCL"])
    t = trades.join(life, trades.T_ID == life.TH_T_ID, "inner").drop("TH_T_ID")
    t = L.lookup_code(t, statuses, "T_ST_ID", "ST_ID")
    t = L.lookup_code(t, types.select("TT_ID", "TT_NAME"), "T_TT_ID", "TT_ID")
    t = t.withColumn("__cd", F.to_date("create_ts"))
    sec = security.select("symbol", "sk_securityid", "sk_companyid", "effective_date", "end_date")
    t = L.asof_lookup(t, sec, "T_S_SYMB", "symbol", "__cd",
                      dim_cols=["sk_securityid", "sk_companyid", "effective_date", "end_date"]) \
        .drop("effective_date", "end_date")
    acc = account.select("account_id", "sk_accountid", "sk_customerid", "sk_brokerid", "effective_date", "end_date")
    t = L.asof_lookup(t, acc, "T_CA_ID", "account_id", "__cd",
                      dim_cols=["sk_accountid", "sk_customerid", "sk_brokerid", "effective_date", "end_date"]) \
        .drop("effective_date", "end_date")
    secs = lambda c: (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("int")
    return t.select(
        F.col("T_ID").alias("trade_id"), "sk_brokerid",
        date_key(F.col("create_ts")).alias("sk_createdateid"), secs(F.col("create_ts")).alias("sk_createtimeid"),
        date_key(F.col("close_ts")).alias("sk_closedateid"), secs(F.col("close_ts")).alias("sk_closetimeid"),
        F.col("ST_NAME").alias("status"), F.col("TT_NAME").alias("type"), (F.col("T_IS_CASH") == 1).alias("cash_flag"),
        "sk_securityid", "sk_companyid", F.col("T_QTY").alias("quantity"), F.col("T_BID_PRICE").alias("bid_price"),
        "sk_customerid", "sk_accountid", F.col("T_EXEC_NAME").alias("executed_by"),
        F.col("T_TRADE_PRICE").alias("trade_price"), F.col("T_CHRG").alias("fee"),
        F.col("T_COMM").alias("commission"), F.col("T_TAX").alias("tax"), F.lit(1).alias("batch_id"))


# --- T14 cash ------------------------------------------------------------------------------

def fact_cash(cash: DataFrame, account: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """One row per account and day with the running balance (G12, W3); keys
    from the account version in force that day."""
    daily = FX.daily_net(cash, "CT_CA_ID", "CT_DTS", "CT_AMT", amount_type="decimal(15,2)")
    bal = FX.running_balance(daily, "CT_CA_ID", opening=opening)
    acc = account.select("account_id", "sk_accountid", "sk_customerid", "effective_date", "end_date")
    hit = L.asof_lookup(bal, acc, "CT_CA_ID", "account_id", "day",
                        dim_cols=["sk_accountid", "sk_customerid", "effective_date", "end_date"])
    return hit.select("sk_customerid", "sk_accountid", date_key(F.col("day")).alias("sk_dateid"),
                      F.col("balance").alias("cash"), F.lit(1).alias("batch_id"))


# --- T15 holdings -----------------------------------------------------------------------

def fact_holdings(holdings: DataFrame, trade: DataFrame) -> DataFrame:
    """Holding changes enriched from the trade that made them."""
    t = trade.select("trade_id", "sk_customerid", "sk_accountid", "sk_securityid", "sk_companyid",
                     "trade_price", "sk_closedateid", "sk_closetimeid")
    j = holdings.join(t, holdings.HH_T_ID == t.trade_id, "inner")
    return j.select(F.col("HH_H_T_ID").alias("trade_id"), F.col("HH_T_ID").alias("current_trade_id"),
                    "sk_customerid", "sk_accountid", "sk_securityid", "sk_companyid",
                    F.col("trade_price").alias("current_price"), F.col("HH_AFTER_QTY").alias("current_holding"),
                    F.col("sk_closedateid").alias("sk_dateid"), F.col("sk_closetimeid").alias("sk_timeid"),
                    F.lit(1).alias("batch_id"))


# --- T16 market history ------------------------------------------------------------------

def fact_market(market: DataFrame, security: DataFrame, company: DataFrame, financial: DataFrame,
                tasks: int | None = None) -> DataFrame:
    """Daily market rows with 52-week (365-day) high/low and their dates
    (W4-W6), security/company versions of the day (J4), yield and P/E on
    the company's trailing four quarters of EPS (W7, J11 as equi key on the
    prior quarter start, rule D19: joined on the company id).  ``tasks``: as
    in ``rolling_extremes``."""
    r = FX.rolling_extremes(market, "DM_S_SYMB", "DM_DATE", "DM_HIGH", "DM_LOW", days=365, tasks=tasks)
    if "__new" in market.columns:  # look-back rows of earlier batches only feed the windows (D9)
        r = r.where(F.col("__new")).drop("__new")
    sec = security.select("symbol", "sk_securityid", "sk_companyid", "dividend", "effective_date", "end_date")
    # company id behind the security's company surrogate: one join of versions, none of the daily rows
    cid = company.select(F.col("sk_companyid").alias("__csk"), F.col("company_id").alias("__cid"))
    sec = sec.join(cid, sec.sk_companyid == cid.__csk, "left").drop("__csk")
    r = L.asof_lookup(r, sec, "DM_S_SYMB", "symbol", "DM_DATE",
                      dim_cols=["sk_securityid", "sk_companyid", "dividend", "__cid", "effective_date", "end_date"]) \
        .drop("effective_date", "end_date")
    fin = financial.join(company.select("sk_companyid", "company_id"), "sk_companyid") \
        .groupBy("company_id", "fi_qtr_start_date").agg(F.sum("fi_basic_eps").alias("eps"))
    fin = FX.trailing_sum(fin, "company_id", ["fi_qtr_start_date"], "eps", rows=4, out="eps_4q")
    fin = fin.select(F.col("company_id").alias("__fcid"), F.col("fi_qtr_start_date").alias("__q"), "eps_4q")
    r = r.withColumn("__pq", FX.prior_quarter_start(F.col("DM_DATE")))
    r = r.join(fin, (r.__cid == fin.__fcid) & (r.__pq == fin.__q), "left")
    close = F.col("DM_CLOSE").cast("double")
    return r.select(
        "sk_securityid", "sk_companyid", date_key(F.col("DM_DATE")).alias("sk_dateid"),
        F.try_divide(close, F.col("eps_4q").cast("double")).alias("pe_ratio"),
        (F.try_divide(F.col("dividend").cast("double"), close) * 100).alias("yield"),
        F.col("high_365").alias("fifty_two_week_high"), date_key(F.col("high_365_date")).alias("sk_fiftytwoweekhighdate"),
        F.col("low_365").alias("fifty_two_week_low"), date_key(F.col("low_365_date")).alias("sk_fiftytwoweeklowdate"),
        F.col("DM_CLOSE").alias("close_price"), F.col("DM_HIGH").alias("day_high"), F.col("DM_LOW").alias("day_low"),
        F.col("DM_VOL").alias("volume"), F.lit(1).alias("batch_id"))


# --- T17 watches ----------------------------------------------------------------------------

def fact_watches(watches: DataFrame, customer: DataFrame, security: DataFrame) -> DataFrame:
    """One row per (customer, symbol): first placement, last cancel (G6, rule
    D24); customer and security versions in force at the placement day."""
    w = watches.groupBy("W_C_ID", "W_S_SYMB").agg(
        F.min(F.when(F.col("W_ACTION") == "ACTV", F.col("W_DTS"))).alias("placed"),
        F.max(F.when(F.col("W_ACTION") == "CNCL", F.col("W_DTS"))).alias("removed"))
    w = w.where(F.col("placed").isNotNull()).withColumn("__pd", F.to_date("placed"))
    cust = customer.select("customer_id", "sk_customerid", "effective_date", "end_date")
    w = L.asof_lookup(w, cust, "W_C_ID", "customer_id", "__pd",
                      dim_cols=["sk_customerid", "effective_date", "end_date"]).drop("effective_date", "end_date")
    sec = security.select("symbol", "sk_securityid", "effective_date", "end_date")
    w = L.asof_lookup(w, sec, "W_S_SYMB", "symbol", "__pd",
                      dim_cols=["sk_securityid", "effective_date", "end_date"]).drop("effective_date", "end_date")
    return w.select("sk_customerid", "sk_securityid", date_key(F.col("placed")).alias("sk_dateid_dateplaced"),
                    date_key(F.col("removed")).alias("sk_dateid_dateremoved"), F.lit(1).alias("batch_id"))




# --- change batches (T8, T11, T13) ------------------------------------------------------

def customer_changes(cdc_rows: DataFrame, batch_date, tax_rates: DataFrame, earlier: DataFrame, this_batch: DataFrame) -> DataFrame:
    """Customer CDC rows -> one change per customer (highest DSN, D12/D17),
    effective on the batch date, with taxes and the matching prospect."""
    from histmart.operators.cdc import latest_per_key

    col = F.col
    phone = lambda n: CL.format_phone(*[col(f"{p}_{n}") for p in ("C_CTRY", "C_AREA", "C_LOCAL", "C_EXT")])
    last = latest_per_key(cdc_rows, "C_ID", ["CDC_DSN"])
    sent = {"tax_id": "C_TAX_ID", "last_name": "C_L_NAME", "first_name": "C_F_NAME", "middle_initial": "C_M_NAME", "gender": "C_GNDR", "tier": "C_TIER",
            "dob": "C_DOB", "address_line1": "C_ADLINE1", "address_line2": "C_ADLINE2", "postal_code": "C_ZIPCODE", "city": "C_CITY",
            "state_prov": "C_STATE_PROV", "country": "C_CTRY", "email1": "C_EMAIL_1", "email2": "C_EMAIL_2", "nat_tax_id": "C_NAT_TX_ID", "lcl_tax_id": "C_LCL_TX_ID"}
    rows = last.select(col("C_ID").alias("customer_id"), *[col(c).alias(n) for n, c in sent.items()], *[phone(n).alias(f"phone{n}") for n in (1, 2, 3)],
                       F.when(col("C_ST_ID") == "INAC", F.lit("INACTIVE")).when(col("C_ST_ID") == "ACTV", F.lit("ACTIVE")).alias("status"),
                       F.lit(batch_date).cast("timestamp").alias("__ts"), col("CDC_DSN").alias("__dsn"))
    return match_prospects(tax_lookups(_clean_customer(rows), tax_rates), earlier, this_batch)


def dim_customer_cdc(current: DataFrame, cdc_rows: DataFrame, batch_date, tax_rates: DataFrame, earlier: DataFrame,
                     this_batch: DataFrame, batch_id: int, highest: DataFrame | int) -> DataFrame:
    """Change batch for the customer dimension (T8): every changed customer
    gets a new version from the batch date (K4); new customers are inserted.
    ``current`` are the current versions before; the result is those after,
    with the ones that were closed.  ``earlier`` are the prospects of earlier
    batches, ``this_batch`` the rows of the batch's own file."""
    chg = customer_changes(cdc_rows, batch_date, tax_rates, earlier, this_batch)
    return H.scd2_merge(current, chg, "customer_id", CUSTOMER_ATTRS, "__ts", order=["__dsn"], sk_col="sk_customerid",
                        highest=highest, detect_changes=False, stamp={"batch_id": batch_id})


def dim_account_cdc(current: DataFrame, accounts: DataFrame, customer: DataFrame, broker: DataFrame,
                    batch_date, batch_id: int, highest: DataFrame | int) -> DataFrame:
    """Change batch for the account dimension (T11): each new customer version
    of the batch opens a version of every account of that customer with the
    new customer surrogate and status (K8, rule D16); broker is the current
    one (J7).  An account with a row of its own in the batch (``in_batch``)
    gets a version too if its customer didn't change, and the row's status
    wins.  ``current`` are the current versions before; the result is those
    after, with the ones that were closed."""
    new_cust = customer.where(F.col("batch_id") == batch_id).select(
        "customer_id", "sk_customerid", "status", "effective_date")
    casc = H.cascade_versions(new_cust, accounts, "customer_id", "customer_id", carry=["status"],
                              parent_sk="sk_customerid", child_parent_sk="sk_customerid")
    own = accounts.where("in_batch").join(casc.select("account_id"), "account_id", "left_anti")
    own = L.lookup_current(own, customer.withColumnRenamed("status", "customer_status"), "customer_id", "customer_id", ["sk_customerid", "customer_status"])
    wanted = ["account_id", "broker_id", "sk_customerid", "account_desc", "tax_status", "account_status"]
    casc = casc.select(*wanted, F.col("status").alias("customer_status"), F.col("cascade_eff").cast("timestamp").alias("__ts")).unionByName(
        own.select(*wanted, "customer_status", F.lit(batch_date).cast("timestamp").alias("__ts")))
    casc = L.lookup_current(casc, broker, "broker_id", "broker_id", ["sk_brokerid"])
    chg = casc.select("account_id", "sk_brokerid", "sk_customerid", F.coalesce("account_status", "customer_status").alias("status"),
                      "account_desc", "tax_status", "__ts")
    return H.scd2_merge(current, chg, "account_id", ["sk_brokerid", "sk_customerid", "status", "account_desc", "tax_status"], "__ts",
                        sk_col="sk_accountid", highest=highest, detect_changes=False, stamp={"batch_id": batch_id})


def trade_lifecycle(history: DataFrame) -> DataFrame:
    life = FX.lifecycle_collapse(history, "TH_T_ID", "TH_DTS", "TH_ST_ID", ["PNDG", "SBMT"], ["CMPT", "CNCL"])
    return life.select(F.col("TH_T_ID").alias("trade_id"), "create_ts", "close_ts",
                       F.col("last_status").alias("status_id"))


def dim_trade_cdc(base_history: DataFrame, cdc_rows: DataFrame, statuses: DataFrame,
                  batch_date, batch_id: int = 2) -> DataFrame:
    """Change batch for the trade table (T13): an insert row sets the create
    stamp, a completion or cancel row the close stamp and status (K5; the
    create stamp of an existing trade is kept)."""
    from histmart.operators.cdc import cdc_upsert

    base = trade_lifecycle(base_history).where(F.col("create_ts").isNotNull())
    rows = cdc_rows.select(
        F.col("T_ID").alias("trade_id"), F.col("CDC_DSN").alias("dsn"),
        F.when(F.col("CDC_FLAG") == "I", F.col("T_DTS")).alias("create_ts"),
        F.when(F.col("T_ST_ID").isin("CMPT", "CNCL"), F.col("T_DTS")).alias("close_ts"),
        F.col("T_ST_ID").alias("status_id"))
    chg = FX.last_nonnull(rows, "trade_id", ["dsn"], ["create_ts", "close_ts", "status_id"])
    t = cdc_upsert(base, chg, "trade_id", keep_from_target=["create_ts"])
    t = L.lookup_code(t, statuses, "status_id", "ST_ID")
    secs = lambda c: (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("int")
    return t.select(
        "trade_id", F.col("ST_NAME").alias("status"),
        date_key(F.col("create_ts")).alias("sk_createdateid"), secs(F.col("create_ts")).alias("sk_createtimeid"),
        date_key(F.col("close_ts")).alias("sk_closedateid"), secs(F.col("close_ts")).alias("sk_closetimeid"),
        F.when(F.col("create_ts") >= F.lit(batch_date).cast("timestamp"), F.lit(batch_id))
         .otherwise(F.lit(batch_id - 1)).alias("batch_id"))


def account_changes(prev_account: DataFrame, prev_customer: DataFrame, broker: DataFrame,
                    account_rows: DataFrame) -> DataFrame:
    """Account list for a change batch: the current accounts of the previous
    version (business keys recovered from the surrogates with equi joins)
    overlaid with the latest Account.txt row per account (G8, D12)."""
    from histmart.operators.cdc import latest_per_key

    cust = prev_customer.select(F.col("sk_customerid").alias("__csk"), F.col("customer_id").alias("__cid"))
    brk = broker.select(F.col("sk_brokerid").alias("__bsk"), F.col("broker_id").alias("__bid"))
    cur = (prev_account.where(F.col("is_current"))
           .join(cust, F.col("sk_customerid") == F.col("__csk"), "left")
           .join(brk, F.col("sk_brokerid") == F.col("__bsk"), "left")
           .select("account_id", F.col("__cid").alias("customer_id"), F.col("__bid").alias("broker_id"),
                   "account_desc", "tax_status", F.lit(None).cast("string").alias("account_status"), F.lit(False).alias("in_batch")))
    new = latest_per_key(account_rows, "CA_ID", ["CDC_DSN"]).select(
        F.col("CA_ID").alias("account_id"), F.col("CA_C_ID").alias("customer_id"),
        F.col("CA_B_ID").alias("broker_id"), F.col("CA_NAME").alias("account_desc"),
        F.col("CA_TAX_ST").alias("tax_status"),
        F.when(F.col("CA_ST_ID") == "INAC", "INACTIVE").when(F.col("CA_ST_ID") == "ACTV", "ACTIVE").alias("account_status"),
        F.lit(True).alias("in_batch"))
    return cur.join(new.select("account_id"), "account_id", "left_anti").unionByName(new)


def market_with_lookback(previous_raw: DataFrame | None, new_raw: DataFrame, days: int = 365) -> DataFrame:
    """Rolling windows of a change batch see the last ``days - 1`` days of
    earlier raw market rows too (rule D9); only the batch's own rows are
    returned by the caller's filter on ``__new``."""
    new = new_raw.withColumn("__new", F.lit(True))
    if previous_raw is None:
        return new
    first = new_raw.agg(F.min("DM_DATE")).scalar()
    old = previous_raw.where(F.col("DM_DATE") >= F.date_sub(first, days - 1)).where(F.col("DM_DATE") < first)
    return old.withColumn("__new", F.lit(False)).unionByName(new)


def market_tail(raw: DataFrame, days: int = 365) -> DataFrame:
    """The last ``days - 1`` days of raw market rows: all that later windows see."""
    last = raw.agg(F.max("DM_DATE")).scalar()
    return raw.where(F.col("DM_DATE") > F.date_sub(last, days - 1))


def opening_balances(prev_cash: DataFrame, account: DataFrame) -> DataFrame:
    """Last balance per account id of the previous batches (rule D8)."""
    acc = account.select(F.col("sk_accountid").alias("__ask"), F.col("account_id").alias("CT_CA_ID"))
    last = prev_cash.groupBy("sk_accountid").agg(F.max_by("cash", "sk_dateid").alias("opening"),
                                                 F.max("sk_dateid").alias("__d"))
    per_id = last.join(acc, F.col("sk_accountid") == F.col("__ask"))
    return per_id.groupBy("CT_CA_ID").agg(F.max_by("opening", "__d").alias("opening"))


def trade_change_batch(prev: DataFrame, rows: DataFrame, security: DataFrame, account: DataFrame,
                       statuses: DataFrame, types: DataFrame, batch_id: int) -> DataFrame:
    """Trade CDC rows of a batch merged into the trade table.

    Rows collapse per trade to the last non-null value of each field (G5);
    an insert sets the create stamps, a completion or cancel the close
    stamps.  New trades take the current security and account versions
    (J7); existing trades keep their keys and create stamps.
    """
    from histmart.operators.cdc import cdc_upsert

    secs = lambda c: (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("int")
    r = rows.select(
        "T_ID", "CDC_DSN", F.when(F.col("CDC_FLAG") == "I", F.col("T_DTS")).alias("create_ts"),
        F.when(F.col("T_ST_ID").isin("CMPT", "CNCL"), F.col("T_DTS")).alias("close_ts"),
        "T_ST_ID", "T_TT_ID", "T_IS_CASH", "T_S_SYMB", "T_QTY", "T_BID_PRICE", "T_CA_ID", "T_EXEC_NAME",
        "T_TRADE_PRICE", "T_CHRG", "T_COMM", "T_TAX")
    fields = [c for c in r.columns if c not in ("T_ID", "CDC_DSN")]
    c = FX.last_nonnull(r, "T_ID", ["CDC_DSN"], fields)
    c = L.lookup_current(c, security, "T_S_SYMB", "symbol", ["sk_securityid", "sk_companyid"])
    c = L.lookup_current(c, account, "T_CA_ID", "account_id", ["sk_accountid", "sk_customerid", "sk_brokerid"])
    c = L.lookup_code(c, statuses, "T_ST_ID", "ST_ID")
    c = L.lookup_code(c, types.select("TT_ID", "TT_NAME"), "T_TT_ID", "TT_ID")
    chg = c.select(
        F.col("T_ID").alias("trade_id"), "sk_brokerid",
        date_key(F.col("create_ts")).alias("sk_createdateid"), secs(F.col("create_ts")).alias("sk_createtimeid"),
        date_key(F.col("close_ts")).alias("sk_closedateid"), secs(F.col("close_ts")).alias("sk_closetimeid"),
        F.col("ST_NAME").alias("status"), F.col("TT_NAME").alias("type"), (F.col("T_IS_CASH") == 1).alias("cash_flag"),
        "sk_securityid", "sk_companyid", F.col("T_QTY").alias("quantity"), F.col("T_BID_PRICE").alias("bid_price"),
        "sk_customerid", "sk_accountid", F.col("T_EXEC_NAME").alias("executed_by"),
        F.col("T_TRADE_PRICE").alias("trade_price"), F.col("T_CHRG").alias("fee"),
        F.col("T_COMM").alias("commission"), F.col("T_TAX").alias("tax"), F.lit(batch_id).alias("batch_id"))
    chg = chg.select(*[F.col(x).cast(prev.schema[x].dataType) for x in prev.columns])
    keep = ["sk_brokerid", "sk_createdateid", "sk_createtimeid", "sk_securityid", "sk_companyid",
            "sk_customerid", "sk_accountid", "batch_id"]
    return cdc_upsert(prev, chg, "trade_id", keep_from_target=keep).select(*prev.columns)


def watch_change_batch(prev: DataFrame, rows: DataFrame, prev_customer: DataFrame, customer: DataFrame,
                       security: DataFrame, batch_id: int) -> DataFrame:
    """Watch rows of a batch merged into the watch fact (K7, rule D24).

    Stored rows name customer and security by surrogate; both are resolved
    to business keys (equi joins on the surrogate), merged with the batch on
    (customer, symbol): first placement kept, latest cancel wins; merged
    rows point at the current customer version.  No all-pairs of versions.
    """
    cust_key = prev_customer.select(F.col("sk_customerid").alias("__csk"), F.col("customer_id").alias("__cid"))
    sec_key = security.select(F.col("sk_securityid").alias("__ssk"), F.col("symbol").alias("__sym"))
    stored = (prev.join(cust_key, F.col("sk_customerid") == F.col("__csk"))
                  .join(sec_key, F.col("sk_securityid") == F.col("__ssk"))
                  .select(F.col("__cid").alias("W_C_ID"), F.col("__sym").alias("W_S_SYMB"),
                          "sk_customerid", "sk_securityid", "sk_dateid_dateplaced", "sk_dateid_dateremoved",
                          "batch_id"))
    w = rows.groupBy("W_C_ID", "W_S_SYMB").agg(
        F.min(F.when(F.col("W_ACTION") == "ACTV", F.col("W_DTS"))).alias("placed"),
        F.max(F.when(F.col("W_ACTION") == "CNCL", F.col("W_DTS"))).alias("removed"))
    w = L.lookup_current(w, customer, "W_C_ID", "customer_id", ["sk_customerid"])
    w = L.lookup_current(w, security, "W_S_SYMB", "symbol", ["sk_securityid"])
    new = w.select(F.col("W_C_ID").alias("__c"), F.col("W_S_SYMB").alias("__s"),
                   F.col("sk_customerid").alias("__nsk"), F.col("sk_securityid").alias("__nssk"),
                   date_key(F.col("placed")).alias("__p"), date_key(F.col("removed")).alias("__r"))
    j = stored.join(new, (F.col("W_C_ID") == F.col("__c")) & (F.col("W_S_SYMB") == F.col("__s")), "full_outer")
    return j.select(
        F.coalesce("__nsk", "sk_customerid").alias("sk_customerid"),
        F.coalesce("sk_securityid", "__nssk").alias("sk_securityid"),
        F.coalesce("sk_dateid_dateplaced", "__p").alias("sk_dateid_dateplaced"),
        F.coalesce("__r", "sk_dateid_dateremoved").alias("sk_dateid_dateremoved"),
        F.coalesce(F.col("batch_id"), F.lit(batch_id)).alias("batch_id")).where(
        # as in the first load: a watch needs its placement, customer and security
        "sk_customerid is not null and sk_securityid is not null and sk_dateid_dateplaced is not null")


PROSPECT_ATTRS = ["last_name", "first_name", "middle_initial", "gender", "address_line1", "address_line2", "postal_code", "city", "state", "country",
                  "phone", "income", "number_cars", "number_children", "marital_status", "age", "credit_rating", "own_or_rent", "employer",
                  "number_credit_cards", "net_worth"]


def prospect_change_batch(prev: DataFrame, new: DataFrame, batch_date) -> tuple[DataFrame, DataFrame]:
    """Prospect file of a change batch merged into the prospect table (K6,
    T18).  Every row of the file moves its record date; the update date
    moves only when an attribute other than the customer flag changed
    (null-safe); prospects absent from the file stay as they are.  Returns
    (table, counters) with the three load counters of rule D21."""
    from histmart.operators.cdc import upsert_keep_first

    d = date_key(F.lit(batch_date).cast("date"))
    merged = upsert_keep_first(prev, new.drop("sk_updatedateid"), "agency_id", first_cols=[],
                               changed_cols=PROSPECT_ATTRS, stamp_col="sk_updatedateid", stamp_value=d)
    a, b = prev.alias("a"), new.alias("b")
    j = b.join(a, F.col("a.agency_id") == F.col("b.agency_id"), "left")
    changed = F.lit(False)
    for c in PROSPECT_ATTRS:
        changed = changed | ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    counts = j.agg(F.count(F.lit(1)).alias("src"), F.count_if(F.col("a.agency_id").isNull()).alias("ins"),
                   F.count_if(F.col("a.agency_id").isNotNull() & changed).alias("upd"))
    stack = F.explode(F.array(
        F.struct(F.lit("Source rows").alias("counter"), F.col("src").alias("value")),
        F.struct(F.lit("Inserted rows").alias("counter"), F.col("ins").alias("value")),
        F.struct(F.lit("Updated rows").alias("counter"), F.col("upd").alias("value"))))
    counters = counts.select(stack.alias("s")).select("s.counter", "s.value")
    return merged.select(*prev.columns), counters
