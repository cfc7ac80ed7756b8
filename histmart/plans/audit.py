"""Audit of a loaded warehouse as one DataFrame.

``audit_warehouse`` takes the tables returned by ``historical_load`` /
``change_load`` and returns ``(test, batch_id, result, description)`` rows,
sorted only for the report; ``audit_values``, ``audit_windows``, ``audit_expected``
and ``audit_trends`` do the same for values, for the days and counts that the
audit files give, and for counts over batches and snapshots; ``audit_all`` is
all of them.  Every check is an aggregate, a left-anti
join, a key-equi join with a date range residual, or a single ``lead``
pass over day-level versions: no quadratic self joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histmart.operators import checks as CK

# The SCD2 dimensions, their business key and surrogate.
VERSIONED = (("dim_company", "company_id", "sk_companyid"), ("dim_security", "symbol", "sk_securityid"),
             ("dim_customer", "customer_id", "sk_customerid"), ("dim_account", "account_id", "sk_accountid"),
             ("dim_broker", "broker_id", "sk_brokerid"))

# References of the warehouse (child table, column, parent table, parent key).
REFERENCES = (("dim_account", "sk_brokerid", "dim_broker", "sk_brokerid"),
              ("dim_account", "sk_customerid", "dim_customer", "sk_customerid"),
              ("dim_security", "sk_companyid", "dim_company", "sk_companyid"),
              ("dim_trade", "sk_brokerid", "dim_broker", "sk_brokerid"),
              ("dim_trade", "sk_createdateid", "dim_date", "SK_DateID"),
              ("dim_trade", "sk_createtimeid", "dim_time", "SK_TimeID"),
              ("dim_trade", "sk_closedateid", "dim_date", "SK_DateID"),
              ("dim_trade", "sk_closetimeid", "dim_time", "SK_TimeID"),
              ("dim_trade", "sk_securityid", "dim_security", "sk_securityid"),
              ("dim_trade", "sk_companyid", "dim_company", "sk_companyid"),
              ("dim_trade", "sk_customerid", "dim_customer", "sk_customerid"),
              ("dim_trade", "sk_accountid", "dim_account", "sk_accountid"),
              ("fact_cash", "sk_customerid", "dim_customer", "sk_customerid"),
              ("fact_cash", "sk_accountid", "dim_account", "sk_accountid"),
              ("fact_cash", "sk_dateid", "dim_date", "SK_DateID"),
              ("fact_holdings", "sk_customerid", "dim_customer", "sk_customerid"),
              ("fact_holdings", "sk_accountid", "dim_account", "sk_accountid"),
              ("fact_holdings", "sk_securityid", "dim_security", "sk_securityid"),
              ("fact_holdings", "sk_companyid", "dim_company", "sk_companyid"),
              ("fact_holdings", "sk_dateid", "dim_date", "SK_DateID"),
              ("fact_holdings", "sk_timeid", "dim_time", "SK_TimeID"),
              ("fact_market", "sk_securityid", "dim_security", "sk_securityid"),
              ("fact_market", "sk_companyid", "dim_company", "sk_companyid"),
              ("fact_market", "sk_dateid", "dim_date", "SK_DateID"),
              ("fact_watches", "sk_customerid", "dim_customer", "sk_customerid"),
              ("fact_watches", "sk_securityid", "dim_security", "sk_securityid"),
              ("fact_watches", "sk_dateid_dateplaced", "dim_date", "SK_DateID"),
              ("fact_watches", "sk_dateid_dateremoved", "dim_date", "SK_DateID"),
              ("prospect", "sk_updatedateid", "dim_date", "SK_DateID"))

# Fact date inside the referenced version (child, date key, surrogate, parent).
CONTAINMENT = (("dim_trade", "sk_createdateid", "sk_accountid", "dim_account"),
               ("dim_trade", "sk_createdateid", "sk_securityid", "dim_security"),
               ("fact_cash", "sk_dateid", "sk_accountid", "dim_account"),
               ("fact_market", "sk_dateid", "sk_securityid", "dim_security"),
               ("fact_watches", "sk_dateid_dateplaced", "sk_customerid", "dim_customer"))


def _row(df: DataFrame, test: str, batch: Column, ok: Column, description: str) -> DataFrame:
    return CK.check_frame(df, test, batch, ok, description)


def _date_of_key(c: Column) -> Column:
    return F.to_date(c.cast("string"), "yyyyMMdd")


def audit_warehouse(t: dict[str, DataFrame]) -> DataFrame:
    frames = []
    none = F.lit(None).cast("int")
    # Q2: surrogate keys unique per table
    for name, _, sk in VERSIONED:
        frames.append(CK.keys_unique(t[name], f"{name} keys unique", [sk]))
    frames.append(CK.keys_unique(t["dim_trade"], "dim_trade keys unique", ["trade_id"]))
    # Q4: version intervals in one lead pass each
    for name, key, _ in VERSIONED:
        r = CK.interval_report(t[name], [key])
        ok = ((F.col("misaligned") == 0) & (F.col("overlapping") == 0) & (F.col("empty") == 0)
              & (F.col("bad_current") == 0) & (F.col("not_reaching_end") == 0))
        frames.append(_row(r, f"{name} intervals", none, ok,
                           "Versions chain, do not overlap, are not empty, one current reaching end of time"))
    # Q6: references resolve, all of them in one grouped count
    edges = CK.reference_report(t, REFERENCES)
    frames.append(edges.select(
        F.concat("child", F.lit("."), "column", F.lit(" resolves")).alias("test"), none.alias("batch_id"),
        CK.verdict(F.col("orphans") == 0).alias("result"),
        F.concat(F.lit("Every "), "column", F.lit(" exists in "), "parent").alias("description")))
    # Q6 with dates: the fact date lies inside the referenced version
    for child, dkey, sk, parent in CONTAINMENT:
        p = t[parent].select(F.col(sk).alias("__sk"), "effective_date", "end_date")
        j = t[child].where(F.col(sk).isNotNull()).join(p, F.col(sk) == F.col("__sk"))
        d = _date_of_key(F.col(dkey))
        bad = j.agg(F.count_if((d < F.col("effective_date")) | (d >= F.col("end_date"))).alias("n"))
        frames.append(_row(bad, f"{child}.{dkey} inside {parent} version", none, F.col("n") == 0,
                           "Fact date inside the referenced version"))
    # Q5: value domains
    dom = [("dim_customer", F.col("status").isin("ACTIVE", "INACTIVE"), "Customer status"),
           ("dim_customer", F.col("tier").isNull() | F.col("tier").isin(1, 2, 3), "Customer tier"),
           ("dim_trade", F.col("status").isin("Completed", "Canceled", "Pending", "Submitted"), "Trade status"),
           ("dim_company", F.col("sp_rating").isNull() | F.col("sp_rating").rlike("^[A-D]"), "Company rating")]
    for name, pred, desc in dom:
        v = t[name].agg(F.count_if(~F.coalesce(pred, F.lit(False))).alias("n"))
        frames.append(_row(v, f"{name} domain: {desc}", none, F.col("n") == 0, f"{desc} in its domain"))
    # Q8: price order on the market table
    m = t["fact_market"]
    order = ((F.col("fifty_two_week_low") <= F.col("day_low")) & (F.col("day_low") <= F.col("close_price"))
             & (F.col("close_price") <= F.col("day_high")) & (F.col("day_high") <= F.col("fifty_two_week_high")))
    v = m.groupBy("batch_id").agg(F.count_if(~F.coalesce(order, F.lit(False))).alias("n"))
    frames.append(_row(v, "fact_market price order", F.col("batch_id"), F.col("n") == 0,
                       "52-week low <= day low <= close <= day high <= 52-week high"))
    # Q3: batches present in every fact and dimension with a batch column
    expected = t["dim_customer"].agg(F.countDistinct("batch_id")).scalar()  # scalar subquery
    for name in ("dim_customer", "dim_account", "dim_trade", "fact_cash", "fact_market"):
        got = t[name].agg(F.countDistinct("batch_id").alias("got"))
        frames.append(_row(got, f"{name} batches", none, F.col("got") == expected,
                           "Same batches as the customer dimension"))
    # Q9 / Q14: message log present for every batch; inactive customer count reported
    log = t["dimessages"].groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    frames.append(_row(log, "message log", F.col("batch_id"), F.col("n") > 0, "Messages were logged"))
    return _union_all(frames)


def _union_all(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def report(audit: DataFrame) -> DataFrame:
    """The audit ordered by test and batch, as the reference reports it."""
    return audit.orderBy("test", "batch_id")


# Tables counted by a snapshot, and the joins of each fact with its
# dimensions: (source, column of it or of a dimension joined before, dimension, key).
SNAPSHOT_TABLES = ("dim_account", "dim_broker", "dim_company", "dim_customer", "dim_date", "dim_security", "dim_time",
                   "dim_trade", "fact_cash", "fact_holdings", "fact_market", "fact_watches", "financial", "industry",
                   "prospect", "status_type", "tax_rate", "trade_type")
_ACCOUNT = (("sk_accountid", "dim_account", "sk_accountid"), ("sk_customerid", "dim_customer", "sk_customerid"),
            ("__sk_brokerid", "dim_broker", "sk_brokerid"), ("sk_dateid", "dim_date", "SK_DateID"))
_COMPANY = (("sk_companyid", "dim_company", "sk_companyid"), ("sk_securityid", "dim_security", "sk_securityid"))
SNAPSHOT_JOINS = {"fact_cash": _ACCOUNT,
                  "fact_holdings": (*_ACCOUNT, ("sk_timeid", "dim_time", "SK_TimeID"), *_COMPANY),
                  "fact_market": (("sk_dateid", "dim_date", "SK_DateID"), *_COMPANY),
                  "fact_watches": (("sk_customerid", "dim_customer", "sk_customerid"),
                                   ("sk_dateid_dateplaced", "dim_date", "SK_DateID"), _COMPANY[1])}
# message type of a snapshot -> whether it has the joined counts and the extra counts
VALIDATION, FULL, LIGHT = "Validation", "Visibility_1", "Visibility_2"
_PARTS = {VALIDATION: (True, True), FULL: (True, False), LIGHT: (False, False)}


def _joined(t: dict[str, DataFrame], fact: str) -> DataFrame:
    """The rows of a fact that meet all its dimensions."""
    joins = SNAPSHOT_JOINS[fact]
    out = t[fact].select(*[c for c, _, _ in joins if not c.startswith("__")])
    for col, dim, key in joins:
        keys = [F.col(key).alias("__key")]
        if dim == "dim_account":  # an account's broker is joined through it
            keys.append(F.col("sk_brokerid").alias("__sk_brokerid"))
        out = out.join(t[dim].select(*keys), F.col(col) == F.col("__key")).drop("__key")
    return out


def snapshot(spark: SparkSession, t: dict[str, DataFrame], batch_id: int, kind: str = VALIDATION) -> DataFrame:
    """Counts of the tables ``t`` as message-log rows (M1, M3, M4): a count for
    each table, and, but for ``LIGHT``, the fact rows that meet all their
    dimensions; ``VALIDATION`` adds inactive customers and watches.  A table
    that isn't there yet counts 0."""
    joined, extra = _PARTS[kind]
    frames = []

    def row(source: str, text: str, df: DataFrame | None) -> None:
        n = spark.range(1).select(F.lit(0).cast("long").alias("n")) if df is None else df.agg(F.count(F.lit(1)).alias("n"))
        frames.append(n.select(
            F.lit(batch_id).alias("batch_id"), F.lit(source).alias("message_source"), F.lit(text).alias("message_text"),
            F.lit(kind).alias("message_type"), F.col("n").cast("string").alias("message_data")))

    for name in SNAPSHOT_TABLES:
        row(name, "Row count", t.get(name))
    for fact, joins in SNAPSHOT_JOINS.items() if joined else ():
        there = fact in t and all(dim in t for _, dim, _ in joins)
        row(fact, "Row count joined", _joined(t, fact) if there else None)
    if extra:
        customer, watches = t.get("dim_customer"), t.get("fact_watches")
        row("dim_customer", "Inactive customers", None if customer is None
            else customer.where(F.col("is_current") & (F.upper("status") == "INACTIVE")))
        row("fact_watches", "Inactive watches", None if watches is None
            else watches.where(F.col("sk_dateid_dateremoved").isNotNull()))
    return _union_all(frames)


def phase_record(spark: SparkSession, batch_id: int, phase: str) -> DataFrame:
    """The message that a phase is complete (M2)."""
    return spark.range(1).select(
        F.lit(batch_id).alias("batch_id"), F.lit("Phase").alias("message_source"),
        F.lit(f"{phase} complete").alias("message_text"), F.lit("PCR").alias("message_type"),
        F.lit(None).cast("string").alias("message_data"))


def validation_snapshot(spark: SparkSession, t: dict[str, DataFrame], batch_id: int, phase: str) -> DataFrame:
    """The 24 validation rows of a phase and its phase record, for one append."""
    return snapshot(spark, t, batch_id).unionByName(phase_record(spark, batch_id, phase))


# --- counts against the audit files (S14, Q1, Q9, Q11) ----------------------------------

# Data sets that the audit files must hold.
DATA_SETS = ("Batch", "DimAccount", "DimBroker", "DimCompany", "DimCustomer", "DimSecurity", "DimTrade", "FactHoldings",
             "FactMarketHistory", "FactWatches", "Financial", "Generator", "Prospect")

# What a test compares: the batch's own values (of the first, of later or of all
# batches), those up to the batch, or all values in one row without a batch.
OWN, FIRST, LATER, UP_TO, UP_TO_FIRST, ALL = "own", "first", "later", "up to", "up to first", "all"

# Test -> (relation of the count to the expected value, which batches, signed attributes).
_ACCOUNT_ROWS = (("DimAccount", "CA_ADDACCT", 1), ("DimAccount", "CA_CLOSEACCT", 1), ("DimAccount", "CA_UPDACCT", 1),
                 ("DimAccount", "CA_ID_HIST", -1))
_CUSTOMER_ROWS = (("DimCustomer", "C_NEW", 1), ("DimCustomer", "C_UPDCUST", 1), ("DimCustomer", "C_INACT", 1),
                  ("DimCustomer", "C_ID_HIST", -1))
EXPECTED = (
    ("DimBroker row count", "=", ALL, (("DimBroker", "HR_BROKERS", 1),)),
    ("DimAccount row count", ">", FIRST, (*_ACCOUNT_ROWS, *_CUSTOMER_ROWS)),
    ("DimAccount row count", ">=", LATER, _ACCOUNT_ROWS),
    ("DimCustomer row count", ">=", OWN, _CUSTOMER_ROWS),
    ("DimCustomer inactive customers", "=", UP_TO, (("DimCustomer", "C_INACT", 1),)),
    ("DimCustomer age range alerts", "=", OWN, (("DimCustomer", "C_DOB_TO", 1), ("DimCustomer", "C_DOB_TY", 1))),
    ("DimCustomer customer tier alerts", "=", OWN, (("DimCustomer", "C_TIER_INV", 1),)),
    ("DimSecurity row count", ">=", UP_TO_FIRST, (("DimSecurity", "FW_SEC", 1),)),
    ("DimCompany row count", "<=", UP_TO, (("DimCompany", "FW_CMP", 1),)),
    ("FactWatches row count", "=", OWN, (("FactWatches", "WH_ACTIVE", 1),)),
    ("FactWatches active watches", "=", UP_TO, (("FactWatches", "WH_RECORDS", 1),)),
    ("DimTrade row count", "=", UP_TO, (("DimTrade", "T_NEW", 1),)),
    ("DimTrade canceled trades", "=", ALL, (("DimTrade", "T_CanceledTrades", 1),)),
    ("DimTrade commission alerts", "=", ALL, (("DimTrade", "T_InvalidCommision", 1),)),
    ("DimTrade charge alerts", "=", ALL, (("DimTrade", "T_InvalidCharge", 1),)),
    ("Financial row count", "=", ALL, (("Financial", "FW_FIN", 1),)),
    ("FactMarketHistory row count", "=", OWN, (("FactMarketHistory", "DM_RECORDS", 1),)),
    ("FactHoldings row count", "=", OWN, (("FactHoldings", "HH_RECORDS", 1),)),
)


def expected_counts(audit: DataFrame) -> DataFrame:
    """(test, batch_id, relation, expected): a row for each test and batch of the
    audit files; the expected value is null where one of its attributes is missing."""
    tests = F.array(*[F.struct(F.lit(test).alias("test"), F.lit(rel).alias("relation"), F.lit(which).alias("which"),
                               F.lit(len(terms)).alias("terms")) for test, rel, which, terms in EXPECTED])
    first = (F.col("which").isin(FIRST, UP_TO_FIRST, ALL)) & (F.col("batch") == 1)
    wanted = (audit.where(F.col("BatchID") >= 1).select(F.col("BatchID").alias("batch")).distinct()
              .select("batch", F.explode(tests).alias("t")).select("batch", "t.*")
              .where(first | F.col("which").isin(OWN, UP_TO) | ((F.col("which") == LATER) & (F.col("batch") > 1))))
    terms = F.array(*[F.struct(F.lit(test).alias("test"), F.lit(which).alias("which"), F.lit(ds).alias("ds"), F.lit(attr).alias("attr"),
                               F.lit(sign).alias("sign")) for test, _, which, ts in EXPECTED for ds, attr, sign in ts])
    values = (audit.where(F.col("Value").isNotNull()).select("DataSet", "BatchID", "Attribute", "Value", F.explode(terms).alias("t"))
              .where((F.col("DataSet") == F.col("t.ds")) & (F.col("Attribute") == F.col("t.attr")))
              .groupBy(F.col("t.test").alias("__test"), F.col("t.which").alias("__which"), F.col("t.attr").alias("attr"), "BatchID")
              .agg(F.sum(F.col("Value") * F.col("t.sign")).alias("value")))
    own = F.col("which").isin(OWN, FIRST, LATER) & (F.col("BatchID") == F.col("batch"))
    up_to = F.col("which").isin(UP_TO, UP_TO_FIRST) & (F.col("BatchID") <= F.col("batch"))
    hit = (F.col("test") == F.col("__test")) & (F.col("which") == F.col("__which")) & (own | up_to | (F.col("which") == ALL))
    g = wanted.join(values, hit, "left").groupBy("test", "batch", "which", "relation", "terms").agg(
        F.sum("value").alias("value"), F.countDistinct("attr").alias("found"))
    return g.select("test", F.when(F.col("which") != ALL, F.col("batch")).alias("batch_id"), "relation",
                    F.when(F.col("found") == F.col("terms"), F.col("value")).alias("expected"))


def measured_counts(t: dict[str, DataFrame]) -> DataFrame:
    """(test, batch_id, actual): the counts that ``EXPECTED`` asks for, from the
    loaded tables and the message log."""
    log = t["dimessages"]
    none = F.lit(None).cast("int")
    # logged counts by source, text and batch: some 24 rows a batch
    logged = (log.where(F.col("message_type") == "Validation")
              .select("batch_id", "message_source", "message_text", F.col("message_data").try_cast("long").alias("n")))
    w = Window.partitionBy("message_source", "message_text").orderBy("batch_id")
    logged = logged.withColumn("more", F.col("n") - F.lag("n").over(w))
    frames = []

    def measure(test: str, df: DataFrame, batch: Column, actual: Column) -> None:
        frames.append(df.select(F.lit(test).alias("test"), batch.cast("int").alias("batch_id"), actual.cast("long").alias("actual")))

    def from_log(test: str, source: str, column: str = "n") -> None:
        rows = logged.where((F.col("message_source") == source) & (F.col("message_text") == "Row count"))
        measure(test, rows, F.col("batch_id"), F.col(column))

    def alerts(test: str, text: str, by_batch: bool) -> None:
        found = (F.col("message_type") == "Alert") & (F.col("message_text") == text)
        rows = log.groupBy("batch_id") if by_batch else log.groupBy()
        measure(test, rows.agg(F.count_if(found).alias("n")), F.col("batch_id") if by_batch else none, F.col("n"))

    total = F.count(F.lit(1)).alias("n")
    measure("DimBroker row count", t["dim_broker"].agg(total), none, F.col("n"))
    for test, name in (("DimAccount row count", "dim_account"), ("DimCustomer row count", "dim_customer")):
        measure(test, t[name].groupBy("batch_id").agg(total), F.col("batch_id"), F.col("n"))
    inactive = logged.where((F.col("message_source") == "dim_customer") & (F.col("message_text") == "Inactive customers"))
    measure("DimCustomer inactive customers", inactive, F.col("batch_id"), F.col("n"))
    alerts("DimCustomer age range alerts", "DOB out of range", True)
    alerts("DimCustomer customer tier alerts", "Invalid customer tier", True)
    from_log("DimSecurity row count", "dim_security")
    from_log("DimCompany row count", "dim_company")
    from_log("FactWatches row count", "fact_watches", "more")
    both = logged.where((F.col("message_source") == "fact_watches") & F.col("message_text").isin("Row count", "Inactive watches"))
    measure("FactWatches active watches", both.groupBy("batch_id").agg(F.sum("n").alias("n")), F.col("batch_id"), F.col("n"))
    from_log("DimTrade row count", "dim_trade")
    measure("DimTrade canceled trades", t["dim_trade"].agg(F.count_if(F.upper("status") == "CANCELED").alias("n")), none, F.col("n"))
    alerts("DimTrade commission alerts", "Invalid trade commission", False)
    alerts("DimTrade charge alerts", "Invalid trade fee", False)
    first = logged.where((F.col("message_source") == "financial") & (F.col("message_text") == "Row count") & (F.col("batch_id") == 1))
    measure("Financial row count", first, none, F.col("n"))
    from_log("FactMarketHistory row count", "fact_market", "more")
    from_log("FactHoldings row count", "fact_holdings", "more")
    return _union_all(frames)


def audit_expected(t: dict[str, DataFrame], audit: DataFrame, batches: int = 3) -> DataFrame:
    """The loaded warehouse held against the audit files (``readers.read_audit``):
    the files themselves (Q11), the message log (Q9) and every count (Q1), in
    the columns of ``audit_warehouse``.  A count without an expected value, or
    the other way round, is not OK."""
    none = F.lit(None).cast("int")
    log = t["dimessages"]
    n_batches = audit.where(F.col("BatchID") >= 1).agg(F.countDistinct("BatchID").alias("n"), F.max("BatchID").alias("last"))
    sets = audit.where(F.col("DataSet").isin(*DATA_SETS)).agg(F.countDistinct("DataSet").alias("n"))
    whole = (F.col("n") == batches + 1) & (F.col("last") == batches)  # and batch 0, before the first
    span = [F.countDistinct("batch_id").alias("n"), F.max("batch_id").alias("last")]
    validation = F.col("message_type") == "Validation"
    sources = log.where(validation & F.col("message_source").isin(*SNAPSHOT_TABLES)).agg(F.countDistinct("message_source").alias("n"))
    frames = [
        _row(n_batches, "Audit table batches", none, (F.col("n") == batches) & (F.col("last") == batches), "Audit data for every batch"),
        _row(sets, "Audit table sources", none, F.col("n") == len(DATA_SETS), "Audit data for all data sets"),
        _row(log.groupBy("batch_id").agg(F.count_if(validation).alias("n")), "Validation reports", F.col("batch_id"),
             F.col("n") == len(SNAPSHOT_TABLES) + len(SNAPSHOT_JOINS) + 2, "A full set of validation rows in every batch"),
        _row(log.agg(*span), "Message batches", none, whole, "Messages for every batch and the state before the first"),
        _row(log.where(F.col("message_type") == "PCR").agg(*span), "Phase records", none, whole, "Every phase recorded as complete"),
        _row(sources, "Message sources", none, F.col("n") == len(SNAPSHOT_TABLES), "Messages for all tables"),
        _row(log.agg(F.count_if(validation & (F.col("batch_id") == 0) & (F.col("message_data") != "0")).alias("n")),
             "Initial condition", none, F.col("n") == 0, "All tables empty before the first batch"),
    ]
    actual, want = measured_counts(t), expected_counts(audit)
    hit = (want["test"] == actual["test"]) & want["batch_id"].eqNullSafe(actual["batch_id"])
    a, e = F.col("actual"), F.col("expected")
    ok = (F.when(F.col("relation") == "=", a == e).when(F.col("relation") == ">", a > e)
          .when(F.col("relation") == ">=", a >= e).otherwise(a <= e))
    rows = want.join(actual, hit, "left").select(
        want["test"], want["batch_id"], CK.verdict(F.coalesce(ok, F.lit(False))).alias("result"),
        F.concat(F.lit("Actual count "), "relation", F.lit(" expected value of the audit files")).alias("description"))
    return _union_all([*frames, rows])


# --- values, windows and trends (Q5, Q7, Q8, Q10, Q12, Q13) -------------------------------

_STATUS = "upper(status) IN ('ACTIVE', 'INACTIVE')"
_PHONE = "{0} = '' OR {0} LIKE '+1 (___) ___-____%' OR {0} LIKE '(___) ___-____%' OR {0} LIKE '___-____%'"

# Table -> test -> SQL condition that each row keeps, null counting as kept.
VALUE_RULES = {
    "dim_account": {"Status": _STATUS, "TaxStatus": "batch_id <> 1 OR tax_status IN (0, 1, 2)"},
    "dim_customer": {"Status": _STATUS, "Gender": "gender IN ('M', 'F', 'U')", "TaxID": "tax_id LIKE '___-__-____'",
                     **{f"Phone{n}": _PHONE.format(f"phone{n}") for n in (1, 2, 3)},
                     "Email1": "email1 LIKE '_%.%@%.%'", "Email2": "email2 = '' OR email2 LIKE '_%.%@%.%'"},
    "dim_security": {"Status": _STATUS, "ExchangeID": "exchange_id IN ('NYSE', 'NASDAQ', 'AMEX', 'PCX')",
                     "Issue": "issue IN ('COMMON', 'PREF_A', 'PREF_B', 'PREF_C', 'PREF_D')"},
    "dim_company": {"Status": _STATUS, "Country": "country IN ('Canada', 'United States of America', '')",
                    "SPrating": "sp_rating IN ('AAA', 'AA', 'A', 'BBB', 'BB', 'B', 'CCC', 'CC', 'C', 'D', 'AA+', 'A+', 'BBB+', 'BB+', 'B+', "
                                "'CCC+', 'AA-', 'A-', 'BBB-', 'BB-', 'B-', 'CCC-')"},
    "dim_trade": {"Status": "status IN ('Canceled', 'Pending', 'Submitted', 'Active', 'Completed')",
                  "Type": "type IN ('Market Buy', 'Market Sell', 'Stop Loss', 'Limit Sell', 'Limit Buy')"},
    "financial": {"FI_QTR": "fi_qtr IN (1, 2, 3, 4)",
                  "FI_QTR_START_DATE": "fi_qtr_start_date = make_date(fi_year, fi_qtr * 3 - 2, 1)",
                  "EPS": "abs(round(try_divide(fi_net_earn, fi_out_basic), 2) - fi_basic_eps) <= 0.4 "
                         "AND abs(round(try_divide(fi_net_earn, fi_out_dilut), 2) - fi_dilut_eps) <= 0.4 "
                         "AND abs(round(try_divide(fi_net_earn, fi_revenue), 2) - fi_margin) <= 0.4"},
    "prospect": {"Country": "country IN ('Canada', 'United States of America')", "SK_UpdateDateID": "sk_recorddateid >= sk_updatedateid",
                 "MarketingNameplate": " AND ".join(f"(NOT coalesce({when}, false) OR marketing_nameplate LIKE '%{tag}%')" for tag, when in (
                     ("HighValue", "net_worth > 1000000 OR income > 200000"), ("Expenses", "number_children > 3 OR number_credit_cards > 5"),
                     ("Boomer", "age > 45"), ("MoneyAlert", "income < 50000 OR credit_rating < 600 OR net_worth < 100000"),
                     ("Spender", "number_cars > 3 OR number_credit_cards > 7"), ("Inherited", "age < 25 AND net_worth > 1000000")))},
}


def audit_values(t: dict[str, DataFrame]) -> DataFrame:
    """Every value rule (Q5, Q8), all those of a table in one pass, and the
    rules between rows (Q10): names of one company each, known industries, no
    open account of a customer who left."""
    none = F.lit(None).cast("int")
    frames = []
    for name, rules in VALUE_RULES.items():
        counts = t[name].agg(*[F.count_if(~F.expr(rule)).alias(test) for test, rule in rules.items()])
        rows = counts.select(F.explode(F.array(*[F.struct(F.lit(test).alias("test"), F.col(f"`{test}`").alias("n")) for test in rules])).alias("r"))
        frames.append(rows.select(F.concat(F.lit(f"{name} "), "r.test").alias("test"), none.alias("batch_id"),
                                  CK.verdict(F.col("r.n") == 0).alias("result"), F.lit("All values are valid").alias("description")))
    company = t["dim_company"]
    # the smallest and the largest id of a name: no list of ids
    names = company.where(F.col("name").isNotNull()).groupBy("name").agg(F.min("company_id").alias("lo"), F.max("company_id").alias("hi"))
    shared = names.agg(F.count_if(F.col("lo") != F.col("hi")).alias("n"))
    frames.append(_row(shared, "dim_company distinct names", none, F.col("n") == 0, "Every company has a name of its own"))
    unknown = company.join(t["industry"].select(F.col("IN_NAME").alias("industry")), "industry", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    frames.append(_row(unknown, "dim_company Industry", none, F.col("n") == 0, "Industries are from the industry table"))
    left = t["dim_customer"].where(F.col("is_current") & (F.upper("status") == "INACTIVE")).select("sk_customerid")
    open_ = t["dim_account"].where(F.col("is_current") & (F.upper("status") != "INACTIVE")).join(left, "sk_customerid", "left_semi")
    frames.append(_row(open_.agg(F.count(F.lit(1)).alias("n")), "dim_account inactive customers", none, F.col("n") == 0,
                       "Accounts of an inactive customer are inactive"))
    return _union_all(frames)


def _day(column: str) -> str:
    return f"to_date(cast({column} AS STRING), 'yyyyMMdd')"


# Table -> SQL condition of a row on its batch's first and last day, and on the first day of all.
_EFFECTIVE = "effective_date BETWEEN first_day AND last_day"
WINDOW_RULES = {
    "dim_account": _EFFECTIVE, "dim_customer": _EFFECTIVE, "dim_security": _EFFECTIVE, "dim_company": _EFFECTIVE,
    "prospect": f"{_day('sk_recorddateid')} >= first_day",
    "fact_market": f"{_day('sk_dateid')} >= date_sub(first_day, 1) AND {_day('sk_dateid')} < last_day",
    "fact_watches": f"{_day('coalesce(sk_dateid_dateremoved, sk_dateid_dateplaced)')} BETWEEN first_day AND last_day "
                    "AND sk_dateid_dateplaced <= coalesce(sk_dateid_dateremoved, sk_dateid_dateplaced)",
    "dim_trade": f"{_day('coalesce(sk_closedateid, sk_createdateid)')} "
                 "BETWEEN if(sk_closedateid IS NULL AND type LIKE 'Limit%', start, first_day) AND last_day "
                 "AND sk_createdateid <= coalesce(sk_closedateid, sk_createdateid)",
    "fact_holdings": f"{_day('sk_dateid')} BETWEEN first_day AND last_day",
    "fact_cash": f"{_day('sk_dateid')} BETWEEN first_day AND last_day",
}


def audit_windows(t: dict[str, DataFrame], audit: DataFrame) -> DataFrame:
    """Q7: the rows of a batch lie in its days, taken from the audit files; a row
    a table and batch.  Rows of a batch without days there are not OK."""
    days = audit.where((F.col("DataSet") == "Batch") & (F.col("BatchID") >= 1)).groupBy("BatchID").agg(
        F.max(F.when(F.col("Attribute") == "FirstDay", F.col("Date"))).alias("first_day"),
        F.max(F.when(F.col("Attribute") == "LastDay", F.col("Date"))).alias("last_day"))
    days = days.withColumn("start", days.agg(F.min("first_day")).scalar())
    frames = []
    for name, rule in WINDOW_RULES.items():
        rows = t[name].join(days, F.col("batch_id") == F.col("BatchID"), "left")
        bad = F.col("first_day").isNull() | F.col("last_day").isNull() | ~F.expr(rule)
        frames.append(_row(rows.groupBy("batch_id").agg(F.count_if(bad).alias("n")), f"{name} dates in batch", F.col("batch_id"),
                           F.col("n") == 0, "All dates are in the batch's time window"))
    return _union_all(frames)


def audit_trends(log: DataFrame, visibility: DataFrame | None = None) -> DataFrame:
    """Q12 over the validation rows of the message log, Q13 over the snapshots
    taken beside the loads (``visibility.read_log``): counts never fall, and
    facts meet all their dimensions.  Some twenty rows a batch or snapshot."""
    def count(df: DataFrame, *keys: str) -> DataFrame:
        def n(text):
            return F.max(F.when(F.col("message_text") == text, F.col("message_data").try_cast("long")))
        return df.groupBy("message_source", *keys).agg(n("Row count").alias("n"), n("Row count joined").alias("joined"))

    def earlier(key: str):
        # the largest count before: no pairs of snapshots
        return F.max("n").over(Window.partitionBy("message_source").orderBy(key).rowsBetween(Window.unboundedPreceding, -1))

    def rows(df: DataFrame, prefix: str, batch: Column, ok: Column, text: str) -> DataFrame:
        return df.select(F.concat(F.lit(prefix), "message_source").alias("test"), batch.alias("batch_id"),
                         CK.verdict(F.coalesce(ok, F.lit(False))).alias("result"), F.lit(text).alias("description"))

    none = F.lit(None).cast("int")
    falls, match = "Row counts do not decrease", "Row counts match when joined to dimensions"
    by_batch = count(log.where(F.col("message_type") == VALIDATION), "batch_id").withColumn("before", earlier("batch_id")).where("batch_id >= 1")
    frames = [rows(by_batch, "Batch row count: ", F.col("batch_id"), F.col("n") >= F.coalesce("before", F.lit(0)), falls),
              rows(by_batch.where(F.col("message_source").isin(*SNAPSHOT_JOINS)), "Batch joined row count: ", F.col("batch_id"), F.col("n") == F.col("joined"), match)]
    if visibility is not None:
        shots = count(visibility.where(F.col("message_type").isin(FULL, LIGHT)), "message_type", "snapshot_ts").withColumn("before", earlier("snapshot_ts"))
        fell = shots.groupBy("message_source").agg(F.count_if(F.col("n") < F.col("before")).alias("n"))
        frames.append(rows(fell, "Data visibility row counts: ", none, F.col("n") == 0, falls))
        full = shots.where((F.col("message_type") == FULL) & F.col("message_source").isin(*SNAPSHOT_JOINS))
        differ = full.groupBy("message_source").agg(F.count_if(~F.col("n").eqNullSafe(F.col("joined"))).alias("n"))
        frames.append(rows(differ, "Data visibility joined row counts: ", none, F.col("n") == 0, match))
    return _union_all(frames)


def audit_all(t: dict[str, DataFrame], audit: DataFrame, batches: int = 3, visibility: DataFrame | None = None) -> DataFrame:
    """Every check of a loaded warehouse: its tables, their values, the audit
    files, and the counts over batches and snapshots."""
    return _union_all([audit_warehouse(t), audit_values(t), audit_windows(t, audit), audit_expected(t, audit, batches),
                       audit_trends(t["dimessages"], visibility)])
