"""Historical load of a raw batch folder as a chain of Spark jobs.

``historical_load`` reads every extract of ``Batch1`` with its schema, runs
the transforms of ``histmart.plans.warehouse`` in dependency order, writes
each table once as version 1 of ``<out_root>/<table>`` and reads it back, so
every later stage starts from the written table (lineage cut, survives lost
executors, and each dimension is computed once for all its users).  All
alerts of the batch are appended to the message log in one write.  A batch's
tables are committed together at its end (``sinks.Batch``); ``read_batch``
gives the tables of the last committed batch, also beside a running load.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.functions import clean as CL
from histmart.operators import quality as Q
from histmart.plans import warehouse as W
from histmart.plans.audit import phase_record, snapshot, validation_snapshot
from histmart.session import materialize, temporary_tables
from histmart.sources import readers as R
from histmart.sources import schemas as S
from histmart.sources import sinks


# kind and surrogate key of the tables that a batch doesn't replace whole
KINDS = {"dim_customer": (sinks.HISTORY, "sk_customerid"), "dim_account": (sinks.HISTORY, "sk_accountid"),
         "rejects": (sinks.APPEND, None), "fact_cash": (sinks.APPEND, None), "fact_holdings": (sinks.APPEND, None), "fact_market": (sinks.APPEND, None)}


# The column rules that tables are created with (K10), as SQL conditions.
RULES = {"trade_type": ("TT_IS_SELL IN (0, 1)", "TT_IS_MRKT IN (0, 1)"),
         "financial": ("fi_qtr IN (1, 2, 3, 4)",),
         "fact_holdings": ("current_price > 0",),
         "prospect": ("gender IN ('M', 'F', 'U')", "marital_status IN ('S', 'M', 'D', 'W', 'U')", "own_or_rent IN ('O', 'R', 'U')")}


def _save(df: DataFrame, batch: sinks.Batch, name: str) -> DataFrame:
    kind, key = KINDS.get(name, (sinks.REPLACE, None))
    return batch.save(name, df, kind, key, RULES.get(name, ()))


def historical_load(spark: SparkSession, batch_dir: str, out_root: str, action_tag: str = "Action") -> dict[str, DataFrame]:
    """Load ``batch_dir`` (the raw historical batch) into ``out_root``;
    ``action_tag`` is the element name of a customer action, with its prefix."""
    with temporary_tables(spark):
        return _historical_load(spark, batch_dir, out_root, action_tag)


def _historical_load(spark: SparkSession, batch_dir: str, out_root: str, action_tag: str) -> dict[str, DataFrame]:
    def path(name):
        return os.path.join(batch_dir, name)

    batch, files = sinks.Batch(spark, out_root, 1), R.BatchFiles(spark, batch_dir)
    batch_date = R.read_batch_date(spark, path("BatchDate.txt"))
    t: dict[str, DataFrame] = {}

    # Calendar and code tables, loaded as they are
    t["dim_date"] = _save(files.read("Date.txt", S.DATE), batch, "dim_date")
    t["dim_time"] = _save(files.read("Time.txt", S.TIME), batch, "dim_time")
    t["industry"] = _save(files.read("Industry.txt", S.INDUSTRY), batch, "industry")
    t["status_type"] = _save(files.read("StatusType.txt", S.STATUS_TYPE), batch, "status_type")
    t["trade_type"] = _save(files.read("TradeType.txt", S.TRADE_TYPE), batch, "trade_type")

    t["tax_rate"] = _save(files.read("TaxRate.txt", S.TAX_RATE), batch, "tax_rate")

    # Broker, effective from the first calendar day (one driver scalar)
    first_day = t["dim_date"].agg(F.min("DateValue")).first()[0]
    hr = files.read("HR.csv", S.HR, sep=",")
    t["dim_broker"] = _save(W.dim_broker(hr, first_day), batch, "dim_broker")

    # FINWIRE parsed once, three record types
    finwire = materialize(R.read_fixed_width_lines(spark, path("FINWIRE[0-9]*Q[1-4]")), "finwire")
    cmp_ = R.fixed_width_records(finwire, "CMP")
    t["dim_company"] = _save(W.dim_company(cmp_, t["status_type"], t["industry"]), batch, "dim_company")
    t["financial"] = _save(W.fact_financial(R.fixed_width_records(finwire, "FIN"), t["dim_company"]), batch, "financial")
    t["dim_security"] = _save(W.dim_security(R.fixed_width_records(finwire, "SEC"), t["dim_company"],
                                             t["status_type"]), batch, "dim_security")

    # Customers are matched with prospects, prospects are flagged as customers
    actions = materialize(R.read_actions(spark, path("CustomerMgmt.xml"), action_tag), "actions")
    prospects = files.read("Prospect.csv", S.PROSPECT, sep=",")
    t["dim_customer"] = _save(W.dim_customer(actions, t["tax_rate"], W.prospect_rows(prospects)), batch, "dim_customer")
    t["dim_account"] = _save(W.dim_account(actions, t["dim_customer"], t["dim_broker"]), batch, "dim_account")
    t["prospect"] = _save(W.prospect_load(prospects, W.current_active(t["dim_customer"]), batch_date), batch, "prospect")

    # facts
    trades = files.read("Trade.txt", S.TRADE)
    history = files.read("TradeHistory.txt", S.TRADE_HISTORY)
    t["dim_trade"] = _save(W.dim_trade(trades, history, t["dim_security"], t["dim_account"], t["status_type"],
                                       t["trade_type"]), batch, "dim_trade")
    cash = files.read("CashTransaction.txt", S.CASH_TRANSACTION)
    t["fact_cash"] = _save(W.fact_cash(cash, t["dim_account"]), batch, "fact_cash")
    holdings = files.read("HoldingHistory.txt", S.HOLDING_HISTORY)
    t["fact_holdings"] = _save(W.fact_holdings(holdings, t["dim_trade"]), batch, "fact_holdings")
    market = files.read("DailyMarket.txt", S.DAILY_MARKET)
    t["fact_market"] = _save(W.fact_market(market, t["dim_security"], t["dim_company"], t["financial"]), batch, "fact_market")
    # the raw rows that the windows of the next batch look back on
    _save(W.market_tail(market), batch, "raw_daily_market")
    watches = files.read("WatchHistory.txt", S.WATCH_HISTORY)
    t["fact_watches"] = _save(W.fact_watches(watches, t["dim_customer"], t["dim_security"]), batch, "fact_watches")

    # Every alert of the batch plus the validation snapshot (M1, M2), one append
    msgs = batch_alerts(actions, cmp_, trades, t["fact_market"], t["dim_security"], batch_date)
    msgs = msgs.unionByName(validation_snapshot(spark, t, 1, "Historical load"))
    # batch 0: what there was before the first
    msgs = msgs.unionByName(snapshot(spark, sinks.read_batch(spark, out_root, 0), 0)).unionByName(phase_record(spark, 0, "Start"))
    t["rejects"] = _save(files.rejects().withColumn("batch_id", F.lit(batch.batch_id)), batch, "rejects")
    msgs = msgs.unionByName(rejected_rows(t["rejects"], batch.batch_id))
    sinks.append_messages(msgs, os.path.join(out_root, "dimessages"))
    t["dimessages"] = spark.read.parquet(os.path.join(out_root, "dimessages"))
    batch.commit()
    return t


def rejected_rows(rejects: DataFrame, batch_id: int) -> DataFrame:
    """A message for each file of the batch with malformed rows, with their number."""
    n = rejects.where(F.col("batch_id") == batch_id).groupBy("file").agg(F.count("*").alias("n"))
    return n.select(F.lit(batch_id).alias("batch_id"), F.col("file").alias("message_source"), F.lit("Rejected rows").alias("message_text"),
                    F.lit("Reject").alias("message_type"), F.col("n").cast("string").alias("message_data"))


def no_earnings_alerts(market: DataFrame, security: DataFrame, batch_id: int) -> DataFrame:
    """Market rows without a P/E ratio, named by the security's symbol."""
    symbol = security.select(F.col("sk_securityid").alias("__sk"), F.col("symbol").alias("__symbol"))
    rows = market.where(F.col("pe_ratio").isNull()).join(symbol, F.col("sk_securityid") == F.col("__sk"), "left")
    return Q.alerts(rows, F.lit(True), "FactMarketHistory", "No earnings for company",
                    [("DM_S_SYMB", F.col("__symbol")), ("SK_DATEID", F.col("sk_dateid"))], batch_id)


def batch_alerts(actions: DataFrame, cmp_records: DataFrame, trades: DataFrame, market: DataFrame, security: DataFrame,
                 batch_date, batch_id: int = 1) -> DataFrame:
    """Alerts L1-L6 of one batch as message-log rows (rules D4, D5, D7)."""
    c = actions.where(F.col("_ActionType").isin("NEW", "UPDCUST")).select(
        F.col("Customer._C_ID").alias("c_id"), F.col("Customer._C_TIER").alias("tier"),
        F.col("Customer._C_DOB").alias("dob"))
    bd = F.lit(batch_date).cast("date")
    qty_price = F.col("T_TRADE_PRICE") * F.col("T_QTY")
    return Q.union_messages([
        Q.alerts(c, Q.invalid_domain(F.col("tier"), [1, 2, 3]), "DimCustomer", "Invalid customer tier",
                 [("C_ID", F.col("c_id")), ("C_TIER", F.col("tier"))], batch_id),
        Q.alerts(c, Q.dob_out_of_range(F.col("dob"), bd), "DimCustomer", "DOB out of range",
                 [("C_ID", F.col("c_id")), ("C_DOB", F.col("dob"))], batch_id),
        Q.alerts(cmp_records, ~CL.valid_rating(F.col("SPrating")), "DimCompany", "Invalid SPRating",
                 [("CO_ID", F.col("CIK").cast("long")), ("CO_SP_RATE", F.col("SPrating"))], batch_id),
        Q.alerts(trades, F.col("T_COMM") > qty_price, "DimTrade", "Invalid trade commission",
                 [("T_ID", F.col("T_ID")), ("T_COMM", F.col("T_COMM"))], batch_id),
        Q.alerts(trades, F.col("T_CHRG") > qty_price, "DimTrade", "Invalid trade fee",
                 [("T_ID", F.col("T_ID")), ("T_CHRG", F.col("T_CHRG"))], batch_id),
        no_earnings_alerts(market, security, batch_id),
    ])


def change_load(spark: SparkSession, batch_dir: str, out_root: str, batch_id: int) -> dict[str, DataFrame]:
    """Apply one change batch: read the last complete version of
    each table, apply the batch's CDC files, write version ``batch_id``.

    Customer (T8), account with cascade (T11), trade (T13, K5), cash carried
    from the last balance (D8), market with a 364-day look-back (D9),
    watches merged on business keys (K7), prospects (K6) with their load
    counters (T18); alerts and counters written once.  A batch that runs again
    reads the versions below it and replaces its own.
    """
    with temporary_tables(spark):
        return _change_load(spark, batch_dir, out_root, batch_id)


def _change_load(spark: SparkSession, batch_dir: str, out_root: str, batch_id: int) -> dict[str, DataFrame]:
    def path(name):
        return os.path.join(batch_dir, name)

    batch, files = sinks.Batch(spark, out_root, batch_id), R.BatchFiles(spark, batch_dir)
    latest = batch.previous

    batch_date = R.read_batch_date(spark, path("BatchDate.txt"))
    t: dict[str, DataFrame] = {}
    statuses, types, broker = latest("status_type"), latest("trade_type"), latest("dim_broker")

    # the prospects of this file, for the person match and for the merge below
    new_prospects = files.read("Prospect.csv", S.PROSPECT, sep=",")
    cust_rows = files.read("Customer.txt", S.CUSTOMER_CDC)
    prev_customer = latest("dim_customer")
    customer = W.dim_customer_cdc(prev_customer.where("is_current"), cust_rows, batch_date, latest("tax_rate"), latest("prospect"),
                                  W.prospect_rows(new_prospects), batch_id, batch.highest("dim_customer"))
    t["dim_customer"] = _save(customer, batch, "dim_customer")

    acct_rows = files.read("Account.txt", S.ACCOUNT_CDC)
    current_account = latest("dim_account").where("is_current")
    accounts = W.account_changes(current_account, prev_customer.where("is_current"), broker, acct_rows)
    account = W.dim_account_cdc(current_account, accounts, t["dim_customer"].where("is_current"), broker, batch_date, batch_id,
                                batch.highest("dim_account"))
    t["dim_account"] = _save(account, batch, "dim_account")

    # trades: lifecycle by K5, keys of new trades from the current versions
    trade_rows = files.read("Trade.txt", S.TRADE_CDC)
    security = latest("dim_security")
    trade = W.trade_change_batch(latest("dim_trade"), trade_rows, security, t["dim_account"], statuses, types,
                                 batch_id)
    t["dim_trade"] = _save(trade, batch, "dim_trade")

    # cash: continue from the last balance of each account
    cash_rows = files.read("CashTransaction.txt", S.CASH_CDC).drop("CDC_FLAG", "CDC_DSN")
    prev_cash = latest("fact_cash")
    opening = W.opening_balances(prev_cash, t["dim_account"])
    cash = W.fact_cash(cash_rows, t["dim_account"], opening=opening).withColumn("batch_id", F.lit(batch_id))
    t["fact_cash"] = _save(cash, batch, "fact_cash")

    # holdings of the batch, enriched from the new trade version
    hold_rows = files.read("HoldingHistory.txt", S.HOLDING_CDC).drop("CDC_FLAG", "CDC_DSN")
    hold = W.fact_holdings(hold_rows, t["dim_trade"]).withColumn("batch_id", F.lit(batch_id))
    t["fact_holdings"] = _save(hold, batch, "fact_holdings")

    # market: rolling windows look back over earlier raw rows
    mkt_new = files.read("DailyMarket.txt", S.MARKET_CDC).drop("CDC_FLAG", "CDC_DSN")
    prev_raw = latest("raw_daily_market")
    both = W.market_with_lookback(prev_raw, mkt_new)
    mk = W.fact_market(both, security, latest("dim_company"), latest("financial")) \
        .withColumn("batch_id", F.lit(batch_id))
    t["fact_market"] = _save(mk, batch, "fact_market")
    raw = mkt_new if prev_raw is None else prev_raw.unionByName(mkt_new)
    _save(W.market_tail(raw), batch, "raw_daily_market")

    # watches merged on business keys across surrogate versions (K7)
    watch_rows = files.read("WatchHistory.txt", S.WATCH_CDC).drop("CDC_FLAG", "CDC_DSN")
    t["fact_watches"] = _save(W.watch_change_batch(latest("fact_watches"), watch_rows, prev_customer, t["dim_customer"], security, batch_id),
                              batch, "fact_watches")

    # prospects: full file again, merged by agency id (K6); counters
    loaded = W.prospect_load(new_prospects, W.current_active(t["dim_customer"]), batch_date, batch_id)
    prospect, counters = W.prospect_change_batch(latest("prospect"), loaded, batch_date)
    t["prospect"] = _save(prospect, batch, "prospect")

    alerts = batch_alerts_cdc(cust_rows, trade_rows, batch_date, batch_id).unionByName(
        no_earnings_alerts(t["fact_market"].where(F.col("batch_id") == batch_id), security, batch_id))
    msgs = alerts.unionByName(
        counters.select(F.lit(batch_id).alias("batch_id"), F.lit("Prospect").alias("message_source"),
                        F.col("counter").alias("message_text"), F.lit("Status").alias("message_type"),
                        F.col("value").cast("string").alias("message_data")))
    for name in ("dim_date", "dim_time", "industry", "status_type", "trade_type", "tax_rate", "dim_broker", "dim_company",
                 "financial", "dim_security"):
        t.setdefault(name, latest(name))  # unchanged by a change batch
    msgs = msgs.unionByName(validation_snapshot(spark, t, batch_id, f"Incremental load {batch_id}"))
    t["rejects"] = _save(files.rejects().withColumn("batch_id", F.lit(batch.batch_id)), batch, "rejects")
    msgs = msgs.unionByName(rejected_rows(t["rejects"], batch.batch_id))
    sinks.append_messages(msgs, os.path.join(out_root, "dimessages"))
    t["dimessages"] = spark.read.parquet(os.path.join(out_root, "dimessages"))
    batch.commit()
    return t


def batch_alerts_cdc(cust_rows: DataFrame, trade_rows: DataFrame, batch_date, batch_id: int) -> DataFrame:
    """Alerts of a change batch from its CDC rows."""
    bd = F.lit(batch_date).cast("date")
    qty_price = F.col("T_TRADE_PRICE") * F.col("T_QTY")
    return Q.union_messages([
        Q.alerts(cust_rows, Q.invalid_domain(F.col("C_TIER"), [1, 2, 3]), "DimCustomer", "Invalid customer tier",
                 [("C_ID", F.col("C_ID")), ("C_TIER", F.col("C_TIER"))], batch_id),
        Q.alerts(cust_rows, Q.dob_out_of_range(F.col("C_DOB"), bd), "DimCustomer", "DOB out of range",
                 [("C_ID", F.col("C_ID")), ("C_DOB", F.col("C_DOB"))], batch_id),
        Q.alerts(trade_rows, F.col("T_COMM") > qty_price, "DimTrade", "Invalid trade commission",
                 [("T_ID", F.col("T_ID")), ("T_COMM", F.col("T_COMM"))], batch_id),
        Q.alerts(trade_rows, F.col("T_CHRG") > qty_price, "DimTrade", "Invalid trade fee",
                 [("T_ID", F.col("T_ID")), ("T_CHRG", F.col("T_CHRG"))], batch_id),
    ])
