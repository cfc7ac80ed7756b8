"""Change batch 2 applied to a loaded batch 1, and rule D9."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import rows
from histmart.operators import facts as FX
from histmart.plans import adapter as A
from histmart.plans import audit as AU
from histmart.plans import q_warehouse as QW
from histmart.plans import visibility as VI
from histmart.plans import warehouse as W
from histmart.plans.pipeline import change_load, historical_load
from histmart.sources import readers as R
from histmart.sources import sinks
from rawbatch import csv, write_batch1

SF = "/root/testdata/sf0.001"
CASH_SPLIT = "2024-01-16"
#: tables compared before and after a failed load
SEEN = ("dim_customer", "dim_account", "dim_trade", "fact_cash", "fact_holdings", "fact_market", "fact_watches", "prospect")
#: where the batches of ``loaded`` lie, and what was counted beside the load
PLACE = {}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    root = tmp_path_factory.mktemp("cdc")
    b1, b2, wh = str(root / "Batch1"), str(root / "Batch2"), str(root / "warehouse")
    write_batch1(spark, SF, b1, before=QW.B2_LO, cash_before=CASH_SPLIT)
    v1 = historical_load(spark, b1, wh, action_tag="raw:Action")
    os.makedirs(b2)
    actions = R.parse_actions(A.action_xml(spark, SF), "value", "seq")
    A.customer_cdc_text(W.customer_states(actions), QW.B2_LO, QW.B2_HI).coalesce(1).write.text(
        os.path.join(b2, "Customer.txt"))
    A.account_cdc_text(W.account_states(actions), QW.B2_LO, QW.B2_HI).coalesce(1).write.text(os.path.join(b2, "Account.txt"))
    hist = A.trade_history(spark, SF)
    ev = hist.where((F.col("TH_DTS") >= F.lit(QW.B2_LO).cast("timestamp_ntz"))
                    & (F.col("TH_DTS") < F.lit(QW.B2_HI).cast("timestamp_ntz")))
    tr = A.trade_records(spark, SF).drop("T_DTS", "T_ST_ID")
    rows_ = ev.join(tr, ev.TH_T_ID == tr.T_ID).select(
        F.when(F.col("TH_ST_ID").isin("PNDG", "SBMT"), F.lit("I")).otherwise(F.lit("U")),
        A._dsn(F.col("TH_DTS"), F.col("T_ID")), "T_ID", F.col("TH_DTS"), F.col("TH_ST_ID"), "T_TT_ID", "T_IS_CASH",
        "T_S_SYMB", "T_QTY", "T_BID_PRICE", "T_CA_ID", "T_EXEC_NAME", "T_TRADE_PRICE", "T_CHRG", "T_COMM", "T_TAX")
    csv(rows_, os.path.join(b2, "Trade.txt"))
    cash = A.cash_records(spark, SF).where(F.col("CT_DTS") >= F.lit(CASH_SPLIT).cast("timestamp_ntz"))
    csv(cash.select(F.lit("I"), F.lit(0).cast("long"), "*"), os.path.join(b2, "CashTransaction.txt"))
    csv(A.prospect_records(spark, SF, 2), os.path.join(b2, "Prospect.csv"), sep=",")
    def change(df):
        return df.select(F.lit("I"), F.lit(0).cast("long"), "*")

    created = tr.join(hist.where(F.col("TH_ST_ID").isin("PNDG", "SBMT") & (F.col("TH_DTS") >= F.lit(QW.B2_LO).cast("timestamp_ntz"))), F.col("T_ID") == F.col("TH_T_ID"))
    held = A.holding_records(spark, SF)
    csv(change(held.join(created.select(F.col("T_ID").alias("HH_T_ID")), "HH_T_ID", "left_semi").select(*held.columns)), os.path.join(b2, "HoldingHistory.txt"))
    csv(change(A.market_records(spark, SF).where(F.col("DM_DATE") >= F.lit(QW.B2_LO).cast("date"))), os.path.join(b2, "DailyMarket.txt"))
    csv(change(A.watch_records(spark, SF).where(F.col("W_DTS") >= F.lit(CASH_SPLIT).cast("timestamp_ntz"))), os.path.join(b2, "WatchHistory.txt"))
    with open(os.path.join(b2, "BatchDate.txt"), "w") as fh:
        fh.write(QW.B2_DATE + "\n")
    before = {n: rows(t) for n, t in sinks.read_batch(spark, wh).items() if n in SEEN}
    # the load dies between two tables, after most of them have been written
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(W, "watch_change_batch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            change_load(spark, b2, wh, 2)
    seen = {n: rows(t) for n, t in sinks.read_batch(spark, wh).items() if n in SEEN}
    assert sinks.committed_batches(spark, wh) == [1] and seen == before
    # the tables are counted again and again while batch 2 is loaded
    stop, seen = threading.Event(), []
    beside = threading.Thread(target=lambda: seen.extend(VI.watch(spark, wh, lambda: stop.wait(2), AU.LIGHT)))
    beside.start()
    try:
        v2 = change_load(spark, b2, wh, 2)
    finally:
        stop.set()
        beside.join(300)
    VI.record_snapshot(spark, wh, AU.FULL)
    PLACE.update(raw=root, warehouse=wh, seen=seen)
    once = {n: rows(t) for n, t in v2.items() if n in SEEN}
    v2 = change_load(spark, b2, wh, 2)  # and once more: the same tables
    assert {n: rows(t) for n, t in v2.items() if n in SEEN} == once
    assert {n: rows(t, *v2[n].columns) for n, t in sinks.read_batch(spark, wh).items() if n in SEEN} == once
    assert {n: rows(t) for n, t in sinks.read_batch(spark, wh, 1).items() if n in SEEN} == before
    return v1, v2


def test_customer_and_account_batch2_equal_queries(spark, loaded):
    _, v2 = loaded
    q = QW.q_dim_customer_cdc(spark, SF)
    assert rows(v2["dim_customer"], *q.columns) == rows(q, *q.columns)
    q = QW.q_dim_account_cdc(spark, SF)
    assert rows(v2["dim_account"], *q.columns) == rows(q, *q.columns)


def test_trade_lifecycle_after_batch2(spark, loaded):
    _, v2 = loaded
    q = QW.q_dim_trade_cdc(spark, SF)
    cols = ["trade_id", "status", "sk_createdateid", "sk_createtimeid", "sk_closedateid", "sk_closetimeid"]
    got = v2["dim_trade"].select(*cols)
    assert rows(got, *cols) == rows(q.join(got.select("trade_id"), "trade_id"), *cols)
    created2 = q.where(F.col("batch_id") == 2).select("trade_id")
    assert created2.count() > 0 and created2.join(got, "trade_id", "left_anti").count() == 0


def test_cash_balance_continues_across_batches(spark, loaded):
    # The last balance of each account covers the amounts of both batches
    _, v2 = loaded
    acc = v2["dim_account"].select("sk_accountid", "account_id")
    last = (v2["fact_cash"].join(acc, "sk_accountid").groupBy("account_id")
            .agg(F.max_by("cash", "sk_dateid").alias("cash")))
    amounts = A.cash_records(spark, SF).groupBy(F.col("CT_CA_ID").alias("account_id")).agg(
        F.sum("CT_AMT").cast("decimal(38,2)").alias("cash"))
    assert rows(last) == rows(last.select("account_id").join(amounts, "account_id"), *last.columns)
    assert v2["fact_cash"].where("batch_id = 2").count() > 0


def test_market_lookback_sees_earlier_batch(spark):
    # A high 100 days before the batch still counts in the batch's windows
    D = dt.date
    prev = spark.createDataFrame([(D(2020, 9, 23), "S", 9.0, 90.0, 1.0, 5)],
                                 "DM_DATE date, DM_S_SYMB string, DM_CLOSE double, DM_HIGH double, DM_LOW double, DM_VOL long")
    new = spark.createDataFrame([(D(2021, 1, 1), "S", 5.0, 10.0, 2.0, 7)], prev.schema)
    both = W.market_with_lookback(prev, new)
    r = FX.rolling_extremes(both, "DM_S_SYMB", "DM_DATE", "DM_HIGH", "DM_LOW").where("__new").first()
    assert (r.high_365, r.high_365_date, r.low_365) == (90.0, D(2020, 9, 23), 1.0)


def test_market_and_watches_over_two_batches_equal_one_load(spark, loaded):
    # windows look back over the batch border; a watch placed in one batch is cancelled in the next
    _, v2 = loaded
    q = QW.q_fact_market(spark, SF)
    cols = [c for c in q.columns if c != "batch_id"]
    assert rows(v2["fact_market"], *cols) == rows(q, *cols)
    assert {r[0] for r in v2["fact_market"].select("batch_id").distinct().collect()} == {1, 2}
    customer, security = v2["dim_customer"], v2["dim_security"]
    named = (v2["fact_watches"].join(customer.select("sk_customerid", "customer_id"), "sk_customerid")
             .join(security.select("sk_securityid", "symbol"), "sk_securityid"))
    w = A.watch_records(spark, SF).groupBy("W_C_ID", "W_S_SYMB").agg(
        F.min(F.when(F.col("W_ACTION") == "ACTV", W.date_key(F.col("W_DTS")))).alias("sk_dateid_dateplaced"),
        F.max(F.when(F.col("W_ACTION") == "CNCL", W.date_key(F.col("W_DTS")))).alias("sk_dateid_dateremoved"))
    both = named.join(w.withColumnsRenamed({"W_C_ID": "customer_id", "W_S_SYMB": "symbol", "sk_dateid_dateplaced": "p", "sk_dateid_dateremoved": "r"}), ["customer_id", "symbol"])
    assert both.count() == named.count() > 0
    assert both.where("sk_dateid_dateplaced <> p").count() == 0
    # (a cancel that came before its placement, in the batch before, has no watch to end)
    assert both.where("not sk_dateid_dateremoved <=> r and not r < p").count() == 0
    held = v2["fact_holdings"]
    assert held.where("batch_id = 2").count() > 0 and held.count() == A.holding_records(spark, SF).join(
        v2["dim_trade"].select("trade_id"), F.col("HH_T_ID") == F.col("trade_id"), "left_semi").count()


def test_a_batch_writes_only_its_own_part(spark, loaded):
    # closed versions and earlier facts aren't written again
    v1, v2 = loaded
    for name, sk in (("dim_customer", "sk_customerid"), ("dim_account", "sk_accountid")):
        files = {f.rsplit("/warehouse/", 1)[1].split("/")[1] for f in v2[name].where("not is_current").inputFiles()}
        assert files == {"v=1", "v=2"}
        root = v2[name].inputFiles()[0].rsplit(f"/{name}/", 1)[0]
        own = spark.read.parquet(f"{root}/{name}/v=2/is_current=false")
        assert own.where(F.col("end_date") != F.lit(QW.B2_DATE).cast("date")).count() == 0
        assert own.join(v1[name].where("is_current").select(sk), sk, "left_anti").count() == 0
        assert v2[name].count() == v2[name].select(sk).distinct().count() == v2[name].agg(F.max(sk)).first()[0]


def test_account_rows_of_untouched_customers(spark, loaded):
    _, v2 = loaded
    new = v2["dim_account"].where("batch_id = 2 and is_current")
    old_customer = v2["dim_customer"].where("is_current and batch_id = 1").select("sk_customerid")
    own = new.join(old_customer, "sk_customerid")
    assert own.where("status = 'INACTIVE'").count() > 0 and own.where("account_desc like 'Renamed%'").count() > 0


def test_prospect_dates_and_counters(spark, loaded):
    # Record date moves for every row of the file, update date only on change
    _, v2 = loaded
    p = v2["prospect"].withColumn("k", F.regexp_extract("agency_id", r"P(\d+)", 1).cast("long"))
    got = {r.k: (r.sk_recorddateid, r.sk_updatedateid) for r in p.collect()}
    new_day, old_day = int(QW.B2_DATE.replace("-", "")), int(QW.B2_LO.replace("-", ""))
    for k, dates in got.items():
        changed = k % 5 == 0 or k % 14 == 0 or k % 22 == 0 or k % 8 == 3
        assert dates == ((old_day, old_day) if k % 4 == 1 else (new_day, new_day if changed else old_day)), k
    counters = {r.message_text: int(r.message_data) for r in v2["dimessages"].where(
        (F.col("batch_id") == 2) & (F.col("message_source") == "Prospect")).collect()}
    assert counters == {"Source rows": sum(k % 4 != 1 for k in got), "Inserted rows": sum(k % 8 == 3 for k in got),
                        "Updated rows": sum(k % 4 != 1 and k % 8 != 3 and (k % 5 == 0 or k % 14 == 0 or k % 22 == 0) for k in got)}


def test_audit_after_batch2(spark, loaded):
    from histmart.plans.audit import audit_warehouse

    _, v2 = loaded
    res = {(r.test, r.batch_id): r.result for r in audit_warehouse(v2).collect()}
    bad = sorted({k[0] for k, v in res.items() if v != "OK"})
    # The fixture's time model makes these findings true, and the audit must report them:
    # tiers outside 1..3 by design; batch-1 cash and watch facts come from 2024 events, after the batch-2 versions start (2001); new batch-2
    # trades take the current account version (J7), which starts on the batch date.
    assert set(bad) == {
        "dim_customer domain: Customer tier",
        "dim_trade.sk_createdateid inside dim_account version",
        "fact_cash.sk_dateid inside dim_account version",
        "fact_watches.sk_dateid_dateplaced inside dim_customer version"}, bad


def test_snapshots_beside_the_load_show_a_committed_batch(spark, loaded):
    wh = PLACE["warehouse"]
    assert PLACE["seen"] and PLACE["seen"] == sorted(PLACE["seen"]) and PLACE["seen"][0] == 1
    counted = VI.read_log(spark, wh)
    want = {b: {n: str(t.count()) for n, t in sinks.read_batch(spark, wh, b).items() if n in AU.SNAPSHOT_TABLES} for b in (1, 2)}
    shots = {}
    for r in counted.where("message_text = 'Row count'").collect():
        shots.setdefault((r.snapshot_ts, r.batch_id), {})[r.message_source] = r.message_data
    assert len(shots) == len(PLACE["seen"]) + 1 and {b for _, b in shots} == {1, 2}
    assert all(shot == want[b] for (_, b), shot in shots.items())
    assert counted.where(F.col("message_type") == AU.FULL).count() == 22


def test_counts_against_audit_files_of_the_batches(spark, loaded, tmp_path):
    # expected values counted from the raw files, some of them left out
    _, v2 = loaded

    def lines(batch, name, keep=lambda f: True, sep="|"):
        folder = os.path.join(str(PLACE["raw"]), f"Batch{batch}", name)
        parts = [os.path.join(folder, p) for p in os.listdir(folder) if p.startswith("part-")] if os.path.isdir(folder) else [folder]
        return sum(keep(line.rstrip("\n").split(sep)) for p in parts for line in open(p))

    values = {("DimBroker", 1, "HR_BROKERS"): lines(1, "HR.csv", lambda f: f[5] == "314", ","),
              ("FactMarketHistory", 1, "DM_RECORDS"): lines(1, "DailyMarket.txt"),
              ("FactMarketHistory", 2, "DM_RECORDS"): lines(2, "DailyMarket.txt"),
              ("DimTrade", 1, "T_NEW"): lines(1, "Trade.txt"), ("DimTrade", 2, "T_NEW"): lines(2, "Trade.txt", lambda f: f[0] == "I"),
              ("FactHoldings", 1, "HH_RECORDS"): lines(1, "HoldingHistory.txt"),
              ("FactHoldings", 2, "HH_RECORDS"): lines(2, "HoldingHistory.txt") + 1}  # one too many
    path = os.path.join(str(tmp_path), "Batch_audit.csv")
    with open(path, "w") as fh:
        fh.write("DataSet, BatchID, Date, Attribute, Value, DValue\n")
        fh.writelines(f"{ds}, {b}, , {attr}, {v},\n" for (ds, b, attr), v in values.items())
    res = {(r.test, r.batch_id): r.result for r in AU.audit_expected(v2, R.read_audit(spark, path), 2).collect()}
    for test in [("DimBroker row count", None), ("FactMarketHistory row count", 1), ("FactMarketHistory row count", 2), ("DimTrade row count", 1),
                 ("DimTrade row count", 2), ("FactHoldings row count", 1), ("Audit table batches", None), ("Validation reports", 0),
                 ("Validation reports", 1), ("Validation reports", 2), ("Message batches", None), ("Phase records", None), ("Message sources", None),
                 ("Initial condition", None)]:
        assert res[test] == "OK", test
    assert res["FactHoldings row count", 2] == res["Audit table sources", None] == res["Financial row count", None] == "Not OK"


def test_whole_audit_after_batch2(spark, loaded):
    _, v2 = loaded
    audit = spark.sql("""SELECT * FROM VALUES ('Batch', 1, DATE'1990-01-01', 'FirstDay', 0L), ('Batch', 1, DATE'2025-12-31', 'LastDay', 0L),
        ('Batch', 2, DATE'1990-01-01', 'FirstDay', 0L), ('Batch', 2, DATE'2025-12-31', 'LastDay', 0L) AS a(DataSet, BatchID, Date, Attribute, Value)""")
    res = {(r.test, r.batch_id): r.result for r in AU.audit_all(v2, audit, 2, VI.read_log(spark, PLACE["warehouse"])).collect()}
    bad = {k[0] for k, v in res.items() if v != "OK"} - {test for test, *_ in AU.EXPECTED}
    # What the fixture makes true, and the audit must report (with test_audit_after_batch2's):
    assert bad == {
        "dim_customer domain: Customer tier", "dim_trade.sk_createdateid inside dim_account version",
        "fact_cash.sk_dateid inside dim_account version", "fact_watches.sk_dateid_dateplaced inside dim_customer version",
        "Audit table sources",  # only the days of the batches are given here
        # brokers that aren't in HR.csv, holdings of open trades: rows that don't meet every dimension
        "Batch joined row count: fact_cash", "Batch joined row count: fact_holdings",
        "Data visibility joined row counts: fact_cash", "Data visibility joined row counts: fact_holdings",
        "dim_account inactive customers",  # an account's own row of the batch wins over its customer's status (T11)
        "prospect MarketingNameplate",  # the tags need every input (F4), the audit takes a missing one as harmless
        "fact_watches dates in batch",  # a cancel that came before its placement, in the batch before
        # texts of other shapes than the audit's
        "dim_company Country", "prospect Country", "dim_trade Type", "dim_customer TaxID", "dim_customer Email1", "dim_customer Email2",
        "dim_customer Phone1", "dim_customer Phone2", "dim_customer Phone3"}
    assert {"dim_company SPrating", "financial EPS", "dim_company distinct names", "Data visibility row counts: dim_trade"} <= {k[0] for k in res}
