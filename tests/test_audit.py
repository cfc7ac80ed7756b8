"""Counts against the audit files, references in one pass, rules of a table,
and snapshots beside a load, on small hand-made tables."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import rows
from histmart.operators import checks as CK
from histmart.plans import audit as AU
from histmart.plans import visibility as VI
from histmart.sources import readers as R
from histmart.sources import sinks


def _ints(spark, name, values):
    return spark.createDataFrame([(v,) for v in values], f"{name} long")


def _report(tables, edges):
    return {(r.child, r.column, r.parent): (r.refs, r.orphans) for r in CK.reference_report(tables, edges).collect()}


def test_references_equal_joins_edge_by_edge(spark):
    t = {"p": _ints(spark, "pk", [1, 2, 2, 3, None]), "q": _ints(spark, "qk", [2, 9]),
         "c": spark.createDataFrame([(1, 9), (2, 2), (7, None), (None, 1), (7, 9)], "a long, b int"),
         "d": _ints(spark, "x", [1] * 500 + [8] * 3)}
    edges = (("c", "a", "p", "pk"), ("c", "b", "p", "pk"), ("c", "b", "q", "qk"), ("d", "x", "p", "pk"), ("q", "qk", "p", "pk"))
    got = _report(t, edges)
    want = {}
    for child, col, parent, key in edges:
        refs = [r[0] for r in t[child].select(col).collect() if r[0] is not None]
        known = {r[0] for r in t[parent].select(key).collect()}
        want[child, col, parent] = len(refs), sum(r not in known for r in refs)
    assert got == want and got["d", "x", "p"] == (503, 3)


def test_references_of_empty_tables_and_one_shuffle(spark):
    t = {"p": _ints(spark, "k", []), "c": _ints(spark, "k", []), "d": _ints(spark, "k", [5])}
    edges = (("c", "k", "p", "k"), ("d", "k", "p", "k"), ("d", "k", "c", "k"))
    assert _report(t, edges) == {("c", "k", "p"): (0, 0), ("d", "k", "p"): (1, 1), ("d", "k", "c"): (1, 1)}
    plan = CK.reference_report(t, edges)._jdf.queryExecution().executedPlan().toString()
    # the grouped count, and the sums of it by key space
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


# --- audit files -------------------------------------------------------------------------

HEADER = "DataSet, BatchID , Date, Attribute , Value, DValue\n"
#: values of the audit files by batch, for the tables of ``_warehouse``
VALUES = {1: {("DimBroker", "HR_BROKERS"): 2, ("DimAccount", "CA_ADDACCT"): 0, ("DimAccount", "CA_CLOSEACCT"): 0,
              ("DimAccount", "CA_UPDACCT"): 1, ("DimAccount", "CA_ID_HIST"): 0, ("DimCustomer", "C_NEW"): 2,
              ("DimCustomer", "C_UPDCUST"): 0, ("DimCustomer", "C_INACT"): 1, ("DimCustomer", "C_ID_HIST"): 1,
              ("DimCustomer", "C_DOB_TO"): 1, ("DimCustomer", "C_DOB_TY"): 1, ("DimCustomer", "C_TIER_INV"): 0,
              ("DimSecurity", "FW_SEC"): 3, ("DimCompany", "FW_CMP"): 5, ("FactWatches", "WH_ACTIVE"): 4,
              ("FactWatches", "WH_RECORDS"): 5, ("DimTrade", "T_NEW"): 2, ("DimTrade", "T_CanceledTrades"): 1,
              ("DimTrade", "T_InvalidCommision"): 1, ("DimTrade", "T_InvalidCharge"): 0, ("Financial", "FW_FIN"): 6,
              ("FactMarketHistory", "DM_RECORDS"): 10, ("FactHoldings", "HH_RECORDS"): 7},
          2: {("DimAccount", "CA_ADDACCT"): 1, ("DimAccount", "CA_CLOSEACCT"): 0, ("DimAccount", "CA_UPDACCT"): 0,
              ("DimAccount", "CA_ID_HIST"): 0, ("DimCustomer", "C_NEW"): 1, ("DimCustomer", "C_UPDCUST"): 0,
              ("DimCustomer", "C_INACT"): 0, ("DimCustomer", "C_ID_HIST"): 0, ("DimCustomer", "C_DOB_TO"): 0,
              ("DimCustomer", "C_DOB_TY"): 0, ("DimCustomer", "C_TIER_INV"): 1, ("DimCompany", "FW_CMP"): 0,
              ("FactWatches", "WH_ACTIVE"): 1, ("FactWatches", "WH_RECORDS"): 1, ("DimTrade", "T_NEW"): 1,
              ("DimTrade", "T_CanceledTrades"): 0, ("DimTrade", "T_InvalidCommision"): 0, ("DimTrade", "T_InvalidCharge"): 1,
              ("FactMarketHistory", "DM_RECORDS"): 2, ("FactHoldings", "HH_RECORDS"): 0}}


def _audit_files(folder, values):
    for batch, counts in values.items():
        with open(os.path.join(folder, f"Batch{batch}_audit.csv"), "w") as fh:
            fh.write(HEADER)
            fh.write(f"Batch, {batch}, 2000-01-0{batch}, FirstDay, ,\n")
            for (ds, attr), v in counts.items():
                fh.write(f"{ds}, {batch}, , {attr}, {v},\n")
    with open(os.path.join(folder, "Generator_audit.csv"), "w") as fh:
        fh.write(HEADER + "Generator, , , SEED, 7,\nProspect, 1, , PS_ROWS, 1,\n")


def _warehouse(spark):
    def batched(ids):
        return spark.createDataFrame(ids, "batch_id int, status string")

    counts = {("dim_customer", "Inactive customers"): (0, 1, 1), ("dim_security", "Row count"): (0, 3, 3),
              ("dim_company", "Row count"): (0, 5, 5), ("fact_watches", "Row count"): (0, 4, 5),
              ("fact_watches", "Inactive watches"): (0, 1, 1), ("dim_trade", "Row count"): (0, 2, 3),
              ("financial", "Row count"): (0, 6, 6), ("fact_market", "Row count"): (0, 10, 12), ("fact_holdings", "Row count"): (0, 7, 7)}
    texts = [(n, "Row count") for n in AU.SNAPSHOT_TABLES] + [(n, "Row count joined") for n in AU.SNAPSHOT_JOINS]
    texts += [("dim_customer", "Inactive customers"), ("fact_watches", "Inactive watches")]
    log = [(b, s, t, "Validation", str(counts.get((s, t), (0, 1, 1))[b])) for s, t in texts for b in (0, 1, 2)]
    log += [(b, "Phase", "complete", "PCR", None) for b in (0, 1, 2)]
    log += [(1, "DimCustomer", "DOB out of range", "Alert", "C_ID = 1"), (1, "DimCustomer", "DOB out of range", "Alert", "C_ID = 2"),
            (2, "DimCustomer", "Invalid customer tier", "Alert", "C_ID = 3"), (1, "DimTrade", "Invalid trade commission", "Alert", "T_ID = 1"),
            (2, "DimTrade", "Invalid trade fee", "Alert", "T_ID = 2")]
    return {"dim_broker": batched([(1, None)] * 2), "dim_account": batched([(1, None)] * 4 + [(2, None)]),
            "dim_customer": batched([(1, None)] * 2 + [(2, None)]), "dim_trade": batched([(1, "Canceled"), (1, "Completed"), (2, None)]),
            "dimessages": spark.createDataFrame(log, "batch_id int, message_source string, message_text string, message_type string, message_data string")}


def _results(spark, folder, t, values, batches=2):
    _audit_files(folder, values)
    audit = R.read_audit(spark, os.path.join(folder, "*_audit.csv"))
    return {(r.test, r.batch_id): r.result for r in AU.audit_expected(t, audit, batches).collect()}


def test_counts_that_match_the_audit_files(spark, tmp_path):
    res = _results(spark, str(tmp_path), _warehouse(spark), VALUES)
    assert {k for k, v in res.items() if v != "OK"} == set()
    # the files (2), the log (3 batches' reports, 4 more), counts of one batch (3), of all (5), and of each of two batches (10)
    assert len(res) == 2 + 3 + 4 + 3 + 5 + 2 * 10, sorted(res, key=str)


def test_each_count_is_found_wrong_by_itself(spark, tmp_path):
    # a value that is off by ten makes the tests that read it fail, in the batches they read it for
    t = _warehouse(spark)
    off = {b: {k: v + (10 if k in (("FactHoldings", "HH_RECORDS"), ("DimTrade", "T_NEW"), ("DimBroker", "HR_BROKERS")) and b == 1 else 0)
               for k, v in c.items()} for b, c in VALUES.items()}
    off[2]["DimAccount", "CA_UPDACCT"] = 10
    res = _results(spark, str(tmp_path), t, off)
    assert {k for k, v in res.items() if v != "OK"} == {
        ("DimBroker row count", None), ("FactHoldings row count", 1), ("DimTrade row count", 1), ("DimTrade row count", 2),
        ("DimAccount row count", 2)}


def test_missing_values_messages_and_batches_are_not_ok(spark, tmp_path):
    t = _warehouse(spark)
    part = {b: {k: v for k, v in c.items() if k != ("DimCustomer", "C_DOB_TY")} for b, c in VALUES.items()}
    t["dimessages"] = t["dimessages"].where("not (batch_id = 1 and message_source = 'fact_market')") \
        .where("not (batch_id = 0 and message_type = 'PCR')")
    res = _results(spark, str(tmp_path), t, part, batches=3)
    bad = {k for k, v in res.items() if v != "OK"}
    assert bad == {("Audit table batches", None), ("Message batches", None), ("Phase records", None), ("Validation reports", 1),
                   ("DimCustomer age range alerts", 1), ("DimCustomer age range alerts", 2), ("FactMarketHistory row count", 1)} | (
        {("FactMarketHistory row count", 2)})


def test_no_audit_files_rows(spark):
    audit = spark.createDataFrame([], "DataSet string, BatchID int, Date date, Attribute string, Value long, DValue decimal(16,5)")
    res = {(r.test, r.batch_id): r.result for r in AU.audit_expected(_warehouse(spark), audit, 2).collect()}
    assert res["Audit table batches", None] == res["Audit table sources", None] == "Not OK" and len(res) == 9


# --- rules of a table (K10) ---------------------------------------------------------------

def _save(spark, root, batch_id, values, rules=("n > 0", "n < 100")):
    b = sinks.Batch(spark, root, batch_id)
    b.save("t", spark.createDataFrame([(v,) for v in values], "n int"), rules=rules)
    b.commit()


def test_a_broken_rule_leaves_the_last_batch_in_force(spark, tmp_path):
    root = str(tmp_path)
    _save(spark, root, 1, [1, None, 99])
    with pytest.raises(sinks.CheckFailed, match=r"t, batch 2: .*\(?n > 0\)?.*2"):
        _save(spark, root, 2, [5, 0, -1, None])
    assert sinks.committed_batches(spark, root) == [1]
    assert rows(sinks.read_batch(spark, root)["t"]) == [(None,), (1,), (99,)]
    _save(spark, root, 2, [5])
    assert rows(sinks.read_batch(spark, root)["t"]) == [(5,)]
    _save(spark, root, 3, [])  # no row breaks no rule
    assert sinks.read_batch(spark, root)["t"].count() == 0


# --- snapshots (R2, M1, M3, M4) ------------------------------------------------------------

def test_kinds_of_snapshots_have_their_rows(spark):
    n = {k: AU.snapshot(spark, {}, 0, k) for k in (AU.VALIDATION, AU.FULL, AU.LIGHT)}
    assert {k: df.count() for k, df in n.items()} == {AU.VALIDATION: 24, AU.FULL: 22, AU.LIGHT: 18}
    assert {r.message_data for r in n[AU.VALIDATION].collect()} == {"0"}


def test_joined_count_asks_for_every_dimension(spark):
    def frame(schema, *r):
        return spark.createDataFrame(list(r), schema)

    t = {"dim_customer": frame("sk_customerid long, is_current boolean, status string", (1, True, "Inactive"), (2, False, "INACTIVE")),
         "dim_date": frame("SK_DateID int", (20200101,)), "dim_security": frame("sk_securityid long", (5,)),
         "fact_watches": frame("sk_customerid long, sk_securityid long, sk_dateid_dateplaced int, sk_dateid_dateremoved int",
                               (1, 5, 20200101, None), (1, 6, 20200101, 20200101), (3, 5, 20200101, None), (1, 5, 20200102, None), (2, 5, 20200101, 1))}
    got = {(r.message_source, r.message_text): int(r.message_data) for r in AU.snapshot(spark, t, 4).collect()}
    assert got["fact_watches", "Row count"] == 5 and got["fact_watches", "Row count joined"] == 2
    assert got["fact_watches", "Inactive watches"] == 2 and got["dim_customer", "Inactive customers"] == 1
    assert got["fact_cash", "Row count joined"] == got["dim_trade", "Row count"] == 0


def test_snapshots_beside_a_load_show_one_state_each(spark, tmp_path):
    root, names = str(tmp_path), ("industry", "status_type", "tax_rate")
    stop, seen, failed = threading.Event(), [], []

    def watcher():
        try:
            seen.extend(VI.watch(spark, root, lambda: stop.wait(0.05), AU.LIGHT))
        except Exception as e:  # shown by the assertion below
            failed.append(e)

    w = threading.Thread(target=watcher)
    w.start()
    for batch_id in (1, 2, 3):  # a table has as many rows as the number of its batch
        batch = sinks.Batch(spark, root, batch_id)
        for name in names:
            batch.save(name, spark.range(batch_id))
        batch.commit()
    stop.set()
    w.join(120)
    VI.record_snapshot(spark, root, AU.LIGHT)
    assert not failed and seen == sorted(seen)
    log = VI.read_log(spark, root).where(F.col("message_source").isin(*names))
    by = log.groupBy("snapshot_ts").agg(F.collect_set("message_data").alias("n"), F.collect_set("batch_id").alias("b"), F.count("*").alias("rows")).collect()
    assert len(by) == len(seen) + 1 and all(r.n == [str(r.b[0])] and r.rows == 3 for r in by)
    assert max(r.b[0] for r in by) == 3


# --- values, windows and trends (Q5, Q7, Q8, Q10, Q12, Q13) --------------------------------

#: table -> columns and a row that keeps every rule
GOOD = {
    "dim_account": {"sk_customerid": "1L", "is_current": "true", "status": "'Active'", "batch_id": "1", "tax_status": "2"},
    "dim_customer": {"sk_customerid": "1L", "is_current": "true", "status": "'ACTIVE'", "gender": "'U'", "tax_id": "'123-45-6789'",
                     "phone1": "'+1 (123) 456-7890x1'", "phone2": "'(123) 456-7890'", "phone3": "''", "email1": "'a.b@c.d'", "email2": "''"},
    "dim_security": {"status": "'Inactive'", "exchange_id": "'PCX'", "issue": "'PREF_B'"},
    "dim_company": {"name": "'N'", "company_id": "1L", "industry": "'Mining'", "status": "'Active'", "country": "''", "sp_rating": "'BB+'"},
    "dim_trade": {"status": "'Completed'", "type": "'Limit Buy'"},
    "financial": {"fi_year": "2001", "fi_qtr": "2", "fi_qtr_start_date": "DATE'2001-04-01'", "fi_net_earn": "10.0BD", "fi_out_basic": "10L",
                  "fi_basic_eps": "1.30BD", "fi_out_dilut": "20L", "fi_dilut_eps": "0.5BD", "fi_revenue": "0.0BD", "fi_margin": "0.1BD"},
    "prospect": {"country": "'Canada'", "sk_recorddateid": "20010102", "sk_updatedateid": "20010101", "marketing_nameplate": "'HighValue+Boomer'",
                 "net_worth": "2000000L", "income": "null", "number_children": "1", "number_credit_cards": "2", "age": "50",
                 "credit_rating": "700", "number_cars": "1"},
}
#: table -> test -> what a row that breaks it alone holds
BAD = {
    "dim_account": {"Status": {"status": "'Gone'"}, "TaxStatus": {"tax_status": "3"}},
    "dim_customer": {"Status": {"status": "'x'"}, "Gender": {"gender": "'m'"}, "TaxID": {"tax_id": "'12-345-6789'"}, "Phone1": {"phone1": "'12'"},
                     "Phone2": {"phone2": "'x'"}, "Phone3": {"phone3": "' '"}, "Email1": {"email1": "''"}, "Email2": {"email2": "'a@b'"}},
    "dim_security": {"Status": {"status": "'x'"}, "ExchangeID": {"exchange_id": "'LSE'"}, "Issue": {"issue": "'PREF_E'"}},
    "dim_company": {"Status": {"status": "'x'"}, "Country": {"country": "'USA'"}, "SPrating": {"sp_rating": "'AAA+'"}},
    "dim_trade": {"Status": {"status": "'x'"}, "Type": {"type": "'x'"}},
    "financial": {"FI_QTR": {"fi_qtr": "5", "fi_qtr_start_date": "null"}, "FI_QTR_START_DATE": {"fi_qtr_start_date": "DATE'2001-04-02'"},
                  "EPS": {"fi_basic_eps": "1.41BD"}},
    "prospect": {"Country": {"country": "'USA'"}, "SK_UpdateDateID": {"sk_updatedateid": "20010103"}, "MarketingNameplate": {"number_cars": "4"}},
}


def _tables(spark, extra=None):
    """The good rows, with one more for each of ``extra``."""
    t = {"industry": spark.sql("SELECT 'Mining' AS IN_NAME")}
    for name, cols in GOOD.items():
        changes = [{}, *((extra or {}).get(name, {}).values())]
        t[name] = spark.sql(" UNION ALL ".join("SELECT " + ", ".join(f"{v} AS {c}" for c, v in {**cols, **ch}.items()) for ch in changes))
    return t


def test_each_value_rule_is_broken_by_its_own_row(spark):
    def results(t):
        return {r.test: r.result for r in AU.audit_values(t).collect()}

    rules = {f"{n} {test}" for n, tests in AU.VALUE_RULES.items() for test in tests}
    between = {"dim_company distinct names", "dim_company Industry", "dim_account inactive customers"}
    good = results(_tables(spark))
    assert set(good) == rules | between and set(good.values()) == {"OK"}
    assert {f"{n} {test}" for n, tests in BAD.items() for test in tests} == rules
    for first in (True, False):  # one rule of a table broken, its others kept
        part = {n: {k: v for i, (k, v) in enumerate(tests.items()) if (i == 0) == first} for n, tests in BAD.items()}
        bad = {k for k, v in results(_tables(spark, part)).items() if v != "OK"}
        assert bad == {f"{n} {test}" for n, tests in part.items() for test in tests}
    rows_ = {"dim_company": {"a": {"company_id": "2L"}, "b": {"name": "'M'", "industry": "'Fishing'"}, "c": {"name": "null", "industry": "null"}},
             "dim_customer": {"a": {"sk_customerid": "2L", "status": "'Inactive'"}}, "dim_account": {"a": {"sk_customerid": "2L"}}}
    assert {k for k, v in results(_tables(spark, rows_)).items() if v != "OK"} == between


def test_rows_lie_in_the_days_of_their_batch(spark):
    audit = spark.sql("""SELECT * FROM VALUES ('Batch', 1, DATE'2001-01-01', 'FirstDay'), ('Batch', 1, DATE'2001-01-31', 'LastDay'),
        ('Batch', 2, DATE'2001-02-01', 'FirstDay'), ('Batch', 2, DATE'2001-02-02', 'LastDay') AS a(DataSet, BatchID, Date, Attribute)""")

    def day(name, column, *ok):
        return spark.createDataFrame(list(ok), f"batch_id int, {column} int")

    versions = spark.sql("SELECT 1 AS batch_id, DATE'2001-01-31' AS effective_date UNION ALL SELECT 2, DATE'2001-02-03'")
    t = {n: versions for n in ("dim_account", "dim_customer", "dim_security", "dim_company")}
    t["prospect"] = day("prospect", "sk_recorddateid", (1, 20010101), (2, 20010301), (2, 20010131))
    t["fact_market"] = day("fact_market", "sk_dateid", (1, 20001231), (2, 20010202))
    t["fact_cash"] = t["fact_holdings"] = day("fact", "sk_dateid", (1, 20010131), (2, 20010202), (3, 20010202), (1, None))
    t["fact_watches"] = spark.createDataFrame([(1, 20010105, None), (2, 20001205, 20010201), (3, 20010201, None)],
                                              "batch_id int, sk_dateid_dateplaced int, sk_dateid_dateremoved int")
    t["dim_trade"] = spark.createDataFrame([(1, 20010105, None, "Stop Loss"), (2, 20010105, None, "Limit Buy"), (2, 20001205, 20010202, "x"),
                                            (1, 20010120, 20010119, "x")],
                                           "batch_id int, sk_createdateid int, sk_closedateid int, type string")
    bad = {(r.test.split()[0], r.batch_id) for r in AU.audit_windows(t, audit).collect() if r.result != "OK"}
    assert bad == {*((n, 2) for n in ("dim_account", "dim_customer", "dim_security", "dim_company", "prospect", "fact_market")),
                   ("fact_cash", 3), ("fact_holdings", 3), ("fact_watches", 3), ("dim_trade", 1)}


def test_counts_over_batches_and_snapshots(spark):
    def log(kind, key, *r):
        return spark.createDataFrame([(kind, *x) for x in r], f"message_type string, {key}, message_source string, message_text string, message_data string")

    n, j = "Row count", "Row count joined"
    batches = log("Validation", "batch_id int", *[(b, "fact_cash", n, str(v)) for b, v in ((0, 0), (1, 9), (2, 10), (3, 8))],
                  *[(b, "fact_cash", j, str(v)) for b, v in ((0, 0), (1, 9), (2, 9), (3, 8))], (1, "industry", n, "4"))
    got = {(r.test, r.batch_id): r.result for r in AU.audit_trends(batches).collect()}
    a, b = "Batch row count: fact_cash", "Batch joined row count: fact_cash"
    assert got == {(a, 1): "OK", (a, 2): "OK", (a, 3): "Not OK", ("Batch row count: industry", 1): "OK", (b, 1): "OK", (b, 2): "Not OK", (b, 3): "OK"}
    shots = log("Visibility_1", "snapshot_ts int", (1, "fact_cash", n, "5"), (1, "fact_cash", j, "5"), (2, "fact_cash", n, "7"), (2, "fact_cash", j, "6"),
                (1, "fact_watches", n, "10"), (1, "fact_watches", j, "10"), (2, "fact_watches", n, "9"), (2, "fact_watches", j, "9"), (3, "fact_watches", n, "10"),
                (3, "fact_watches", j, "10"))
    got = {r.test: r.result for r in AU.audit_trends(batches, shots).collect() if r.test.startswith("Data")}
    v, w = "Data visibility row counts: ", "Data visibility joined row counts: "
    assert got == {v + "fact_cash": "OK", w + "fact_cash": "Not OK", v + "fact_watches": "Not OK", w + "fact_watches": "OK"}
