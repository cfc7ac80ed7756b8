"""Lookups, CDC merges, facts, functions and alerts on tiny fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from histmart.functions import clean as CL
from histmart.operators import cdc as C
from histmart.operators import checks as CK
from histmart.operators import facts as FX
from histmart.operators import lookup as L
from histmart.operators import quality as Q

D = dt.date
T = dt.datetime
EOT = D(9999, 12, 31)


# --- lookups ------------------------------------------------------------------------

def test_dual_key_lookup_by_id_and_by_name(spark):
    # Each row gets the version at its own posting date
    dim = spark.createDataFrame([
        (17, "Acme", "A", D(2020, 1, 1), D(2020, 7, 1)), (17, "Acme", "B", D(2020, 7, 1), EOT),
        (18, "Bolt", "C", D(2020, 1, 1), EOT)],
        "id long, name string, grade string, effective_date date, end_date date")
    fact = spark.createDataFrame([
        (1, "0000000017", D(2020, 3, 1)), (2, "Acme", D(2020, 8, 1)), (3, "Bolt  ", D(2020, 2, 1)),
        (4, "0000000099", D(2020, 2, 1)), (5, "0000000017", D(2020, 7, 1))], "fid long, ref string, d date")
    out = L.asof_dual_key(fact, "ref", "d", dim, "id", "name", dim_cols=["id", "grade", "effective_date", "end_date"])
    assert rows(out, "fid", "id", "grade") == [(1, 17, "A"), (2, 17, "B"), (3, 18, "C"), (5, 17, "B")]


def test_exists_flag_null_safe_and_keeps_rows(spark):
    left = spark.createDataFrame([(1, "A", None), (2, "B", "x"), (3, "C", "y")], "id long, a string, b string")
    right = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "a string, b string")
    out = L.exists_flag(left, right, [(F.upper(left["a"]), F.upper(right["a"])),
                                      (left["b"], right["b"])], flag="hit")
    assert rows(out, "id", "hit") == [(1, True), (2, True), (3, False)]


def test_match_person_priority_then_id(spark):
    people = spark.createDataFrame([(1, "smith", None), (2, "jones", "x")], "pid long, ln string, fn string")
    cand = spark.createDataFrame([(10, "SMITH", None, 1), (11, "Smith", None, 2), (12, "smith", None, 2),
                                  (13, "JONES", "y", 9)], "cid long, ln string, fn string, pri int")
    out = L.match_person(people, cand, [("ln", "ln"), ("fn", "fn")], "cid", "pri")
    assert rows(out, "pid", "match_id") == [(1, 12), (2, None)]


def test_lookup_code_unmatched_is_null(spark):
    df = spark.createDataFrame([(1, "ACTV"), (2, "ZZZZ")], "id long, st string")
    codes = spark.createDataFrame([("ACTV", "Active"), ("INAC", "Inactive")], "st_id string, st_name string")
    assert rows(L.lookup_code(df, codes, "st", "st_id"), "id", "st_name") == [(1, "Active"), (2, None)]


# --- CDC -------------------------------------------------------------------------------

def test_latest_per_key_by_dsn_not_file_order(spark):
    # The highest CDC_DSN wins even when it comes first in the file
    df = spark.createDataFrame([(1, 9, "late"), (1, 3, "early"), (2, 1, "only")], "k long, dsn long, v string")
    assert rows(C.latest_per_key(df, "k", ["dsn"]), "k", "v") == [(1, "late"), (2, "only")]


def test_cdc_upsert_keeps_create_stamp(spark):
    tgt = spark.createDataFrame([(1, "SBMT", D(2020, 1, 1), None)], "id long, st string, created date, closed date")
    chg = spark.createDataFrame([(1, "CMPT", None, D(2020, 2, 1)), (2, "SBMT", D(2020, 3, 1), None)],
                                "id long, st string, created date, closed date")
    out = C.cdc_upsert(tgt, chg, "id", keep_from_target=["created"])
    assert rows(out, "id", "st", "created", "closed") == [
        (1, "CMPT", D(2020, 1, 1), D(2020, 2, 1)), (2, "SBMT", D(2020, 3, 1), None)]


def test_prospect_upsert_moves_update_date_only_on_change(spark):
    d1, d2 = D(2020, 1, 1), D(2021, 1, 1)
    tgt = spark.createDataFrame([(1, "a", None, d1, d1), (2, "b", "x", d1, d1), (3, "c", None, d1, d1)],
                                "k long, ln string, ad2 string, rec date, upd date")
    new = spark.createDataFrame([(1, "a", None, d2), (2, "B", "x", d2), (4, "d", None, d2)],
                                "k long, ln string, ad2 string, rec date")
    out = C.upsert_keep_first(tgt, new, "k", [], ["ln", "ad2"], "upd", F.lit(d2))
    assert rows(out, "k", "ln", "rec", "upd") == [
        (1, "a", d2, d1), (2, "B", d2, d2), (3, "c", d1, d1), (4, "d", d2, d2)]


# --- facts -------------------------------------------------------------------------------

def test_rolling_365_frame_and_extreme_date(spark):
    # W4 + D13: 364 days back is inside, 365 days back is outside; ties -> latest date
    base = D(2021, 1, 1)
    df = spark.createDataFrame([
        ("S", base - dt.timedelta(days=365), 90.0, 5.0),
        ("S", base - dt.timedelta(days=364), 80.0, 10.0),
        ("S", base - dt.timedelta(days=10), 80.0, 10.0),
        ("S", base, 50.0, 20.0),
        ("Q", base, 1.0, 1.0)], "sym string, day date, hi double, lo double")
    out = FX.rolling_extremes(df, "sym", "day", "hi", "lo").where(F.col("day") == base)
    got = {r.sym: (r.high_365, r.high_365_date, r.low_365, r.low_365_date) for r in out.collect()}
    assert got["S"] == (80.0, base - dt.timedelta(days=10), 10.0, base - dt.timedelta(days=10))
    assert got["Q"] == (1.0, base, 1.0, base)


def test_running_balance_with_opening(spark):
    # A change batch continues from the last balance per account
    df = spark.createDataFrame([(1, T(2021, 1, 1, 9), 10.0), (1, T(2021, 1, 1, 10), 5.0),
                                (1, T(2021, 1, 3), -2.5), (2, T(2021, 1, 2), 1.0)],
                               "acct long, ts timestamp, amt double")
    opening = spark.createDataFrame([(1, 100)], "acct long, opening int")
    daily = FX.daily_net(df, "acct", "ts", "amt")
    out = FX.running_balance(daily, "acct", opening=opening)
    assert [(r.acct, r.day, float(r.balance)) for r in out.orderBy("acct", "day").collect()] == [
        (1, D(2021, 1, 1), 115.0), (1, D(2021, 1, 3), 112.5), (2, D(2021, 1, 2), 1.0)]


def test_lifecycle_collapse(spark):
    df = spark.createDataFrame([(1, T(2021, 1, 1), "PNDG", 1), (1, T(2021, 1, 2), "SBMT", 2),
                                (1, T(2021, 1, 3), "CMPT", 3), (2, T(2021, 1, 1), "SBMT", 4)],
                               "t long, ts timestamp, st string, seq int")
    out = FX.lifecycle_collapse(df, "t", "ts", "st", ["PNDG", "SBMT"], ["CMPT", "CNCL"], order=["seq"])
    assert rows(out, "t", "create_ts", "close_ts") == [
        (1, T(2021, 1, 1), T(2021, 1, 3)), (2, T(2021, 1, 1), None)]


def test_prior_quarter_start_equals_range_predicate(spark):
    # The quarter start q with d - 3 months <= q < d
    days = [D(2000, 1, 1), D(2000, 1, 2), D(2000, 3, 31), D(2000, 4, 1), D(2000, 5, 31), D(2000, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.q for r in df.select(FX.prior_quarter_start(F.col("d")).alias("q")).collect()]
    assert got == [D(1999, 10, 1), D(2000, 1, 1), D(2000, 1, 1), D(2000, 1, 1), D(2000, 4, 1), D(2000, 10, 1)]


def test_last_and_first_nonnull_per_column(spark):
    df = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, "x"), (1, 3, "c", None)],
                               "k long, seq int, v string, w string")
    assert rows(FX.last_nonnull(df, "k", ["seq"], ["v", "w"])) == [(1, "c", "x")]
    assert rows(FX.first_nonnull(df, "k", ["seq"], ["v", "w"])) == [(1, "a", "x")]


# --- functions -------------------------------------------------------------------------

def test_format_phone_rules(spark):
    df = spark.createDataFrame([
        ("1", "415", "5551234", None), (None, "415", "5551234", "99"), ("", "", "5551234", ""),
        ("1", "415", None, None), ("1", "", "5551234", "7")], "c string, a string, l string, e string")
    got = [r.p for r in df.select(CL.format_phone("c", "a", "l", "e").alias("p")).collect()]
    assert got == ["+1 (415) 5551234", "(415) 555123499", "5551234", None, "55512347"]


def test_nameplate_tags_limits(spark):
    df = spark.createDataFrame([
        (1_000_001, 50_000, 4, 8, 24, 700, 0),     # HighValue, Expenses, Spender, Inherited
        (1_000_000, 200_000, 3, 5, 45, 600, 3),    # nothing fires on the limits
        (None, 10, 0, 0, 46, 500, 4),              # Boomer, Spender (MoneyAlert needs net worth)
    ], "nw long, inc long, ch int, cc int, age int, cr int, cars int")
    got = [r.t for r in df.select(CL.nameplate_tags("nw", "inc", "ch", "cc", "age", "cr", "cars").alias("t")).collect()]
    assert got == ["HighValue+Expenses+Spender+Inherited", None, "Boomer+Spender"]


def test_normalise_and_blank(spark):
    df = spark.createDataFrame([("m", "  "), ("x", "a"), (None, "")], "g string, s string")
    got = [(r.g, r.s) for r in df.select(CL.normalise_code("g", CL.GENDER_CODES).alias("g"),
                                         CL.blank_to_null("s").alias("s")).collect()]
    assert got == [("M", None), ("U", "a"), ("U", None)]


# --- alerts and checks ------------------------------------------------------------------

def test_dob_rule_and_alert_text_uses_business_key(spark):
    # Message data carries the business key; DOB limit is 100 years by months
    batch = D(2000, 1, 1)
    df = spark.createDataFrame([(5, D(1900, 1, 1)), (6, D(1899, 12, 31)), (7, D(2000, 1, 2)), (8, None)],
                               "c_id long, dob date")
    out = Q.alerts(df, Q.dob_out_of_range(F.col("dob"), F.lit(batch)), "DimCustomer", "DOB out of range",
                   [("C_ID", F.col("c_id")), ("C_DOB", F.col("dob"))], 1)
    assert rows(out, "message_data") == [("C_ID = 6, C_DOB = 1899-12-31",), ("C_ID = 7, C_DOB = 2000-01-02",)]


def test_interval_report_and_orphans(spark):
    v = spark.createDataFrame([
        (1, D(2020, 1, 1), D(2020, 2, 1), False), (1, D(2020, 2, 1), EOT, True),
        (2, D(2020, 1, 1), D(2020, 3, 1), False), (2, D(2020, 2, 1), EOT, True),   # overlap
        (3, D(2020, 1, 1), D(2020, 1, 1), True)],                                  # empty, not reaching end
        "k long, effective_date date, end_date date, is_current boolean")
    r = CK.interval_report(v, ["k"]).first()
    assert (r.versions, r.misaligned, r.overlapping, r.empty, r.bad_current, r.not_reaching_end) == (5, 1, 1, 1, 1, 1)
    child = spark.createDataFrame([(1,), (2,), (None,)], "p long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert CK.orphans(child, parent, "p", "id").count() == 1


def test_rolling_extremes_equal_brute_force(spark):
    import random

    rng = random.Random(4)
    data = []
    for key in "abc":
        day = dt.date(2019, 1, 1)
        for _ in range(120):
            day += dt.timedelta(days=rng.choice([1, 1, 2, 3, 9, 40]))
            data.append((key, day, rng.choice([None, *range(8)]), rng.choice([None, *range(8)]), rng.random()))
    df = spark.createDataFrame(data, "k string, day date, hi int, lo int, other double")
    for days in (1, 7, 60):
        got = {(r.k, r.day): r for r in FX.rolling_extremes(df, "k", "day", "hi", "lo", days=days).collect()}
        assert len(got) == len(data)
        for k, day, _, _, other in data:
            frame = [x for x in data if x[0] == k and day - dt.timedelta(days=days) < x[1] <= day]
            highs = [(x[2], x[1]) for x in frame if x[2] is not None]
            lows = [(x[3], -x[1].toordinal()) for x in frame if x[3] is not None]
            high = max(highs, default=(None, None))
            low = min(lows, default=(None, None))
            r = got[k, day]
            assert (r[f"high_{days}"], r[f"high_{days}_date"], r.other) == (*high, other)
            assert (r[f"low_{days}"], r[f"low_{days}_date"]) == (low[0], low[1] and dt.date.fromordinal(-low[1]))


def _market_dir(spark, tmp_path):
    """1200 lines of 30 parts in a table of their own."""
    spark.range(1200).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 30).alias("l_partkey"), (F.col("id") % 4).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"), (F.col("id") % 97 + 1).cast("double").alias("l_extendedprice"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") % 700).cast("int")).cast("timestamp_ntz").alias("l_shipdate")) \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def _tasks(monkeypatch, rows):
    from histmart import session
    monkeypatch.setattr(session, "ROWS_A_TASK", rows)


def test_tasks_follow_the_rows(spark, monkeypatch):
    from histmart.session import tasks_for
    _tasks(monkeypatch, 100)
    assert tasks_for(spark.range(1001)) == 11
    assert tasks_for(spark.range(5)) == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["rolling_high_low", "rolling_extreme_date"])
def test_rolling_tasks_grow_with_the_lines(spark, tmp_path, monkeypatch, name):
    import __spark_entry__ as E
    _tasks(monkeypatch, 100)
    assert E.queries()[name](spark, _market_dir(spark, tmp_path)).rdd.getNumPartitions() == 12


def test_price_order_tasks_grow_with_the_lines(spark, tmp_path, monkeypatch):
    import __spark_entry__ as E
    _tasks(monkeypatch, 100)
    plan = E.queries()["check_price_order"](spark, _market_dir(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and "hashpartitioning(l_partkey#" in plan and ", 12), REPARTITION_BY_NUM" in plan


def test_market_rows_tasks_grow_with_the_lines(spark, tmp_path, monkeypatch):
    from histmart.plans import adapter as A
    _tasks(monkeypatch, 100)
    assert A.market_records(spark, _market_dir(spark, tmp_path)).rdd.getNumPartitions() == 12
