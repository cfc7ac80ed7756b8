"""Version building, change detection, forward fill, merge and cascade."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from histmart.operators import history as H
from histmart.operators.keys import assign_keys
from histmart.operators.lookup import asof_lookup

D = dt.date
T = dt.datetime
EOT = D(9999, 12, 31)


def test_same_day_records_keep_the_last(spark):
    # Two records of one key on one day -> one version, the later one
    df = spark.createDataFrame([
        (1, "a", T(2020, 1, 1, 9), 1), (1, "b", T(2020, 1, 1, 17), 2), (1, "c", T(2020, 1, 5, 8), 3),
    ], "k long, v string, ts timestamp, seq int")
    out = H.scd2_intervals(df, "k", "ts", order=["seq"])
    assert rows(out, "v", "effective_date", "end_date", "is_current") == [
        ("b", D(2020, 1, 1), D(2020, 1, 5), False), ("c", D(2020, 1, 5), EOT, True)]


def test_same_timestamp_ties_broken_by_order(spark):
    df = spark.createDataFrame([(1, "x", T(2020, 1, 1), 2), (1, "y", T(2020, 1, 1), 1)],
                               "k long, v string, ts timestamp, seq int")
    out = H.scd2_intervals(df, "k", "ts", order=["seq"])
    assert rows(out, "v") == [("x",)]


def test_change_detection_null_equals_null(spark):
    # Null against null is *not* a change; null against a value is
    df = spark.createDataFrame([
        (1, None, "p", T(2020, 1, 1)), (1, None, "p", T(2020, 2, 1)), (1, "x", "p", T(2020, 3, 1)),
        (1, "x", "p", T(2020, 4, 1)), (1, None, "p", T(2020, 5, 1)),
    ], "k long, a string, b string, ts timestamp")
    out = H.scd2_intervals(df, "k", "ts", attrs=["a", "b"])
    got = sorted(((r.a, r.effective_date, r.end_date) for r in out.collect()), key=lambda t: t[1])
    assert got == [(None, D(2020, 1, 1), D(2020, 3, 1)), ("x", D(2020, 3, 1), D(2020, 5, 1)),
                   (None, D(2020, 5, 1), EOT)]
    # exactly one current version, intervals chain
    assert out.where("is_current").count() == 1


def test_point_in_time_is_half_open(spark):
    # a fact on the exact start day of a version belongs to the new version
    dim = spark.createDataFrame([(1, "old", D(2020, 1, 1), D(2020, 6, 1)), (1, "new", D(2020, 6, 1), EOT)],
                                "k long, v string, effective_date date, end_date date")
    fact = spark.createDataFrame([(10, 1, D(2020, 5, 31)), (11, 1, D(2020, 6, 1)), (12, 1, D(2019, 12, 31))],
                                 "id long, k long, d date")
    for strategy in ("join", "carry"):
        out = asof_lookup(fact, dim, "k", "k", "d", strategy=strategy, dim_cols=["v", "effective_date", "end_date"])
        assert rows(out, "id", "v") == [(10, "old"), (11, "new")], strategy


def test_asof_strategies_agree_with_left_join(spark):
    dim = spark.createDataFrame([(1, "a", D(2020, 1, 1), D(2020, 2, 1)), (1, "b", D(2020, 3, 1), EOT),
                                 (2, "c", D(2020, 1, 1), EOT)],
                                "k long, v string, effective_date date, end_date date")
    fact = spark.createDataFrame([(1, 1, D(2020, 1, 15)), (2, 1, D(2020, 2, 15)), (3, 1, D(2020, 3, 2)),
                                  (4, 2, D(2020, 1, 1)), (5, 3, D(2020, 1, 1))], "id long, k long, d date")
    a = asof_lookup(fact, dim, "k", "k", "d", how="left", dim_cols=["v", "effective_date", "end_date"])
    b = asof_lookup(fact, dim, "k", "k", "d", how="left", strategy="carry",
                    dim_cols=["v", "effective_date", "end_date"])
    assert rows(a, "id", "v") == rows(b, "id", "v") == [(1, "a"), (2, None), (3, "b"), (4, "c"), (5, None)]


def test_carry_forward_absent_vs_empty(spark):
    # Absent (null) takes the running state, empty string is a value
    df = spark.createDataFrame([
        (1, 1, "Smith", "a@x"), (1, 2, None, ""), (1, 3, "Jones", None), (1, 4, None, None),
    ], "k long, seq int, name string, email string")
    out = H.carry_forward(df, "k", ["seq"], ["name", "email"])
    assert rows(out, "seq", "name", "email") == [
        (1, "Smith", "a@x"), (2, "Smith", ""), (3, "Jones", ""), (4, "Jones", "")]


def test_scd2_apply_closes_current_and_keys_above_max(spark):
    target = spark.createDataFrame([
        (1, "a", D(2020, 1, 1), D(2020, 6, 1), False, 1),
        (1, "b", D(2020, 6, 1), EOT, True, 2),
        (2, "c", D(2020, 1, 1), EOT, True, 3),
        (3, "d", D(2020, 1, 1), EOT, True, 4),
    ], "k long, v string, effective_date date, end_date date, is_current boolean, sk long")
    changes = spark.createDataFrame([
        (1, "b", T(2021, 1, 1), 1),      # same as current: no new version (W2)
        (1, "e", T(2021, 2, 1), 2),      # new version of key 1
        (2, "f", T(2021, 1, 1), 3), (2, "g", T(2021, 1, 1, 12), 4),  # same day: last wins (D17)
        (9, "z", T(2021, 3, 1), 5),      # new key
    ], "k long, v string, ts timestamp, dsn long")
    out = H.scd2_apply(target, changes, "k", ["v"], "ts", order=["dsn"], sk_col="sk")
    got = rows(out, "k", "v", "effective_date", "end_date", "is_current", "sk")
    assert got == [
        (1, "a", D(2020, 1, 1), D(2020, 6, 1), False, 1),
        (1, "b", D(2020, 6, 1), D(2021, 2, 1), False, 2),
        (1, "e", D(2021, 2, 1), EOT, True, 5),
        (2, "c", D(2020, 1, 1), D(2021, 1, 1), False, 3),
        (2, "g", D(2021, 1, 1), EOT, True, 6),
        (3, "d", D(2020, 1, 1), EOT, True, 4),
        (9, "z", D(2021, 3, 1), EOT, True, 7),
    ]


def test_same_day_overwrite_keeps_surrogate_and_replay_is_stable(spark):
    # a change on the start day of the current version overwrites it in place
    target = spark.createDataFrame([(1, "a", D(2020, 1, 1), EOT, True, 1)],
                                   "k long, v string, effective_date date, end_date date, is_current boolean, sk long")
    changes = spark.createDataFrame([(1, "b", T(2021, 1, 1), 1)], "k long, v string, ts timestamp, dsn long")
    once = H.scd2_apply(target, changes, "k", ["v"], "ts", order=["dsn"])
    assert rows(once, "v", "sk", "is_current") == [("a", 1, False), ("b", 2, True)]
    twice = H.scd2_apply(once, changes, "k", ["v"], "ts", order=["dsn"])
    assert rows(once) == rows(twice)
    fix = spark.createDataFrame([(1, "c", T(2021, 1, 1, 18), 2)], "k long, v string, ts timestamp, dsn long")
    third = H.scd2_apply(twice, fix, "k", ["v"], "ts", order=["dsn"])
    assert rows(third, "v", "sk", "is_current") == [("a", 1, False), ("c", 2, True)]


def test_cascade_uses_new_parent_surrogate_and_status(spark):
    # New account versions point at the *new* customer version and its status
    parents = spark.createDataFrame([(7, "INACTIVE", D(2021, 1, 1), 42)],
                                    "c_id long, status string, effective_date date, sk long")
    accounts = spark.createDataFrame([(70, 7, "ACTIVE", 11), (71, 7, "ACTIVE", 11), (80, 8, "ACTIVE", 12)],
                                     "ca_id long, c_id long, status string, parent_sk long")
    out = H.cascade_versions(parents, accounts, "c_id", "c_id", carry=["status"])
    assert rows(out, "ca_id", "parent_sk", "status", "cascade_eff") == [
        (70, 42, "INACTIVE", D(2021, 1, 1)), (71, 42, "INACTIVE", D(2021, 1, 1))]


def test_assign_keys_dense_in_order_over_partitions(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k")).repartition(13)
    out = assign_keys(df, ["k"], "sk", base=100, num_partitions=7)
    got = [(r.k, r.sk) for r in out.orderBy("k").collect()]
    assert [sk for _, sk in got] == list(range(101, 5101))
    assert [k for k, _ in got] == list(range(5000))


def test_carry_forward_crosses_day_chunks(spark):
    # the chunked scan must carry state over days with no value at all
    df = spark.createDataFrame([
        (1, T(2020, 1, 1, 9), "a", None), (1, T(2020, 1, 1, 10), None, "x"),
        (1, T(2020, 1, 2, 8), None, None), (1, T(2020, 1, 5, 8), None, "y"),
        (1, T(2020, 1, 5, 9), "b", None), (2, T(2020, 1, 5, 9), None, "z"),
    ], "k long, ts timestamp, v string, w string")
    out = H.carry_forward(df, "k", ["ts"], ["v", "w"])
    assert rows(out, "k", "ts", "v", "w") == [
        (1, T(2020, 1, 1, 9), "a", None), (1, T(2020, 1, 1, 10), "a", "x"), (1, T(2020, 1, 2, 8), "a", "x"),
        (1, T(2020, 1, 5, 8), "a", "y"), (1, T(2020, 1, 5, 9), "b", "y"), (2, T(2020, 1, 5, 9), None, "z")]


def test_asof_strategies_agree_on_long_version_lists(spark):
    from histmart.operators import lookup as L

    dim = spark.range(0, 100).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("v"),
                                     F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
                                     .alias("effective_date"),
                                     F.date_add(F.lit("2020-01-02").cast("date"), F.col("id").cast("int"))
                                     .alias("end_date"))
    fact = spark.createDataFrame([(1, 1, D(2020, 1, 11)), (2, 1, D(2020, 3, 1))], "id long, k long, d date")
    expected = [(1, 10), (2, 60)]
    for strategy in ("join", "carry"):
        out = L.asof_lookup(fact, dim, "k", "k", "d", strategy=strategy, dim_cols=["v", "effective_date", "end_date"])
        assert rows(out, "id", "v") == expected


def test_carry_forward_hot_and_other_keys_agree(spark):
    """Keys over the limit are filled in chunks, others in one window; both give the running state."""
    n = 60
    data = [(k, dt.datetime(2020, 1, 1) + dt.timedelta(hours=7 * i), f"v{i}" if i % 5 == 0 else None, i if (i + k) % 7 == 0 else None)
            for k, rows_ in ((1, n), (2, 8)) for i in range(rows_)] + [(None, dt.datetime(2020, 1, 1), "x", None), (None, dt.datetime(2020, 1, 1, 1), None, 5)]
    df = spark.createDataFrame(data, "k long, ts timestamp, v string, w long")
    want, state = [], {}
    for k, ts, v, w in data:
        old = state.get(k, (None, None))
        state[k] = (v if v is not None else old[0], w if w is not None else old[1])
        want.append((k, ts, *state[k]))
    order = lambda x: (x[0] is not None, x[0] or 0, x[1])
    for limit in (1, 20, 1000):  # all keys hot, one of them, none
        out = H.carry_forward(df, "k", ["ts"], ["v", "w"], hot_rows=limit)
        assert sorted((tuple(r) for r in out.collect()), key=order) == sorted(want, key=order)


def test_carry_forward_without_hot_keys_shuffles_the_rows_once(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("k"), F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"))
    out = H.carry_forward(df, "k", ["seq"], ["v"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # the count by key and the rows; no join with states of chunks is left
    assert plan.count("+- Exchange hashpartitioning") <= 2 and "SortMergeJoin" not in plan


def _filled_versions(spark, whole, hot_rows=None):
    data = [(1, None, "b", None), (1, T(2020, 1, 1, 9), "a", None), (1, T(2020, 1, 1, 17), None, 3), (1, T(2020, 1, 1, 17), None, 3),
            (1, T(2020, 1, 5, 8), None, None), (2, T(2020, 1, 3), "", 1), (2, T(2020, 1, 2), "x", None), (3, None, None, 7), (3, None, None, 7)]
    df = spark.createDataFrame([(*x, i % 7) for i, x in enumerate(data)], "k long, ts timestamp, v string, w int, seq int").repartition(3)
    filled = H.carry_forward(df, "k", ["ts", "seq"], ["v", "w"], whole=whole)
    return H.scd2_intervals(filled, "k", "ts", order=["seq"], whole=whole)


def test_filled_versions_of_whole_keys_take_one_shuffle(spark):
    chunked, whole = _filled_versions(spark, False), _filled_versions(spark, True)
    assert whole.columns == chunked.columns and whole.dtypes == chunked.dtypes
    assert sorted(map(str, whole.collect())) == sorted(map(str, chunked.collect()))
    assert whole.count() == 6  # a day that isn't known is a day; the last of each stays
    plan = whole._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Aggregate" not in plan
    assert plan.count("Sort [") == 1


def test_whole_keys_are_those_that_a_task_may_sort(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 2)], "k long, j long")
    assert H.whole_keys(df, "k", 2) and not H.whole_keys(df, "k", 1)
    assert not H.whole_keys(df, ["k", "j"], 1) and H.whole_keys(df, ["k", "j"], 2)
    assert not H.whole_keys(df.unionByName(spark.createDataFrame([(None, 1)], "k long, j long")), ["j", "k"], 9)


def test_large_methods_are_left_out_for_a_block(spark):
    from histmart.session import compiled_methods

    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with compiled_methods(spark):
        assert spark.conf.get(name) == "8000"
    assert spark.conf.get(name) == before
    spark.conf.set(name, "9000")
    try:
        with compiled_methods(spark):
            assert spark.conf.get(name) == "9000"
        assert spark.conf.get(name) == "9000"
    finally:
        spark.conf.unset(name)
