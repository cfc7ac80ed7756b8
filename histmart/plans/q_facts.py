"""Fact-table driver queries: aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from histmart.operators import facts as FX
from histmart.operators.cdc import latest_per_key
from histmart.plans.registry import query, table
from histmart.session import tasks_for

# --- G11 lifecycle collapse -------------------------------------------------

@query("lifecycle_collapse", """
SELECT user_id,
  min(ts) FILTER (WHERE event_type IN ('signup', 'view')) AS create_ts,
  max(ts) FILTER (WHERE event_type IN ('purchase', 'error')) AS close_ts,
  arg_max(event_type, ts) AS last_status
FROM events GROUP BY user_id""")
def q_lifecycle_collapse(spark, sf_dir):
    """Per user: first ``signup``/``view`` opens, last ``purchase``/``error``
    closes - the trade-history collapse to one row per id."""
    ev = table(spark, sf_dir, "events")
    return FX.lifecycle_collapse(ev, "user_id", "ts", "event_type",
                                 ["signup", "view"], ["purchase", "error"], order=["event_id"])


# --- G12/W3 running balance -------------------------------------------------

_DAILY_SQL = """
daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS day_net
  FROM events GROUP BY user_id, CAST(ts AS DATE))"""


@query("running_balance", "WITH " + _DAILY_SQL + """
SELECT user_id, day, day_net,
       CAST(sum(day_net) OVER (PARTITION BY user_id ORDER BY day
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS balance
FROM daily""")
def q_running_balance(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    daily = FX.daily_net(ev, "user_id", "ts", "value")
    return FX.running_balance(daily, "user_id").select("user_id", "day", "day_net", "balance")


# --- W4-W6 rolling 365-day extremes -----------------------------------------

_MARKET_SQL = """
daily AS (
  SELECT l_partkey, CAST(l_shipdate AS DATE) AS day,
         max(CAST(l_extendedprice AS DECIMAL(15,2))) AS day_high,
         min(CAST(l_extendedprice AS DECIMAL(15,2))) AS day_low
  FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE)),
roll AS (
  SELECT daily.*,
    max(day_high) OVER w AS high_365,
    min(day_low) OVER w AS low_365
  FROM daily
  WINDOW w AS (PARTITION BY l_partkey ORDER BY day
               RANGE BETWEEN INTERVAL 364 DAYS PRECEDING AND CURRENT ROW))"""


def _market_extremes(spark, sf_dir):
    """Lines are dealt by part and day before they are grouped, so neither a
    task's groups nor its windows grow with the table."""
    li = table(spark, sf_dir, "lineitem")
    tasks = tasks_for(li)
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    day = F.col("l_shipdate").cast("date")
    daily = li.select("l_partkey", day.alias("day"), price.alias("price")).repartition(tasks, "l_partkey", "day") \
        .groupBy("l_partkey", "day").agg(F.max("price").alias("day_high"), F.min("price").alias("day_low"))
    return FX.rolling_extremes(daily, "l_partkey", "day", "day_high", "day_low", tasks=tasks)


@query("rolling_high_low", "WITH " + _MARKET_SQL + """
SELECT l_partkey, day, day_high, day_low, high_365, low_365 FROM roll""")
def q_rolling_high_low(spark, sf_dir):
    r = _market_extremes(spark, sf_dir)
    return r.select("l_partkey", "day", "day_high", "day_low", "high_365", "low_365")


@query("rolling_extreme_date", "WITH " + _MARKET_SQL + """
SELECT r.l_partkey, r.day, r.high_365,
  (SELECT max(d.day) FROM daily d WHERE d.l_partkey = r.l_partkey AND d.day > r.day - INTERVAL 365 DAY
     AND d.day <= r.day AND d.day_high = r.high_365) AS high_365_date,
  r.low_365,
  (SELECT max(d.day) FROM daily d WHERE d.l_partkey = r.l_partkey AND d.day > r.day - INTERVAL 365 DAY
     AND d.day <= r.day AND d.day_low = r.low_365) AS low_365_date
FROM roll r""")
def q_rolling_extreme_date(spark, sf_dir):
    """Latest date holding the rolling high / low inside the 365-day frame."""
    r = _market_extremes(spark, sf_dir)
    return r.select("l_partkey", "day", "high_365", F.col("high_365_date"),
                    "low_365", F.col("low_365_date"))


# --- W7 trailing four quarters, J11 range join ratio ----------------------------

_QTR_SQL = """
qtr AS (
  SELECT o_custkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS qtr,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total
  FROM orders GROUP BY o_custkey, CAST(date_trunc('quarter', o_orderdate) AS DATE)),
t4 AS (
  SELECT qtr.*, CAST(sum(total) OVER (PARTITION BY o_custkey ORDER BY qtr
                     ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS trailing_4q
  FROM qtr)"""


def _quarters(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    q = o.groupBy("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("qtr")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))
    t4 = FX.trailing_sum(q, "o_custkey", ["qtr"], "total", rows=4, out="trailing_4q")
    return t4.withColumn("trailing_4q", F.col("trailing_4q").cast("decimal(38,2)"))


@query("trailing_4q", "WITH " + _QTR_SQL + " SELECT o_custkey, qtr, total, trailing_4q FROM t4")
def q_trailing_4q(spark, sf_dir):
    return _quarters(spark, sf_dir).select("o_custkey", "qtr", "total", "trailing_4q")


@query("range_join_ratio", "WITH " + _QTR_SQL + """
SELECT o.o_orderkey, o.o_custkey, t4.qtr, t4.trailing_4q,
       CAST(o.o_totalprice AS DOUBLE) / NULLIF(CAST(t4.trailing_4q AS DOUBLE), 0) AS ratio
FROM orders o LEFT JOIN t4 ON o.o_custkey = t4.o_custkey
  AND t4.qtr >= CAST(o.o_orderdate AS DATE) - INTERVAL 3 MONTH
  AND t4.qtr < CAST(o.o_orderdate AS DATE)""")
def q_range_join_ratio(spark, sf_dir):
    """Each order against the customer's trailing-4-quarter total of the
    quarter starting in [order date - 3 months, order date).  Exactly one
    quarter start lies in that range, so the range predicate becomes an
    equi-join key (prior quarter start): hash join, no residual scan."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        FX.prior_quarter_start(F.col("o_orderdate").cast("date")).alias("__q"))
    t4 = _quarters(spark, sf_dir).select(F.col("o_custkey").alias("__c"), "qtr", "trailing_4q")
    j = o.join(t4, (o.o_custkey == t4.__c) & (o.__q == t4.qtr), "left")
    return j.select("o_orderkey", "o_custkey", "qtr", "trailing_4q",
                    F.try_divide(F.col("o_totalprice"), F.col("trailing_4q").cast("double")).alias("ratio"))


# --- G5 / G6 per-column last and first non-null ------------------------------

_NULLY_SQL = """
e AS (
  SELECT event_id, user_id, ts,
         CASE WHEN event_id % 3 = 0 THEN CAST(value AS DECIMAL(12,2)) END AS value,
         CASE WHEN event_id % 2 = 0 THEN event_type END AS event_type
  FROM events)"""


def _nully(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_id") % 3 == 0, F.col("value").cast("decimal(12,2)")).alias("value"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("event_type"))


@query("last_nonnull", "WITH " + _NULLY_SQL + """
SELECT user_id,
  arg_max(value, ts) FILTER (WHERE value IS NOT NULL) AS value,
  arg_max(event_type, ts) FILTER (WHERE event_type IS NOT NULL) AS event_type
FROM e GROUP BY user_id""")
def q_last_nonnull(spark, sf_dir):
    return FX.last_nonnull(_nully(spark, sf_dir), "user_id", ["ts", "event_id"], ["value", "event_type"])


@query("first_nonnull", "WITH " + _NULLY_SQL + """
SELECT user_id,
  arg_min(value, ts) FILTER (WHERE value IS NOT NULL) AS value,
  arg_min(event_type, ts) FILTER (WHERE event_type IS NOT NULL) AS event_type,
  min(ts) FILTER (WHERE event_type = 'click') AS placed_ts,
  max(ts) FILTER (WHERE event_type = 'error') AS removed_ts
FROM e GROUP BY user_id""")
def q_first_nonnull(spark, sf_dir):
    """First non-null per column, plus the watch pattern: placed = first
    ``click``, removed = last ``error`` (rule D24)."""
    e = _nully(spark, sf_dir)
    first = FX.first_nonnull(e, "user_id", ["ts", "event_id"], ["value", "event_type"])
    stamps = e.groupBy("user_id").agg(
        F.min(F.when(F.col("event_type") == "click", F.col("ts"))).alias("placed_ts"),
        F.max(F.when(F.col("event_type") == "error", F.col("ts"))).alias("removed_ts"))
    return first.join(stamps, "user_id")


# --- G8 latest per key ------------------------------------------------------------

@query("latest_per_key", """
SELECT user_id, event_type, arg_max(event_id, ts) AS event_id,
       arg_max(value, ts) AS value, max(ts) AS ts
FROM events GROUP BY user_id, event_type""")
def q_latest_per_key(spark, sf_dir):
    """Last row per (user, type) by (ts, event_id): a map-side ``max_by``,
    never a full sort of a hot group."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return latest_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"])


# --- G4 conditional sums -------------------------------------------------------

@query("conditional_sums", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS batch_id,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE 0 END) AS DECIMAL(38,2)) AS qty_returned,
  CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(12,2)) ELSE 0 END) AS DECIMAL(38,2)) AS qty_accepted,
  CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS closed_lines,
  CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS discounted_lines,
  CAST(sum(CASE WHEN l_tax = 0 THEN CAST(l_extendedprice AS DECIMAL(15,2)) ELSE 0 END) AS DECIMAL(38,2)) AS untaxed_value,
  count(*) FILTER (WHERE l_quantity >= 40) AS bulk_lines
FROM lineitem GROUP BY 1""")
def q_conditional_sums(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("decimal(12,2)")
    zero = F.lit(0).cast("decimal(12,2)")
    return li.groupBy(F.year("l_shipdate").cast("int").alias("batch_id")).agg(
        F.sum(F.when(F.col("l_returnflag") == "R", q).otherwise(zero)).cast("decimal(38,2)").alias("qty_returned"),
        F.sum(F.when(F.col("l_returnflag") == "A", q).otherwise(zero)).cast("decimal(38,2)").alias("qty_accepted"),
        F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).cast("bigint").alias("closed_lines"),
        F.sum(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).cast("bigint").alias("discounted_lines"),
        F.sum(F.when(F.col("l_tax") == 0, F.col("l_extendedprice").cast("decimal(15,2)"))
              .otherwise(F.lit(0).cast("decimal(15,2)"))).cast("decimal(38,2)").alias("untaxed_value"),
        F.count_if(F.col("l_quantity") >= 40).alias("bulk_lines"))


# --- G7 group by + having -------------------------------------------------------

@query("group_having", """
SELECT o_custkey, count(*) AS orders
FROM orders GROUP BY o_custkey
HAVING sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) = 0""")
def q_group_having(spark, sf_dir):
    """Customers with orders but none finished (the inactive-without-inactive
    pattern): aggregate, then filter on the aggregate."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy("o_custkey")
             .agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("__f"))
             .where(F.col("__f") == 0).drop("__f"))


# --- G1 / G2 / O4 / O5 / O1 -----------------------------------------------------

_COUNT_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS tbl, count(*) AS n, (SELECT max(CAST(year(o_orderdate) AS INTEGER)) FROM orders) AS batch_id FROM {t}"
    for t in _COUNT_TABLES) + """
UNION ALL SELECT 'orders_finished', count(*) FILTER (WHERE o_orderstatus = 'F'),
  (SELECT max(CAST(year(o_orderdate) AS INTEGER)) FROM orders) FROM orders
UNION ALL SELECT 'events_error', count(*) FILTER (WHERE event_type = 'error'),
  (SELECT max(CAST(year(o_orderdate) AS INTEGER)) FROM orders) FROM events""")
def q_table_counts(spark, sf_dir):
    """Validation snapshot: a count per table plus two extra counts, each
    tagged with the current batch id (a scalar subquery)."""
    dfs = {t: table(spark, sf_dir, t) for t in _COUNT_TABLES}
    batch = dfs["orders"].agg(F.max(F.year("o_orderdate").cast("int"))).scalar()
    parts = [dfs[t].agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tbl"), "n") for t in _COUNT_TABLES]
    parts.append(dfs["orders"].agg(F.count_if(F.col("o_orderstatus") == "F").alias("n"))
                 .select(F.lit("orders_finished").alias("tbl"), "n"))
    parts.append(dfs["events"].agg(F.count_if(F.col("event_type") == "error").alias("n"))
                 .select(F.lit("events_error").alias("tbl"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("batch_id", batch)


@query("distinct_keys", """
SELECT 'orders' AS tbl, count(*) AS n, count(DISTINCT o_orderkey) AS n_distinct FROM orders
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'customer', count(*), count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'part', count(*), count(DISTINCT p_partkey) FROM part
UNION ALL SELECT 'part_name', count(*), count(DISTINCT p_name) FROM part
UNION ALL SELECT 'events_user_ts', count(*), count(DISTINCT (user_id, ts)) FROM events""")
def q_distinct_keys(spark, sf_dir):
    """Key uniqueness: count against count distinct per table."""
    def one(df, name, *cols):
        return df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(*cols).alias("n_distinct")) \
                 .select(F.lit(name).alias("tbl"), "n", "n_distinct")
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    c, p, e = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part"), table(spark, sf_dir, "events")
    return (one(o, "orders", "o_orderkey").unionByName(one(li, "lineitem", "l_orderkey", "l_linenumber"))
            .unionByName(one(c, "customer", "c_custkey")).unionByName(one(p, "part", "p_partkey"))
            .unionByName(one(p, "part_name", "p_name")).unionByName(one(e, "events_user_ts", "user_id", "ts")))


@query("union_all", """
SELECT 'orders' AS source, o_orderkey AS id, CAST(o_orderdate AS DATE) AS day,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus AS status, NULL AS kind FROM orders
UNION ALL
SELECT 'events', event_id, CAST(ts AS DATE), CAST(value AS DECIMAL(18,2)), NULL, event_type FROM events""")
def q_union_all(spark, sf_dir):
    """Rows of two sources stacked by name; columns one side lacks are null."""
    o = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), F.col("o_orderstatus").alias("status"))
    e = table(spark, sf_dir, "events").select(
        F.lit("events").alias("source"), F.col("event_id").alias("id"), F.col("ts").cast("date").alias("day"),
        F.col("value").cast("decimal(18,2)").alias("amount"), F.col("event_type").alias("kind"))
    return o.unionByName(e, allowMissingColumns=True)


@query("report_sorted", """
SELECT n.n_name, count(*) AS customers,
       CAST(sum(CAST(c.c_acctbal AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name ORDER BY n.n_name""")
def q_report_sorted(spark, sf_dir):
    """A report sorted only at the end (one global sort of a small result)."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
             .groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"),
                                    F.sum(F.col("c_acctbal").cast("decimal(15,2)")).cast("decimal(38,2)")
                                    .alias("balance"))
             .orderBy("n_name"))
