"""Change-data driver queries.

Base / delta splits are by time, as change batches are: events before
2024-01-16 are batch 1, the rest batch 2; orders before 2000-01-01 batch 1.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from histmart.operators import cdc as C
from histmart.operators.facts import last_nonnull
from histmart.operators.keys import assign_keys
from histmart.plans.q_history import _VER_SQL, priority_versions
from histmart.plans.registry import query, table
from histmart.sources import readers as R
from histmart.sources.schemas import _s

EVENT_SPLIT = "2024-01-16"
ORDER_SPLIT = "2000-01-01"

EVENT_CDC = _s("CDC_FLAG:str", "CDC_DSN:long", "user_id:long", "event_type:str", "value:str",
               "ts:str")


def _event_split(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    split = F.lit(EVENT_SPLIT).cast("timestamp_ntz")
    return ev.where(F.col("ts") < split), ev.where(F.col("ts") >= split)


# --- S11 + K5: CDC file applied to a keyed table ------------------------------------

@query("cdc_apply", f"""
WITH base AS (SELECT * FROM events WHERE ts < TIMESTAMP '{EVENT_SPLIT}'),
delta AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{EVENT_SPLIT}'),
base_keys AS (SELECT DISTINCT user_id, event_type FROM base),
latest AS (
  SELECT user_id, event_type, arg_max(event_id, event_id) AS event_id
  FROM events GROUP BY user_id, event_type)
SELECT l.user_id, l.event_type, l.event_id, e.value, e.ts,
  CASE WHEN e.ts < TIMESTAMP '{EVENT_SPLIT}' THEN NULL
       WHEN EXISTS (SELECT 1 FROM base_keys b WHERE b.user_id = l.user_id AND b.event_type = l.event_type)
       THEN 'U' ELSE 'I' END AS cdc_flag
FROM latest l JOIN events e ON e.event_id = l.event_id""")
def q_cdc_apply(spark, sf_dir):
    """Batch-2 events written as a CDC file (flag, DSN first), parsed with the
    CDC schema, reduced to the highest DSN per key (D12) and upserted into
    the batch-1 state."""
    base, delta = _event_split(spark, sf_dir)
    base_keys = base.select("user_id", "event_type").distinct().withColumn("__seen", F.lit(True))
    flagged = delta.join(base_keys, ["user_id", "event_type"], "left")
    text = flagged.select(F.concat_ws(
        "|", F.when(F.col("__seen"), F.lit("U")).otherwise(F.lit("I")), F.col("event_id").cast("string"),
        F.col("user_id").cast("string"), "event_type", F.col("value").cast("string"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("value"))
    cdc = R.parse_delimited(text, "value", EVENT_CDC).select(
        "user_id", "event_type", F.col("CDC_DSN").alias("event_id"),
        F.col("value").cast("double").alias("value"),
        F.to_timestamp_ntz(F.col("ts"), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts"),
        F.col("CDC_FLAG").alias("cdc_flag"))
    target = C.latest_per_key(base, ["user_id", "event_type"], ["event_id"]) \
        .withColumn("cdc_flag", F.lit(None).cast("string"))
    return C.cdc_upsert(target, cdc, ["user_id", "event_type"], order=["event_id"]) \
        .select("user_id", "event_type", "event_id", "value", "ts", "cdc_flag")


# --- K5 + G5: trade upsert keeping create stamps -----------------------------------

_TRADE_SQL = f"""
ord AS (SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, m.max_ship
        FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS max_ship FROM lineitem GROUP BY 1) m
        ON o.o_orderkey = m.l_orderkey),
tgt AS (
  SELECT o_orderkey AS trade_id,
         CASE WHEN max_ship < TIMESTAMP '{ORDER_SPLIT}' THEN 'CMPT' ELSE 'SBMT' END AS status,
         CAST(o_orderdate AS DATE) AS create_date,
         CASE WHEN max_ship < TIMESTAMP '{ORDER_SPLIT}' THEN CAST(max_ship AS DATE) END AS close_date,
         CAST(o_totalprice AS DECIMAL(15,2)) AS price
  FROM ord WHERE o_orderdate < TIMESTAMP '{ORDER_SPLIT}'),
chg AS (
  SELECT o_orderkey AS trade_id, o_orderkey * 2 AS dsn, 'SBMT' AS status,
         CAST(o_orderdate AS DATE) AS create_date, CAST(NULL AS DATE) AS close_date,
         CAST(o_totalprice AS DECIMAL(15,2)) AS price
  FROM ord WHERE o_orderdate >= TIMESTAMP '{ORDER_SPLIT}'
  UNION ALL
  SELECT o_orderkey, o_orderkey * 2 + 1, 'CMPT', NULL, CAST(max_ship AS DATE),
         CAST(CAST(o_totalprice AS DECIMAL(15,2)) * 1.01 AS DECIMAL(15,2))
  FROM ord WHERE max_ship >= TIMESTAMP '{ORDER_SPLIT}'),
col AS (
  SELECT trade_id,
    arg_max(status, dsn) FILTER (WHERE status IS NOT NULL) AS status,
    arg_max(create_date, dsn) FILTER (WHERE create_date IS NOT NULL) AS create_date,
    arg_max(close_date, dsn) FILTER (WHERE close_date IS NOT NULL) AS close_date,
    arg_max(price, dsn) FILTER (WHERE price IS NOT NULL) AS price
  FROM chg GROUP BY trade_id)"""


def trade_batches(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    ms = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("max_ship"))
    ordr = o.join(ms, o.o_orderkey == ms.l_orderkey, "left")
    split = F.lit(ORDER_SPLIT).cast("timestamp_ntz")
    price = F.col("o_totalprice").cast("decimal(15,2)")
    closed1 = F.col("max_ship") < split
    tgt = ordr.where(F.col("o_orderdate") < split).select(
        F.col("o_orderkey").alias("trade_id"),
        F.when(closed1, F.lit("CMPT")).otherwise(F.lit("SBMT")).alias("status"),
        F.col("o_orderdate").cast("date").alias("create_date"),
        F.when(closed1, F.col("max_ship").cast("date")).alias("close_date"), price.alias("price"))
    ins = ordr.where(F.col("o_orderdate") >= split).select(
        F.col("o_orderkey").alias("trade_id"), (F.col("o_orderkey") * 2).alias("dsn"),
        F.lit("SBMT").alias("status"), F.col("o_orderdate").cast("date").alias("create_date"),
        F.lit(None).cast("date").alias("close_date"), price.alias("price"))
    upd = ordr.where(F.col("max_ship") >= split).select(
        F.col("o_orderkey").alias("trade_id"), (F.col("o_orderkey") * 2 + 1).alias("dsn"),
        F.lit("CMPT").alias("status"), F.lit(None).cast("date").alias("create_date"),
        F.col("max_ship").cast("date").alias("close_date"),
        (price * F.lit(1.01).cast("decimal(3,2)")).cast("decimal(15,2)").alias("price"))
    return tgt, ins.unionByName(upd)


@query("cdc_upsert", "WITH " + _TRADE_SQL + """
SELECT coalesce(t.trade_id, c.trade_id) AS trade_id,
       CASE WHEN c.trade_id IS NOT NULL THEN c.status ELSE t.status END AS status,
       CASE WHEN t.trade_id IS NOT NULL THEN t.create_date ELSE c.create_date END AS create_date,
       CASE WHEN c.trade_id IS NOT NULL THEN c.close_date ELSE t.close_date END AS close_date,
       CASE WHEN c.trade_id IS NOT NULL THEN c.price ELSE t.price END AS price
FROM tgt t FULL OUTER JOIN col c ON t.trade_id = c.trade_id""")
def q_cdc_upsert(spark, sf_dir):
    """Trade upsert: batch-2 rows collapse to the last non-null value per
    column (G5), then replace batch-1 rows by key except the create stamp."""
    tgt, chg = trade_batches(spark, sf_dir)
    collapsed = last_nonnull(chg, "trade_id", ["dsn"], ["status", "create_date", "close_date", "price"])
    return C.cdc_upsert(tgt, collapsed, "trade_id", keep_from_target=["create_date"]) \
        .select("trade_id", "status", "create_date", "close_date", "price")


# --- K6 prospect upsert -------------------------------------------------------------

_PROSPECT_SQL = """
p1 AS (SELECT c_custkey AS agency_id, upper(c_name) AS last_name, c_nationkey AS nation,
              CAST(c_acctbal AS DECIMAL(15,2)) AS net_worth
       FROM customer WHERE c_custkey % 4 <> 3),
p2 AS (SELECT c_custkey AS agency_id, upper(c_name) AS last_name, c_nationkey AS nation,
              CAST(CAST(c_acctbal AS DECIMAL(15,2)) + CASE WHEN c_custkey % 5 = 0 THEN 100 ELSE 0 END
                   AS DECIMAL(15,2)) AS net_worth
       FROM customer WHERE c_custkey % 4 <> 1)"""


def prospect_files(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    nw = F.col("c_acctbal").cast("decimal(15,2)")
    cols = [F.col("c_custkey").alias("agency_id"), F.upper("c_name").alias("last_name"),
            F.col("c_nationkey").alias("nation")]
    p1 = c.where(F.col("c_custkey") % 4 != 3).select(*cols, nw.alias("net_worth"))
    p2 = c.where(F.col("c_custkey") % 4 != 1).select(
        *cols, (nw + F.when(F.col("c_custkey") % 5 == 0, 100).otherwise(0)).cast("decimal(15,2)")
        .alias("net_worth"))
    return p1, p2


@query("prospect_upsert", "WITH " + _PROSPECT_SQL + """
SELECT coalesce(a.agency_id, b.agency_id) AS agency_id,
       coalesce(b.last_name, a.last_name) AS last_name, coalesce(b.nation, a.nation) AS nation,
       CASE WHEN b.agency_id IS NOT NULL THEN b.net_worth ELSE a.net_worth END AS net_worth,
       CASE WHEN b.agency_id IS NOT NULL THEN DATE '2001-01-01' ELSE DATE '2000-01-01' END AS record_date,
       CASE WHEN a.agency_id IS NULL THEN DATE '2001-01-01'
            WHEN b.agency_id IS NOT NULL AND (a.last_name IS DISTINCT FROM b.last_name
              OR a.nation IS DISTINCT FROM b.nation OR a.net_worth IS DISTINCT FROM b.net_worth)
            THEN DATE '2001-01-01' ELSE DATE '2000-01-01' END AS update_date
FROM p1 a FULL OUTER JOIN p2 b ON a.agency_id = b.agency_id""")
def q_prospect_upsert(spark, sf_dir):
    """Prospect file of batch 2 against batch 1: record date moves for every
    row in the file, update date only when an attribute changed (null-safe);
    prospects absent from the new file stay as they are."""
    p1, p2 = prospect_files(spark, sf_dir)
    d1, d2 = F.lit("2000-01-01").cast("date"), F.lit("2001-01-01").cast("date")
    target = p1.withColumn("record_date", d1).withColumn("update_date", d1)
    changes = p2.withColumn("record_date", d2)
    return C.upsert_keep_first(target, changes, "agency_id", first_cols=[],
                               changed_cols=["last_name", "nation", "net_worth"],
                               stamp_col="update_date", stamp_value=d2) \
        .select("agency_id", "last_name", "nation", "net_worth", "record_date", "update_date")


# --- K7 watch upsert across surrogate versions -------------------------------------

_WATCH_SQL = "WITH " + _VER_SQL + f""",
vk AS (SELECT ver.*, row_number() OVER (ORDER BY o_custkey, effective_date) AS sk FROM ver),
first_sk AS (SELECT o_custkey, arg_min(sk, effective_date) AS sk FROM vk GROUP BY o_custkey),
cur_sk AS (SELECT o_custkey, sk FROM vk WHERE end_date = DATE '9999-12-31'),
w AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % (SELECT count(*) FROM part) AS symbol,
             ts, event_type, ts >= TIMESTAMP '{EVENT_SPLIT}' AS late
      FROM events WHERE event_type IN ('click', 'error')),
b AS (SELECT w.user_id, w.symbol, f.sk, min(ts) FILTER (WHERE event_type = 'click') AS placed,
             max(ts) FILTER (WHERE event_type = 'error') AS removed
      FROM w JOIN first_sk f ON w.user_id = f.o_custkey WHERE NOT late GROUP BY 1, 2, 3),
c AS (SELECT w.user_id, w.symbol, s.sk, min(ts) FILTER (WHERE event_type = 'click') AS placed,
             max(ts) FILTER (WHERE event_type = 'error') AS removed
      FROM w JOIN cur_sk s ON w.user_id = s.o_custkey WHERE late GROUP BY 1, 2, 3)"""


@query("watch_upsert", _WATCH_SQL + """
SELECT coalesce(b.user_id, c.user_id) AS user_id, coalesce(b.symbol, c.symbol) AS symbol,
       CAST(coalesce(c.sk, b.sk) AS BIGINT) AS sk_customer,
       coalesce(b.placed, c.placed) AS placed,
       coalesce(c.removed, b.removed) AS removed
FROM b FULL OUTER JOIN c ON b.user_id = c.user_id AND b.symbol = c.symbol""")
def q_watch_upsert(spark, sf_dir):
    """Watches stored under the surrogate of an old customer version are
    matched to batch-2 watch rows under the current surrogate: both sides
    resolve to the business key (equi joins), merge on (customer, symbol),
    first placement kept, latest removal wins.  No all-pairs of versions."""
    v = assign_keys(priority_versions(spark, sf_dir), ["o_custkey", "effective_date"], "sk")
    first_sk = v.groupBy("o_custkey").agg(F.min_by("sk", "effective_date").alias("sk"))
    cur_sk = v.where("is_current").select("o_custkey", "sk")
    parts = table(spark, sf_dir, "part").agg(F.count("*").alias("n")).scalar()
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "error")).select(
        "user_id", (F.get_json_object("props", "$.k").cast("long") % parts).alias("symbol"), "ts", "event_type")
    split = F.lit(EVENT_SPLIT).cast("timestamp_ntz")

    def watches(df):
        return df.groupBy("user_id", "symbol", "sk").agg(
            F.min(F.when(F.col("event_type") == "click", F.col("ts"))).alias("placed"),
            F.max(F.when(F.col("event_type") == "error", F.col("ts"))).alias("removed"))
    stored = watches(ev.where(F.col("ts") < split).join(
        first_sk, F.col("user_id") == F.col("o_custkey")).drop("o_custkey"))
    # K7: resolve stored surrogates back to business keys (equi join on sk)
    stored = stored.drop("user_id").join(v.select("sk", F.col("o_custkey").alias("user_id")), "sk")
    incoming = watches(ev.where(F.col("ts") >= split).join(
        cur_sk, F.col("user_id") == F.col("o_custkey")).drop("o_custkey"))
    b, c = stored.alias("b"), incoming.alias("c")
    j = b.join(c, (F.col("b.user_id") == F.col("c.user_id")) & (F.col("b.symbol") == F.col("c.symbol")),
               "full_outer")
    return j.select(F.coalesce("b.user_id", "c.user_id").alias("user_id"),
                    F.coalesce("b.symbol", "c.symbol").alias("symbol"),
                    F.coalesce("c.sk", "b.sk").alias("sk_customer"),
                    F.coalesce("b.placed", "c.placed").alias("placed"),
                    F.coalesce("c.removed", "b.removed").alias("removed"))
