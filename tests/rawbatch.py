"""Write raw batch folders from the driver tables with the shape adapter."""

import os

from pyspark.sql import functions as F

from histmart.plans import adapter as A
from histmart.plans import warehouse as W


def csv(df, path, sep="|"):
    (df.coalesce(1).write.option("sep", sep).option("header", "false")
       .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
       .option("dateFormat", "yyyy-MM-dd").csv(path))


def _xml(spark, sf, path, keep=None):
    lines = [r.value for r in A.action_xml(spark, sf).orderBy("seq").collect()]  # small fixture (sf0.001)
    with open(path, "w") as fh:
        fh.write('<?xml version="1.0" encoding="UTF-8"?>\n'
                 '<raw:Actions xmlns:raw="urn:raw">\n')
        for v in lines:
            if keep is not None and not keep(v):
                continue
            fh.write(v.replace("<Action ", "<raw:Action ").replace("</Action>", "</raw:Action>") + "\n")
        fh.write("</raw:Actions>\n")


def write_batch1(spark, sf, b, before=None, cash_before=None):
    """Historical batch; with ``before`` (yyyy-mm-dd) only actions and trade
    events before that day, with ``cash_before`` only cash before it."""
    os.makedirs(b)
    lo = A.table(spark, sf, "orders").agg(F.min(F.col("o_orderdate").cast("date")).alias("lo"))
    span = lo.select("lo", F.lit("2025-12-31").cast("date").alias("hi"))
    d = W.dim_date("lo", "hi", span)
    csv(d.select("sk_dateid", "date_value", "date_desc", "calendar_year_id",
                 F.col("calendar_year_id").cast("string"), "calendar_qtr_id", F.col("calendar_qtr_id").cast("string"),
                 "calendar_month_id", "calendar_month_desc", "calendar_week_id",
                 F.col("calendar_week_id").cast("string"), "day_of_week_num", "day_of_week_desc",
                 "fiscal_year_id", F.col("fiscal_year_id").cast("string"), "fiscal_qtr_id",
                 F.col("fiscal_qtr_id").cast("string"), "holiday_flag"), os.path.join(b, "Date.txt"))
    t = W.dim_time(spark)
    csv(t.select("sk_timeid", "time_value", "hour_id", F.col("hour_id").cast("string"), "minute_id",
                 F.col("minute_id").cast("string"), "second_id", F.col("second_id").cast("string"),
                 "market_hours_flag", "office_hours_flag"), os.path.join(b, "Time.txt"))
    csv(A.industries(spark, sf), os.path.join(b, "Industry.txt"))
    csv(W.status_types(spark), os.path.join(b, "StatusType.txt"))
    csv(W.trade_types(spark), os.path.join(b, "TradeType.txt"))
    csv(A.tax_rates(spark, sf), os.path.join(b, "TaxRate.txt"))
    csv(A.hr_records(spark, sf), os.path.join(b, "HR.csv"), sep=",")
    csv(A.prospect_records(spark, sf, 1 if before else None), os.path.join(b, "Prospect.csv"), sep=",")
    A.finwire_lines(spark, sf).coalesce(1).write.text(os.path.join(b, "FINWIRE1999Q1"))
    keep = None
    if before:
        keep = lambda v: v.split('ActionTS="', 1)[1][:10] < before
    _xml(spark, sf, os.path.join(b, "CustomerMgmt.xml"), keep)
    trades, hist = A.trade_records(spark, sf), A.trade_history(spark, sf)
    cash = A.cash_records(spark, sf)
    if before:
        cut = F.lit(before).cast("timestamp_ntz")
        hist = hist.where(F.col("TH_DTS") < cut)
        # the extract carries each trade's status as of the cut
        last = hist.groupBy("TH_T_ID").agg(F.max_by("TH_ST_ID", "TH_DTS").alias("__st"))
        trades = (trades.where(F.col("T_DTS") < cut).join(last, F.col("T_ID") == F.col("TH_T_ID"))
                  .withColumn("T_ST_ID", F.col("__st"))
                  .withColumn("T_TRADE_PRICE", F.when(F.col("__st") == "CMPT", F.col("T_TRADE_PRICE")))
                  .drop("TH_T_ID", "__st"))
    if cash_before:
        cash = cash.where(F.col("CT_DTS") < F.lit(cash_before).cast("timestamp_ntz"))
    csv(trades, os.path.join(b, "Trade.txt"))
    csv(hist, os.path.join(b, "TradeHistory.txt"))
    csv(cash, os.path.join(b, "CashTransaction.txt"))
    holdings, market, watches = A.holding_records(spark, sf), A.market_records(spark, sf), A.watch_records(spark, sf)
    if before:
        holdings = holdings.join(trades.select(F.col("T_ID").alias("HH_T_ID")), "HH_T_ID", "left_semi").select(*holdings.columns)
        market = market.where(F.col("DM_DATE") < F.lit(before).cast("date"))
    if cash_before:
        watches = watches.where(F.col("W_DTS") < F.lit(cash_before).cast("timestamp_ntz"))
    csv(holdings, os.path.join(b, "HoldingHistory.txt"))
    csv(market, os.path.join(b, "DailyMarket.txt"))
    csv(watches, os.path.join(b, "WatchHistory.txt"))
    with open(os.path.join(b, "BatchDate.txt"), "w") as fh:
        fh.write((before or "2000-01-01") + "\n")
