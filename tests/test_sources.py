"""Raw-file readers on hand-made fixtures shaped like the extracts."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import rows
from histmart.sources import readers as R
from histmart.sources import schemas as S

D = dt.date
T = dt.datetime


def _fw(values, layout):
    return "".join(str(values.get(name, "")).ljust(width)[:width] for name, width in layout)


def test_fixed_width_three_record_types(spark, tmp_path):
    cmp_ = "20200105-093000" + "CMP" + _fw({"CompanyName": "Acme Corp", "CIK": "0000000017", "Status": "ACTV",
                                              "IndustryID": "AB", "SPrating": "AA+", "FoundingDate": ""},
                                             S.FINWIRE_LAYOUTS["CMP"])
    fin = "20200410-060000" + "FIN" + _fw({"Year": "2020", "Quarter": "1", "QtrStartDate": "20200101",
                                             "PostingDate": "20200410", "Revenue": "1234.50", "EPS": "0.12",
                                             "CoNameOrCIK": "Acme Corp"}, S.FINWIRE_LAYOUTS["FIN"])
    sec = "20200601-120000" + "SEC" + _fw({"Symbol": "ACME", "IssueType": "COMMON", "Status": "ACTV",
                                             "Name": "Acme common", "Dividend": "1.50",
                                             "CoNameOrCIK": "0000000017"}, S.FINWIRE_LAYOUTS["SEC"])
    d = tmp_path / "finwire"
    d.mkdir()
    (d / "FINWIRE2020Q1").write_text(cmp_ + "\n" + fin + "\n")
    (d / "FINWIRE2020Q2").write_text(sec + "\n")
    (d / "FINWIRE2020Q1_audit.csv").write_text("not,a,finwire\n")
    parsed = R.read_fixed_width_lines(spark, str(d / "FINWIRE[0-9]*Q[1-4]"))
    c = R.fixed_width_records(parsed, "CMP").first()
    assert (c.PTS, c.CompanyName, c.CIK, c.SPrating, c.FoundingDate) == (
        T(2020, 1, 5, 9, 30), "Acme Corp", "0000000017", "AA+", "")
    f = R.fixed_width_records(parsed, "FIN").first()
    assert (f.Year, f.Quarter, f.Revenue, f.CoNameOrCIK) == ("2020", "1", "1234.50", "Acme Corp")
    s = R.fixed_width_records(parsed, "SEC").first()
    assert (s.Symbol, s.Dividend, s.CoNameOrCIK) == ("ACME", "1.50", "0000000017")
    assert parsed.count() == 3


XML = """<?xml version="1.0" encoding="UTF-8"?>
<raw:Actions xmlns:raw="urn:raw">
<raw:Action ActionType="NEW" ActionTS="2007-07-07T04:00:00">
  <Customer C_ID="0" C_TAX_ID="923-54-6498" C_GNDR="F" C_TIER="3" C_DOB="1940-12-02">
    <Name><C_L_NAME>Joannis</C_L_NAME><C_F_NAME>Adara</C_F_NAME><C_M_NAME/></Name>
    <Address><C_ADLINE1>4779 Weller Way</C_ADLINE1><C_ADLINE2/><C_ZIPCODE>92624</C_ZIPCODE>
      <C_CITY>Columbus</C_CITY><C_STATE_PROV>Ontario</C_STATE_PROV><C_CTRY>Canada</C_CTRY></Address>
    <ContactInfo><C_PRIM_EMAIL>Adara.Joannis@moose-mail.com</C_PRIM_EMAIL><C_ALT_EMAIL/>
      <C_PHONE_1><C_CTRY_CODE>1</C_CTRY_CODE><C_AREA_CODE>872</C_AREA_CODE><C_LOCAL>523-8928</C_LOCAL><C_EXT/></C_PHONE_1>
    </ContactInfo>
    <TaxInfo><C_LCL_TX_ID>CA3</C_LCL_TX_ID><C_NAT_TX_ID>YT3</C_NAT_TX_ID></TaxInfo>
    <Account CA_ID="0" CA_TAX_ST="1"><CA_B_ID>17713</CA_B_ID><CA_NAME>CJlmMuFyibKOmKLHIaTeWugvCgZdmcfpDsYb</CA_NAME></Account>
    <Account CA_ID="1" CA_TAX_ST="2"><CA_B_ID>615</CA_B_ID><CA_NAME/></Account>
  </Customer>
</raw:Action>
<raw:Action ActionType="UPDCUST" ActionTS="2007-07-08T05:00:00">
  <Customer C_ID="0" C_TIER="2">
    <ContactInfo><C_ALT_EMAIL>a@b.com</C_ALT_EMAIL></ContactInfo>
  </Customer>
</raw:Action>
</raw:Actions>
"""


def test_xml_actions_absent_vs_empty_and_accounts(spark, tmp_path):
    p = tmp_path / "CustomerMgmt.xml"
    p.write_text(XML)
    a = R.read_actions(spark, str(p), "raw:Action")
    got = {r._ActionType: r for r in a.collect()}
    new, upd = got["NEW"], got["UPDCUST"]
    assert new._ActionTS == T(2007, 7, 7, 4)
    assert new.Customer._C_TIER == 3 and new.Customer._C_DOB == D(1940, 12, 2)
    assert new.Customer.Name.C_M_NAME == ""                 # empty element
    assert upd.Customer.Name is None                        # absent element
    assert upd.Customer.ContactInfo.C_PRIM_EMAIL is None and upd.Customer.ContactInfo.C_ALT_EMAIL == "a@b.com"
    acc = R.explode_accounts(a)
    assert rows(acc, "CA_ID", "CA_B_ID", "CA_NAME") == [(0, 17713, "CJlmMuFyibKOmKLHIaTeWugvCgZdmcfpDsYb"),
                                                        (1, 615, "")]


def test_cdc_file_and_batch_date(spark, tmp_path):
    p = tmp_path / "Account.txt"
    p.write_text("I|5|100|7|1|acct a|1|ACTV\nU|3|100|7|1|acct old||ACTV\nU|9|101|8|2||2|INAC\n")
    df = R.read_cdc(spark, str(p), S.ACCOUNT_CDC)
    assert rows(df, "CDC_FLAG", "CDC_DSN", "CA_ID", "CA_NAME", "CA_TAX_ST") == [
        ("I", 5, 100, "acct a", 1), ("U", 3, 100, "acct old", None), ("U", 9, 101, None, 2)]
    b = tmp_path / "BatchDate.txt"
    b.write_text("2017-07-08\n")
    assert R.read_batch_date(spark, str(b)) == D(2017, 7, 8)


def test_delimited_reference_file(spark, tmp_path):
    p = tmp_path / "TaxRate.txt"
    p.write_text("US1|U.S. Income Tax Bracket for the poor|0.15000\nCA1|Canadian Tax|0.10500\n")
    df = R.read_delimited(spark, str(p), S.TAX_RATE)
    assert rows(df, "TX_ID") == [("CA1",), ("US1",)]
    assert str(df.where("TX_ID = 'CA1'").first().TX_RATE) == "0.10500"


def test_audit_csv_padded_headers(spark, tmp_path):
    d = tmp_path / "audit"
    d.mkdir()
    (d / "Batch1_audit.csv").write_text(
        "DataSet , BatchID , Date , Attribute , Value , DValue\n"
        "DimCustomer,1,2017-07-07,C_NEW,120,\nDimTrade,1,,T_NEW,5,12.50000\n")
    (d / "Generator_audit.csv").write_text(
        "DataSet,BatchID,Date,Attribute,Value,DValue\nGenerator,0,,ScaleFactor,3,\n")
    df = R.read_audit(spark, str(d / "*_audit*.csv"))
    assert df.columns == [f.name for f in S.AUDIT.fields]
    got = {(r.DataSet, r.Attribute): (r.BatchID, r.Value, r.DValue) for r in df.collect()}
    assert got[("DimCustomer", "C_NEW")][:2] == (1, 120)
    assert str(got[("DimTrade", "T_NEW")][2]) == "12.50000"
    assert got[("Generator", "ScaleFactor")][1] == 3


def test_change_batches_stream_through_foreach_batch(spark, tmp_path):
    # Batch 2 then batch 3 arrive as CDC files; each micro-batch is merged
    # into the last complete version and written as the next version
    from histmart.operators.cdc import cdc_upsert
    from histmart.sources import sinks
    from histmart.streaming import apply_change_batches

    src = tmp_path / "incoming"
    src.mkdir()
    table = str(tmp_path / "account")
    base = spark.createDataFrame([(100, "acct a", "ACTV")], "CA_ID long, CA_NAME string, CA_ST_ID string")
    sinks.write_version(base, table, 1)

    def merge(current, changes, batch_id):
        ch = changes.select("CA_ID", "CA_NAME", "CA_ST_ID", "CDC_DSN")
        return cdc_upsert(current, ch, "CA_ID", order=["CDC_DSN"])

    (src / "Batch2").mkdir()
    (src / "Batch3").mkdir()
    # batch 2 split over two files, batch 3 in one; all land in one micro-batch
    (src / "Batch2" / "Account_a.txt").write_text("U|1|100|7|1|renamed|1|ACTV\n")
    (src / "Batch2" / "Account_b.txt").write_text("I|2|101|8|2|new acct|2|ACTV\n")
    (src / "Batch3" / "Account.txt").write_text("U|4|101|8|2|closed|2|INAC\n")
    written = apply_change_batches(spark, str(src), S.ACCOUNT_CDC, table, merge, query_name=f"acct{os.getpid()}")
    assert written == [2, 3]
    # a second run finds the batches committed and writes nothing
    assert apply_change_batches(spark, str(src), S.ACCOUNT_CDC, table, merge,
                                query_name=f"acct{os.getpid()}b") == []
    assert sinks.complete_versions(spark, table) == [1, 2, 3]
    latest = sinks.read_latest(spark, table)
    assert rows(latest, "CA_ID", "CA_NAME", "CA_ST_ID") == [(100, "renamed", "ACTV"), (101, "closed", "INAC")]
    v2 = spark.read.parquet(sinks.version_path(table, 2))
    assert rows(v2, "CA_ID", "CA_ST_ID") == [(100, "ACTV"), (101, "ACTV")]
    # a late file of batch 2: it and the batch after it are merged again
    (src / "Batch2" / "Account_c.txt").write_text("I|3|102|8|2|late acct|2|ACTV\n")
    assert apply_change_batches(spark, str(src), S.ACCOUNT_CDC, table, merge, query_name=f"acct{os.getpid()}") == [2, 3]
    assert rows(sinks.read_latest(spark, table), "CA_ID", "CA_ST_ID") == [(100, "ACTV"), (101, "INAC"), (102, "ACTV")]


def test_stream_keeps_every_file_of_a_batch(spark, tmp_path):
    # one file a micro-batch: both files of batch 2 count, whatever their order
    from histmart.operators.cdc import cdc_upsert
    from histmart.sources import sinks
    from histmart.streaming import apply_change_batches

    src, table = tmp_path / "incoming", str(tmp_path / "account")
    (src / "Batch2").mkdir(parents=True)
    sinks.write_version(spark.createDataFrame([(100, "acct a", "ACTV")], "CA_ID long, CA_NAME string, CA_ST_ID string"), table, 1)
    (src / "Batch2" / "Account_a.txt").write_text("U|1|100|7|1|renamed|1|ACTV\n")
    (src / "Batch2" / "Account_b.txt").write_text("I|2|101|8|2|new acct|2|ACTV\n")

    def merge(current, changes, batch_id):
        return cdc_upsert(current, changes.select("CA_ID", "CA_NAME", "CA_ST_ID", "CDC_DSN"), "CA_ID", order=["CDC_DSN"])

    apply_change_batches(spark, str(src), S.ACCOUNT_CDC, table, merge, query_name=f"one{os.getpid()}", files_per_batch=1)
    assert rows(sinks.read_latest(spark, table), "CA_ID", "CA_NAME") == [(100, "renamed"), (101, "new acct")]


def test_one_xml_file_is_split_over_tasks(spark, tmp_path):
    p = tmp_path / "CustomerMgmt.xml"
    one = '<raw:Action ActionType="NEW" ActionTS="2007-07-07T04:00:00"><Customer C_ID="{}"><Name><C_L_NAME>{}</C_L_NAME></Name></Customer></raw:Action>\n'
    p.write_text('<raw:Actions xmlns:raw="urn:raw">\n' + "".join(one.format(i, "n" * 400) for i in range(3000)) + "</raw:Actions>\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    spark.conf.set("spark.sql.files.openCostInBytes", "10k")
    try:
        a = R.read_actions(spark, str(p), "raw:Action")
        assert a.rdd.getNumPartitions() > 1
        assert sorted(r.id for r in a.select(F.col("Customer._C_ID").alias("id")).collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_cash_flag_is_a_number_in_the_file(spark, tmp_path):
    p = tmp_path / "Trade.txt"
    p.write_text("1|2020-01-01 09:00:00|CMPT|TMB|1|S|5|1.00|7|x|1.00|0|0|0\n2|2020-01-01 09:00:00|CMPT|TMB|0|S|5|1.00|7|x|1.00|0|0|0\n")
    assert rows(R.read_delimited(spark, str(p), S.TRADE), "T_ID", "T_IS_CASH") == [(1, 1), (2, 0)]


def test_malformed_rows_are_rejects(spark, tmp_path):
    from histmart.plans.pipeline import rejected_rows

    (tmp_path / "TaxRate.txt").write_text("A|First|0.25\nB|Second|many\nC|short\n|Null id|0.5\nD|long|0.1|more\nE|Last|0.2\n")
    (tmp_path / "HoldingHistory.txt").write_text("1|2|3|4\n1|2|x|4\n5|6||8\n")
    (tmp_path / "StatusType.txt").write_text("")
    files = R.BatchFiles(spark, str(tmp_path))
    tax = files.read("TaxRate.txt", S.TAX_RATE)
    held = files.read("HoldingHistory.txt", S.HOLDING_HISTORY)
    assert files.read("StatusType.txt", S.STATUS_TYPE).collect() == []
    assert rows(tax, "TX_ID", "TX_NAME") == [(None, "Null id"), ("A", "First"), ("E", "Last")]
    assert rows(held) == [(1, 2, 3, 4), (5, 6, None, 8)]
    rejects = files.rejects().withColumn("batch_id", F.lit(3))
    assert rows(rejects, "file", "record") == [("HoldingHistory.txt", "1|2|x|4"), ("TaxRate.txt", "B|Second|many"), ("TaxRate.txt", "C|short"), ("TaxRate.txt", "D|long|0.1|more")]
    assert rows(rejected_rows(rejects, 3), "message_source", "message_data") == [("HoldingHistory.txt", "1"), ("TaxRate.txt", "3")]
