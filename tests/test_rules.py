"""Semantic rulings of SURVEY 3.5 on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from histmart.plans import warehouse as W
from histmart.sources import readers as R

D = dt.date
T = dt.datetime
EOT = D(9999, 12, 31)


def _action(kind, ts, cid, order, tier=None, name=None):
    tier_attr = f' C_TIER="{tier}"' if tier is not None else ""
    name_el = f"<Name><C_L_NAME>{name}</C_L_NAME></Name>" if name is not None else ""
    return (f'<Action ActionType="{kind}" ActionTS="{ts}"><Customer C_ID="{cid}"{tier_attr}>{name_el}'
            f"<TaxInfo><C_LCL_TX_ID>{order}</C_LCL_TX_ID></TaxInfo></Customer></Action>")


def _taxes(spark):
    return spark.createDataFrame([("N1", "Nation", "0.25"), ("L1", "Local", "0.05")], "TX_ID string, TX_NAME string, TX_RATE string").withColumn(
        "TX_RATE", F.col("TX_RATE").cast("decimal(6,5)"))


def _prospects(spark, rows_):
    from histmart.sources import schemas as S

    names = [f.name for f in S.PROSPECT.fields]
    return W.prospect_rows(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows_], S.PROSPECT))


def _parsed(spark, lines):
    return R.parse_actions(spark.createDataFrame(list(enumerate(lines)), "seq long, value string"), "value", "seq")


def test_customer_attributes_phones_taxes_and_match(spark):
    new = ('<Action ActionType="NEW" ActionTS="2020-01-01T10:00:00"><Customer C_ID="7" C_TAX_ID="T-7" C_GNDR="f" C_TIER="2" C_DOB="1980-05-06">'
           "<Name><C_L_NAME>Ng</C_L_NAME><C_F_NAME>Ann</C_F_NAME><C_M_NAME>Q</C_M_NAME></Name>"
           "<Address><C_ADLINE1>Street 1</C_ADLINE1><C_ADLINE2></C_ADLINE2><C_ZIPCODE>00001</C_ZIPCODE></Address>"
           "<ContactInfo><C_PRIM_EMAIL>a@b.c</C_PRIM_EMAIL><C_PHONE_1><C_CTRY_CODE>1</C_CTRY_CODE><C_AREA_CODE>200</C_AREA_CODE>"
           "<C_LOCAL>555</C_LOCAL><C_EXT>9</C_EXT></C_PHONE_1></ContactInfo>"
           "<TaxInfo><C_LCL_TX_ID>L1</C_LCL_TX_ID><C_NAT_TX_ID>N1</C_NAT_TX_ID></TaxInfo></Customer></Action>")
    update = ('<Action ActionType="UPDCUST" ActionTS="2020-02-01T10:00:00"><Customer C_ID="7"><Name><C_M_NAME></C_M_NAME></Name>'
              "<TaxInfo><C_LCL_TX_ID>none such</C_LCL_TX_ID></TaxInfo></Customer></Action>")
    person = {"LastName": "NG", "FirstName": "ann", "AddressLine1": "STREET 1", "PostalCode": "00001", "NetWorth": 2000000, "Income": 1, "Age": 50}
    prospects = _prospects(spark, [person | {"AgencyID": "A1"}, person | {"AgencyID": "A2", "CreditRating": 700}, person | {"AgencyID": "B", "LastName": "Other"}])
    first, last = sorted(W.dim_customer(_parsed(spark, [new, update]), _taxes(spark), prospects).collect(), key=lambda r: r.effective_date)
    assert (first.tax_id, first.gender, first.middle_initial, first.phone1, first.phone2, first.dob) == ("T-7", "F", "Q", "+1 (200) 5559", None, D(1980, 5, 6))
    assert (first.national_tax_rate_desc, str(first.national_tax_rate), first.local_tax_rate_desc) == ("Nation", "0.25000", "Local")
    assert first.agency_id is None  # only the current version is matched (D1)
    assert (last.middle_initial, last.phone1, last.email1, last.local_tax_rate, last.national_tax_rate_desc) == (None, "+1 (200) 5559", "a@b.c", None, "Nation")
    assert (last.agency_id, last.credit_rating, last.net_worth, last.marketing_nameplate) == ("A2", 700, 2000000, "HighValue+Boomer+MoneyAlert")


def test_earlier_prospects_go_first(spark):
    who = {"LastName": "Ng", "FirstName": "Ann"}
    people = spark.createDataFrame([(1, "Ann", "NG"), (2, "Bo", "Li"), (3, None, None)], "customer_id long, first_name string, last_name string").selectExpr(
        "*", "CAST(NULL AS STRING) AS address_line1", "CAST(NULL AS STRING) AS address_line2", "CAST(NULL AS STRING) AS postal_code")
    earlier = _prospects(spark, [who | {"AgencyID": "E", "CreditRating": 1}])
    batch = _prospects(spark, [who | {"AgencyID": "Z", "CreditRating": 2}, {"LastName": "Li", "FirstName": "Bo", "AgencyID": "Y"}])
    got = W.match_prospects(people, earlier, batch)
    assert rows(got, "customer_id", "agency_id", "credit_rating") == [(1, "E", 1), (2, "Y", None), (3, None, None)]


def _accounts(kind, ts, cid, *accounts):
    inner = "".join(f'<Account CA_ID="{a}"' + (f' CA_TAX_ST="{t}"' if t else "") + ">" + (f"<CA_B_ID>{b}</CA_B_ID>" if b else "")
                    + (f"<CA_NAME>{n}</CA_NAME>" if n is not None else "") + "</Account>" for a, t, b, n in accounts)
    return f'<Action ActionType="{kind}" ActionTS="{ts}"><Customer C_ID="{cid}">{inner}</Customer></Action>'


def test_accounts_follow_all_six_actions(spark):
    lines = [_accounts("NEW", "2020-01-01T09:00:00", 7, (70, 1, 5, "First"), (71, 2, 5, "Second")),
             _accounts("UPDACCT", "2020-02-01T09:00:00", 7, (70, None, 6, None)),
             _accounts("CLOSEACCT", "2020-03-01T09:00:00", 7, (71, None, None, None)),
             _accounts("UPDCUST", "2020-04-01T09:00:00", 7),
             _accounts("ADDACCT", "2020-05-01T08:00:00", 7, (72, 1, 5, "Third")),
             _accounts("UPDACCT", "2020-05-01T09:00:00", 7, (72, None, None, "Renamed")),
             _accounts("UPDACCT", "2020-05-01T09:00:00", 7, (72, None, None, "Renamed last")),  # same second: file order decides
             _accounts("INACT", "2020-06-01T09:00:00", 7)]
    actions = _parsed(spark, lines)
    broker = spark.createDataFrame([(5, 50, D(2020, 1, 1), EOT), (6, 60, D(2020, 1, 1), EOT)], "broker_id long, sk_brokerid long, effective_date date, end_date date")
    customer = W.dim_customer(actions, _taxes(spark), _prospects(spark, []))
    got = rows(W.dim_account(actions, customer, broker), "account_id", "effective_date", "status", "account_desc", "sk_brokerid", "sk_customerid", "tax_status")
    assert got == [
        (70, D(2020, 1, 1), "ACTIVE", "First", 50, 1, 1), (70, D(2020, 2, 1), "ACTIVE", "First", 60, 1, 1),
        (70, D(2020, 4, 1), "ACTIVE", "First", 60, 2, 1), (70, D(2020, 6, 1), "INACTIVE", "First", 60, 3, 1),
        (71, D(2020, 1, 1), "ACTIVE", "Second", 50, 1, 2), (71, D(2020, 3, 1), "INACTIVE", "Second", 50, 1, 2),
        (71, D(2020, 4, 1), "INACTIVE", "Second", 50, 2, 2), (71, D(2020, 6, 1), "INACTIVE", "Second", 50, 3, 2),
        (72, D(2020, 5, 1), "ACTIVE", "Renamed last", 50, 2, 1), (72, D(2020, 6, 1), "INACTIVE", "Renamed last", 50, 3, 1)]


def test_d2_actions_apply_in_time_order(spark):
    # INACT before a later UPDCUST: the update changes the name, the customer stays inactive
    lines = [_action("NEW", "2020-01-01T10:00:00", 7, 1, tier=1, name="Ann"),
             _action("INACT", "2020-02-01T10:00:00", 7, 2),
             _action("UPDCUST", "2020-03-01T10:00:00", 7, 3, name="Anna")]
    acts = R.parse_actions(spark.createDataFrame(list(enumerate(lines)), "seq long, value string"), "value", "seq")
    v = W.dim_customer(acts, _taxes(spark), _prospects(spark, []))
    assert rows(v, "effective_date", "status", "last_name", "tier", "end_date") == [
        (D(2020, 1, 1), "ACTIVE", "Ann", 1, D(2020, 2, 1)),
        (D(2020, 2, 1), "INACTIVE", "Ann", 1, D(2020, 3, 1)),
        (D(2020, 3, 1), "INACTIVE", "Anna", 1, EOT)]


def test_d24_watch_replaced_after_cancel(spark):
    w = spark.createDataFrame([
        (7, "S1", T(2020, 1, 5, 9), "ACTV"), (7, "S1", T(2020, 2, 1, 9), "CNCL"),
        (7, "S1", T(2020, 3, 1, 9), "ACTV"), (7, "S1", T(2020, 4, 1, 9), "CNCL"),
        (7, "S2", T(2020, 1, 9, 9), "ACTV")], "W_C_ID long, W_S_SYMB string, W_DTS timestamp, W_ACTION string")
    cust = spark.createDataFrame([(7, 70, D(2019, 1, 1), EOT)],
                                 "customer_id long, sk_customerid long, effective_date date, end_date date")
    sec = spark.createDataFrame([("S1", 1, D(2019, 1, 1), EOT), ("S2", 2, D(2019, 1, 1), EOT)],
                                "symbol string, sk_securityid long, effective_date date, end_date date")
    out = W.fact_watches(w, cust, sec)
    assert rows(out, "sk_securityid", "sk_dateid_dateplaced", "sk_dateid_dateremoved") == [
        (1, 20200105, 20200401), (2, 20200109, None)]


def test_d19_pe_uses_company_id_across_versions(spark):
    # the security points at an old company version; EPS was posted under a newer one
    company = spark.createDataFrame([(10, 5, D(2019, 1, 1), D(2020, 1, 1)), (11, 5, D(2020, 1, 1), EOT)],
                                    "sk_companyid long, company_id long, effective_date date, end_date date")
    financial = spark.createDataFrame(
        [(11, D(2020, 1, 1), 1.0), (11, D(2020, 4, 1), 1.0), (11, D(2020, 7, 1), 1.5), (11, D(2020, 10, 1), 0.5)],
        "sk_companyid long, fi_qtr_start_date date, fi_basic_eps double").withColumn(
        "fi_basic_eps", F.col("fi_basic_eps").cast("decimal(10,2)"))
    security = spark.createDataFrame([("S", 100, 10, 2.0, D(2019, 1, 1), EOT)],
                                     "symbol string, sk_securityid long, sk_companyid long, dividend double, "
                                     "effective_date date, end_date date")
    # the quarter starting in [day - 3 months, day) is 2020-10-01, whose trailing four quarters sum to 4.0
    market = spark.createDataFrame([(D(2020, 11, 15), "S", 20.0, 21.0, 19.0, 100)],
                                   "DM_DATE date, DM_S_SYMB string, DM_CLOSE double, DM_HIGH double, DM_LOW double, "
                                   "DM_VOL long")
    r = W.fact_market(market, security, company, financial).first()
    assert r.pe_ratio == 5.0 and r["yield"] == 10.0
