"""Explicit schemas of the raw brokerage extracts; never ``inferSchema``."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DecimalType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)


def _s(*fields) -> StructType:
    out = []
    for f in fields:
        name, typ = f.split(":")
        out.append(StructField(name, _TYPES[typ], True))
    return StructType(out)


_TYPES = {
    "long": LongType(), "int": IntegerType(), "str": StringType(), "date": DateType(),
    "ts": TimestampType(), "bool": BooleanType(),
    "d38_0": DecimalType(38, 0), "d6_5": DecimalType(6, 5), "d8_2": DecimalType(8, 2), "d10_2": DecimalType(10, 2),
    "d15_2": DecimalType(15, 2), "d16_5": DecimalType(16, 5),
}

CDC_PREFIX = ("CDC_FLAG:str", "CDC_DSN:d38_0")

DATE = _s("SK_DateID:long", "DateValue:date", "DateDesc:str", "CalendarYearID:int",
          "CalendarYearDesc:str", "CalendarQtrID:int", "CalendarQtrDesc:str", "CalendarMonthID:int",
          "CalendarMonthDesc:str", "CalendarWeekID:int", "CalendarWeekDesc:str", "DayOfWeekNum:int",
          "DayOfWeekDesc:str", "FiscalYearID:int", "FiscalYearDesc:str", "FiscalQtrID:int",
          "FiscalQtrDesc:str", "HolidayFlag:bool")
TIME = _s("SK_TimeID:long", "TimeValue:str", "HourID:int", "HourDesc:str", "MinuteID:int",
          "MinuteDesc:str", "SecondID:int", "SecondDesc:str", "MarketHoursFlag:bool",
          "OfficeHoursFlag:bool")
INDUSTRY = _s("IN_ID:str", "IN_NAME:str", "IN_SC_ID:str")
STATUS_TYPE = _s("ST_ID:str", "ST_NAME:str")
TRADE_TYPE = _s("TT_ID:str", "TT_NAME:str", "TT_IS_SELL:int", "TT_IS_MRKT:int")
TAX_RATE = _s("TX_ID:str", "TX_NAME:str", "TX_RATE:d6_5")
HR = _s("EmployeeID:long", "ManagerID:long", "EmployeeFirstName:str", "EmployeeLastName:str",
        "EmployeeMI:str", "EmployeeJobCode:int", "EmployeeBranch:str", "EmployeeOffice:str",
        "EmployeePhone:str")
PROSPECT = _s("AgencyID:str", "LastName:str", "FirstName:str", "MiddleInitial:str", "Gender:str",
              "AddressLine1:str", "AddressLine2:str", "PostalCode:str", "City:str", "State:str",
              "Country:str", "Phone:str", "Income:long", "NumberCars:int", "NumberChildren:int",
              "MaritalStatus:str", "Age:int", "CreditRating:int", "OwnOrRentFlag:str", "Employer:str",
              "NumberCreditCards:int", "NetWorth:long")
TRADE_FIELDS = ("T_ID:long", "T_DTS:ts", "T_ST_ID:str", "T_TT_ID:str", "T_IS_CASH:int",
                "T_S_SYMB:str", "T_QTY:int", "T_BID_PRICE:d8_2", "T_CA_ID:long", "T_EXEC_NAME:str",
                "T_TRADE_PRICE:d8_2", "T_CHRG:d10_2", "T_COMM:d10_2", "T_TAX:d10_2")
TRADE = _s(*TRADE_FIELDS)
TRADE_HISTORY = _s("TH_T_ID:long", "TH_DTS:ts", "TH_ST_ID:str")
CASH_FIELDS = ("CT_CA_ID:long", "CT_DTS:ts", "CT_AMT:d15_2", "CT_NAME:str")
CASH_TRANSACTION = _s(*CASH_FIELDS)
HOLDING_FIELDS = ("HH_H_T_ID:long", "HH_T_ID:long", "HH_BEFORE_QTY:int", "HH_AFTER_QTY:int")
HOLDING_HISTORY = _s(*HOLDING_FIELDS)
MARKET_FIELDS = ("DM_DATE:date", "DM_S_SYMB:str", "DM_CLOSE:d8_2", "DM_HIGH:d8_2", "DM_LOW:d8_2",
                 "DM_VOL:long")
DAILY_MARKET = _s(*MARKET_FIELDS)
WATCH_FIELDS = ("W_C_ID:long", "W_S_SYMB:str", "W_DTS:ts", "W_ACTION:str")
WATCH_HISTORY = _s(*WATCH_FIELDS)

CUSTOMER_CDC = _s(*CDC_PREFIX, "C_ID:long", "C_TAX_ID:str", "C_ST_ID:str", "C_L_NAME:str",
                  "C_F_NAME:str", "C_M_NAME:str", "C_GNDR:str", "C_TIER:int", "C_DOB:date",
                  "C_ADLINE1:str", "C_ADLINE2:str", "C_ZIPCODE:str", "C_CITY:str", "C_STATE_PROV:str",
                  "C_CTRY:str",
                  *[f"{p}_{n}:str" for n in (1, 2, 3) for p in ("C_CTRY", "C_AREA", "C_LOCAL", "C_EXT")],
                  "C_EMAIL_1:str", "C_EMAIL_2:str", "C_LCL_TX_ID:str", "C_NAT_TX_ID:str")
ACCOUNT_CDC = _s(*CDC_PREFIX, "CA_ID:long", "CA_B_ID:long", "CA_C_ID:long", "CA_NAME:str",
                 "CA_TAX_ST:int", "CA_ST_ID:str")
TRADE_CDC = _s(*CDC_PREFIX, *TRADE_FIELDS)
CASH_CDC = _s(*CDC_PREFIX, *CASH_FIELDS)
HOLDING_CDC = _s(*CDC_PREFIX, *HOLDING_FIELDS)
MARKET_CDC = _s(*CDC_PREFIX, *MARKET_FIELDS)
WATCH_CDC = _s(*CDC_PREFIX, *WATCH_FIELDS)

AUDIT = _s("DataSet:str", "BatchID:int", "Date:date", "Attribute:str", "Value:long", "DValue:d16_5")

# Fixed-width FINWIRE layouts, (field, width) in record order
# after the common prefix PTS (15) and RecType (3).
FINWIRE_PREFIX = (("PTS", 15), ("RecType", 3))
FINWIRE_LAYOUTS = {
    "CMP": (("CompanyName", 60), ("CIK", 10), ("Status", 4), ("IndustryID", 2),
            ("SPrating", 4), ("FoundingDate", 8), ("AddrLine1", 80), ("AddrLine2", 80),
            ("PostalCode", 12), ("City", 25), ("StateProvince", 20), ("Country", 24),
            ("CEOname", 46), ("Description", 150)),
    "FIN": (("Year", 4), ("Quarter", 1), ("QtrStartDate", 8), ("PostingDate", 8),
            ("Revenue", 17), ("Earnings", 17), ("EPS", 12), ("DilutedEPS", 12), ("Margin", 12),
            ("Inventory", 17), ("Assets", 17), ("Liabilities", 17), ("ShOut", 13),
            ("DilutedShOut", 13), ("CoNameOrCIK", 60)),
    "SEC": (("Symbol", 15), ("IssueType", 6), ("Status", 4), ("Name", 70), ("ExID", 6),
            ("ShOut", 13), ("FirstTradeDate", 8), ("FirstTradeExchg", 8), ("Dividend", 12),
            ("CoNameOrCIK", 60)),
}

PHONE = StructType([StructField(n, StringType(), True)
                    for n in ("C_CTRY_CODE", "C_AREA_CODE", "C_LOCAL", "C_EXT")])
ACTION_ACCOUNT = StructType([
    StructField("_CA_ID", LongType(), True), StructField("_CA_TAX_ST", IntegerType(), True),
    StructField("CA_B_ID", LongType(), True), StructField("CA_NAME", StringType(), True)])
ACTION_CUSTOMER = StructType([
    StructField("_C_ID", LongType(), True), StructField("_C_TAX_ID", StringType(), True),
    StructField("_C_GNDR", StringType(), True), StructField("_C_TIER", IntegerType(), True),
    StructField("_C_DOB", DateType(), True),
    StructField("Name", StructType([StructField(n, StringType(), True)
                                    for n in ("C_L_NAME", "C_F_NAME", "C_M_NAME")]), True),
    StructField("Address", StructType([StructField(n, StringType(), True) for n in (
        "C_ADLINE1", "C_ADLINE2", "C_ZIPCODE", "C_CITY", "C_STATE_PROV", "C_CTRY")]), True),
    StructField("ContactInfo", StructType([
        StructField("C_PRIM_EMAIL", StringType(), True), StructField("C_ALT_EMAIL", StringType(), True),
        StructField("C_PHONE_1", PHONE, True), StructField("C_PHONE_2", PHONE, True),
        StructField("C_PHONE_3", PHONE, True)]), True),
    StructField("TaxInfo", StructType([StructField(n, StringType(), True)
                                       for n in ("C_LCL_TX_ID", "C_NAT_TX_ID")]), True),
    StructField("Account", ArrayType(ACTION_ACCOUNT), True),
])
ACTION = StructType([
    StructField("_ActionType", StringType(), True),
    StructField("_ActionTS", TimestampType(), True),
    StructField("Customer", ACTION_CUSTOMER, True),
])
