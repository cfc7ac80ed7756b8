"""Column-expression helpers: normalisation, blanks, phones, tags, parsing.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; nothing is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 22 valid S&P ratings, best first.
VALID_SP_RATINGS = (
    "AAA", "AA+", "AA", "AA-", "A+", "A", "A-",
    "BBB+", "BBB", "BBB-", "BB+", "BB", "BB-",
    "B+", "B", "B-", "CCC+", "CCC", "CCC-", "CC", "C", "D",
)

# Code domains and their default for out-of-domain input.
GENDER_CODES = ("M", "F")
MARITAL_CODES = ("S", "M", "D", "W")
OWN_RENT_CODES = ("O", "R")
UNKNOWN_CODE = "U"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c) -> Column:
    """Non-null and non-empty: the truthiness test used for text fields."""
    c = _c(c)
    return c.isNotNull() & (c != F.lit(""))


def normalise_code(c, allowed: Iterable[str], default: str = UNKNOWN_CODE) -> Column:
    """Upper-case ``c``; anything outside ``allowed`` (or null) becomes ``default``."""
    up = F.upper(_c(c))
    return F.when(up.isin(*allowed), up).otherwise(F.lit(default))


def blank_to_null(c) -> Column:
    """Text that is empty or only white space becomes null."""
    c = _c(c)
    return F.when(F.trim(c) == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def null_to_empty(c) -> Column:
    return F.coalesce(_c(c), F.lit(""))


def blanks_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: blank_to_null(c) for c in cols})


def format_phone(ctry, area, local, ext) -> Column:
    """``+c (a) l``, ``(a) l`` or ``l`` by which parts are present; extension
    appended; null when there is no local number."""
    ctry, area, local, ext = map(_c, (ctry, area, local, ext))
    base = (
        F.when(present(ctry) & present(area) & present(local),
               F.concat(F.lit("+"), ctry, F.lit(" ("), area, F.lit(") "), local))
        .when(present(area) & present(local), F.concat(F.lit("("), area, F.lit(") "), local))
        .when(present(local), local)
    )
    return F.when(present(ext), F.concat(base, ext)).otherwise(base)


def nameplate_tags(net_worth, income, children, credit_cards, age,
                   credit_rating, cars) -> Column:
    """Marketing tags joined by ``+``; null when no rule fires.

    Each rule only fires when every input it reads is non-null.
    """
    nw, inc, ch, cc, age, cr, cars = map(
        _c, (net_worth, income, children, credit_cards, age, credit_rating, cars))

    def nn(*cs):
        out = F.lit(True)
        for x in cs:
            out = out & x.isNotNull()
        return out

    # Tag names and thresholds.
    rules = [
        ("HighValue", nn(nw, inc) & ((nw > 1_000_000) | (inc > 200_000))),
        ("Expenses", nn(ch, cc) & ((ch > 3) | (cc > 5))),
        ("Boomer", nn(age) & (age > 45)),
        ("MoneyAlert", nn(inc, cr, nw) & ((inc < 50_000) | (cr < 600) | (nw < 100_000))),
        ("Spender", nn(cars, cc) & ((cars > 3) | (cc > 7))),
        ("Inherited", nn(age, nw) & (age < 25) & (nw > 1_000_000)),
    ]
    joined = F.concat_ws("+", *[F.when(cond, F.lit(tag)) for tag, cond in rules])
    return F.nullif(joined, F.lit(""))


def low_grade(rating) -> Column:
    """True when the rating does not start with ``A`` or ``BBB``."""
    r = _c(rating)
    return ~(r.startswith("A") | r.startswith("BBB"))


def valid_rating(rating) -> Column:
    return _c(rating).isin(*VALID_SP_RATINGS)


def parse_pts(c) -> Column:
    """``yyyyMMdd-HHmmss`` posting timestamps; malformed text gives null."""
    return F.try_to_timestamp(_c(c), F.lit("yyyyMMdd-HHmmss"))


def parse_yyyymmdd(c) -> Column:
    """``yyyyMMdd`` dates; blank or malformed gives null."""
    return F.try_to_timestamp(blank_to_null(_c(c)), F.lit("yyyyMMdd")).cast("date")


def to_decimal(c, precision: int = 15, scale: int = 2) -> Column:
    """Trimmed text to decimal; unparsable values become null (ANSI-safe)."""
    return F.trim(_c(c)).try_cast(f"decimal({precision},{scale})")


def safe_ratio(num, den) -> Column:
    """Division that yields null on a zero or null denominator."""
    return F.try_divide(_c(num), _c(den))
