"""Data-quality alerts (L1-L6) as message-log rows.

An alert DataFrame has the message-log schema; all alerts of a batch are
unioned and appended once (K9), never written row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGE_COLUMNS = ("batch_id", "message_source", "message_text", "message_type", "message_data")


def key_values(pairs: Sequence[tuple[str, Column]]) -> Column:
    """``KEY = value, KEY2 = value2`` text; a null value prints as empty."""
    parts = []
    for i, (name, c) in enumerate(pairs):
        sep = "" if i == 0 else ", "
        parts.append(F.concat(F.lit(f"{sep}{name} = "), F.coalesce(c.cast("string"), F.lit(""))))
    return F.concat(*parts)


def alerts(df: DataFrame, when: Column, source: str, text: str,
           data: Sequence[tuple[str, Column]], batch_id, message_type: str = "Alert") -> DataFrame:
    """One message row per row of ``df`` for which ``when`` holds (null = no)."""
    b = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return df.where(F.coalesce(when, F.lit(False))).select(
        b.cast("int").alias("batch_id"), F.lit(source).alias("message_source"),
        F.lit(text).alias("message_text"), F.lit(message_type).alias("message_type"),
        key_values(data).alias("message_data"))


def union_messages(frames: Sequence[DataFrame]) -> DataFrame:
    out = None
    for f in frames:
        f = f.select(*MESSAGE_COLUMNS)
        out = f if out is None else out.unionByName(f)
    return out


def dob_out_of_range(dob: Column, batch_date: Column) -> Column:
    """Rule D5: before batch date - 100 years, or after the batch date."""
    return (dob < F.add_months(batch_date, -1200)) | (dob > batch_date)


def invalid_domain(c: Column, allowed: Sequence) -> Column:
    """Non-null value outside the allowed set."""
    return c.isNotNull() & ~c.isin(*allowed)
