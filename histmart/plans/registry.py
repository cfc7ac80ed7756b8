"""Registry of driver queries: each key pairs a Spark builder with its SQL twin.

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's parquet tables.  The SQL twin is plain ANSI SQL over views of the
same tables (used as an independent oracle); ``None`` when the operator is
not expressible in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from histmart.session import table_path

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
