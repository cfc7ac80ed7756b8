"""Reading the given tables for the queries of this subpackage, and letting go
of what finished jobs have left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from histmart.session import table_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def release(spark: SparkSession) -> None:
    """Has the driver collect what finished jobs no longer refer to, so that
    Spark deletes their shuffle files now.  It does so by itself only when the
    driver's heap fills, and a few large jobs hardly fill it."""
    spark.sparkContext._jvm.System.gc()
