"""Training corpus pipeline: five operators of histmart.llm in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the
columns of ``documents`` (the last one adds size, shard and slot); its result
is written as Parquet and read again as the next one's docs.  Filters decide
on rows by id and text, so repeated ids and rows get the same treatment as
any others.  Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.llm.decontam import decontaminate
from histmart.llm.kdshard import kd_shards
from histmart.llm.minhash import minhash_dedup
from histmart.llm.mixing import mix_documents
from histmart.llm.quality import classify
from histmart.llm.tables import table
from histmart.session import materialize, temporary_tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity is above their language's limit."""
    found = classify(docs, table(spark, sf_dir, "labels"))
    good = found.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")).distinct()
    return docs.join(good, docs["doc_id"].eqNullSafe(good["_id"]) & (F.xxhash64(docs["text"].cast("string")) == good["_h"]), "left_semi")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates (5 words, 0.8): the
    one with the smallest id, one without an id last.  Rows of equal id and
    text are one document."""
    docs = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    found = minhash_dedup(docs.select("_key", "text"), id_col="_key", shingle=5, percent=80)
    rows = found.groupBy("_key").agg(F.first("component_id").alias("_class"), F.count("*").alias("_n"))
    ids = docs.groupBy("_key").agg(F.min("doc_id").alias("_id"))
    first = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_key", "_n"))
    keep = rows.join(ids, "_key").groupBy("_class").agg(first.alias("_first")).select("_first._key", "_first._n")
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "_key"]
    out = docs.join(keep.where("_n = 1"), "_key", "left_semi").select(*columns)
    return out.unionByName(docs.join(keep.where("_n > 1"), "_key", "left_semi").select(*columns).dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    key = F.xxhash64("doc_id", "text")
    hit = decontaminate(docs.withColumn("_key", key), table(spark, sf_dir, "benchmark"), id_col="_key").where("n_hit > 0")
    return docs.withColumn("_key", key).join(hit.select("_key").distinct(), "_key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of sources asks for."""
    return mix_documents(docs, share=1.5, weights=(3, 1, 2), most=2.0)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes."""
    return kd_shards(docs, n_shards=8)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: The quality model and the mix can't be put in SQL; tests/llm holds the
#: pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with temporary_tables(spark):
            docs = materialize(stage(spark, docs, sf_dir), name.split()[0].lower(), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
