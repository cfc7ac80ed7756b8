"""Change batches as a Structured Streaming source.

CDC files land in per-batch folders (``Batch<N>``); ``readStream`` with the
CDC schema picks them up, ``trigger(availableNow=True)`` processes what is
there, and ``foreachBatch`` lands its rows by change batch and applies the
batches in order with the same set-based merge functions the batch pipeline
uses (K4/K5).  A file that comes late, in whatever micro-batch, is landed
beside the earlier rows of its batch, and that batch and the ones after it
are merged again from all their rows: no row is lost, and the result doesn't
depend on how files fall into micro-batches.  A replayed micro-batch rewrites
its own rows and versions; the stream's checkpoint lives under the cluster's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from histmart.session import ensure_checkpoint_dir
from histmart.sources import sinks
from histmart.sources.readers import TS_FORMAT

Merge = Callable[[DataFrame | None, DataFrame, int], DataFrame]


def cdc_stream(spark: SparkSession, source_dir: str, schema: StructType, sep: str = "|",
               files_per_batch: int | None = None) -> DataFrame:
    """Streaming DataFrame over CDC text files (flag and DSN lead each row),
    with the source file path; ``files_per_batch`` caps a micro-batch."""
    r = (spark.readStream.schema(schema).option("sep", sep).option("header", "false")
         .option("timestampFormat", TS_FORMAT).option("dateFormat", "yyyy-MM-dd")
         .option("nullValue", "").option("recursiveFileLookup", "true"))
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.csv(source_dir).withColumn("_source_file", F.input_file_name())


def batch_of_file(c=None):
    """Batch id from a ``Batch<N>`` folder in the file path (null if absent)."""
    c = c if c is not None else F.col("_source_file")
    return F.nullif(F.regexp_extract(c, r"[Bb]atch(\d+)/", 1), F.lit("")).cast("int")


def apply_change_batches(spark: SparkSession, source_dir: str, schema: StructType, table_root: str,
                         merge: Merge, query_name: str = "cdc", first_batch: int = 2,
                         files_per_batch: int | None = None) -> list[int]:
    """Run every available change batch through ``merge`` and write one new
    table version per change batch; returns the versions written.

    The batch id of a row is the ``Batch<N>`` folder of its file; files
    outside such folders take ``first_batch + epoch``.  ``merge(current,
    changes, batch_id)`` gets the last version below ``batch_id`` (or
    ``None``) and all rows of the batch that have landed so far, under
    ``<table_root>_changes``.  Beside each version stands the list of files
    that it and the ones before it were made of
    (``<table_root>_changes_files``); a version whose list is that of the
    landed files is left as it is.
    """
    ckpt_root = ensure_checkpoint_dir(spark)
    ckpt = os.path.join(ckpt_root, f"stream-{query_name}")
    landed, lists = f"{table_root.rstrip('/')}_changes", f"{table_root.rstrip('/')}_changes_files"
    written: list[int] = []

    def run(batch_df: DataFrame, epoch_id: int) -> None:
        rows = batch_df.withColumns({"change_batch": F.coalesce(batch_of_file(), F.lit(first_batch + int(epoch_id))),
                                     "file_id": F.sha2("_source_file", 256)}).drop("_source_file")
        # a file is always whole in one micro-batch: landing it again replaces it
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("change_batch", "file_id").parquet(landed))
        if not sinks.has_data(spark, landed):
            return
        every = spark.read.schema(rows.schema).parquet(landed)
        files = every.select("change_batch", "file_id").distinct()
        # control flow over the few batch ids, not over rows
        for batch_id in sorted(r[0] for r in files.select("change_batch").distinct().collect()):
            used = files.where(F.col("change_batch") <= batch_id).select("file_id")
            if batch_id in sinks.complete_versions(spark, table_root) and batch_id in sinks.complete_versions(spark, lists):
                had = spark.read.parquet(sinks.version_path(lists, batch_id))
                if used.exceptAll(had).isEmpty() and had.exceptAll(used).isEmpty():
                    continue
            current = sinks.read_latest(spark, table_root, before=batch_id)
            changes = every.where(F.col("change_batch") == batch_id).drop("change_batch", "file_id")
            sinks.write_version(merge(current, changes, batch_id), table_root, batch_id)
            sinks.write_version(used, lists, batch_id)
            if batch_id not in written:
                written.append(batch_id)

    q = (cdc_stream(spark, source_dir, schema, files_per_batch=files_per_batch).writeStream
         .option("checkpointLocation", ckpt)
         .trigger(availableNow=True)
         .foreachBatch(run)
         .queryName(query_name)
         .start())
    q.awaitTermination()
    return written
