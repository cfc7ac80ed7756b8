"""Counts of the warehouse taken while loads run (R2, M3, M4).

A snapshot reads the tables of the last committed batch only: a load that is
running writes version folders which no manifest names yet, so the counts of
one snapshot always belong to one state.  Snapshots go to a log of their own,
``<root>/visibility``, which loads neither write nor replace.  A batch that is
run again withdraws its manifest first and then writes over its own versions;
a snapshot caught by that fails and is taken again.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.plans.audit import FULL, snapshot
from histmart.sources import sinks

#: attempts at a snapshot whose tables are being replaced under it
ATTEMPTS = 3


def log_path(root: str) -> str:
    return os.path.join(root, "visibility")


def record_snapshot(spark: SparkSession, root: str, kind: str = FULL) -> int:
    """Append one snapshot to the log; the batch whose state it counted, 0
    before the first commit."""
    for attempt in range(1, ATTEMPTS + 1):
        batches = sinks.committed_batches(spark, root)
        batch = batches[-1] if batches else 0
        try:
            rows = snapshot(spark, sinks.read_batch(spark, root, batch), batch, kind)
            # some twenty rows in one file: a snapshot is in the log whole or not at all
            rows.coalesce(1).withColumn("snapshot_ts", F.current_timestamp()).write.mode("append").parquet(log_path(root))
            return batch
        except PySparkException:
            # only the withdrawal of the state that was being read is no error
            if attempt == ATTEMPTS or sinks.committed_batches(spark, root) == batches:
                raise
    raise AssertionError("unreachable")


def watch(spark: SparkSession, root: str, wait: Callable[[], bool], kind: str = FULL) -> list[int]:
    """Snapshots one after the other until ``wait``, which pauses between them,
    says that it's enough (``threading.Event`` offers it:
    ``lambda: stop.wait(60)``).  Returns the batches counted."""
    seen = [record_snapshot(spark, root, kind)]
    while not wait():
        seen.append(record_snapshot(spark, root, kind))
    return seen


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(log_path(root))
