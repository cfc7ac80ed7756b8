"""Dense surrogate keys (W9) without a one-partition global window.

Rows are range-partitioned on the ordering columns and sorted inside each
partition; ``monotonically_increasing_id`` then carries (partition id,
position in partition).  That placement is frozen by writing the stage once
to the shared checkpoint folder, so a lost executor cannot re-sample the
range bounds and shift keys.  Each partition's offset comes from the counts
of the partitions before it; the offsets table has one row per partition,
so its broadcast is bounded by the partition count.  One shuffle, one write;
the input is cached while the range bounds are sampled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histmart.session import materialize

_LOW_BITS = (1 << 33) - 1


def assign_keys(df: DataFrame, order: Sequence[str], out_col: str = "sk",
                base: int = 0, base_df: DataFrame | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = base + 1, base + 2, ... in ``order`` (a total order).

    ``base_df``: optional one-row DataFrame holding the highest existing key;
    it is read to a driver scalar (one value).
    """
    spark = df.sparkSession
    if base_df is not None:
        row = base_df.first()
        base = int(row[0]) if row is not None and row[0] is not None else 0
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) for c in order]
    # the range exchange samples its input in a job of its own; keep that
    # input cached so the upstream plan runs once, not twice
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        placed = (src.repartitionByRange(num_partitions, *cols).sortWithinPartitions(*cols)
                     .withColumn("__id", F.monotonically_increasing_id()))
        placed = materialize(placed, "keys")
    finally:
        src.unpersist()
    pid = F.shiftright(F.col("__id"), 33)
    counts = placed.groupBy(pid.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (placed.join(F.broadcast(offsets), pid == F.col("__b"))
                  .withColumn(out_col, (F.lit(base) + F.col("__off") + F.col("__id").bitwiseAND(F.lit(_LOW_BITS))
                                        + F.lit(1)).cast("long"))
                  .drop("__b", "__off", "__id"))
