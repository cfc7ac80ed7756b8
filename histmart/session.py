"""SparkSession construction and lineage cutting.

Cluster settings win: ``spark.checkpoint.dir`` is read from the session and
only filled in when it is unset (local tests).  No machine-local scratch
folder is ever chosen when the cluster names one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # parquet scans: 128 MB splits keep a task's input inside executor memory
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "histmart") -> SparkSession:
    """Return the active session, or build one with histmart's defaults.

    An already running session (cluster submit) is returned unchanged apart
    from a checkpoint directory when none is configured.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    try:
        value = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf lookup on odd sessions
        value = None
    if value:
        return value
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set the checkpoint dir only where a local session leaves it unset
    (tests); on a cluster an unset one is an error."""
    configured = checkpoint_dir(spark)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not configured:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            configured = tempfile.mkdtemp(prefix="histmart-ckpt-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a long plan feeds several outputs or a later stage would
    otherwise recompute a wide lineage after an executor is lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Plans that run in this block do without whole-stage code where that
    would make a method of more than 8000 bytes, which the JVM never compiles:
    wide projections then run as several methods that it does compile.  A
    value that the session has set stays."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.unset(name)


_temporary: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialized in this block are deleted at its end, but
    for those with ``keep=True``, which belong to the block around it.  What
    leaves the block must read kept tables only."""
    _temporary.append([])
    try:
        yield
    finally:
        for p in _temporary.pop():
            _delete(spark, p)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def delete_table(df: DataFrame) -> None:
    """Deletes a table that ``materialize`` gave back, before its block ends."""
    _delete(df.sparkSession, df._table_folder)


def materialize(df: DataFrame, name: str = "stage", keep: bool = False) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: the plan runs a single time, the result survives executor
    loss, and values computed from physical placement (partition ids,
    in-partition positions) are frozen as data."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "histmart-tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    owner = len(_temporary) - 1 - keep
    if owner >= 0:
        _temporary[owner].append(path)
    out = spark.read.parquet(path)
    out._table_folder = path
    return out


ROWS_A_TASK = 100_000


def tasks_for(counted: DataFrame) -> int:
    """Partitions in which a task sorts or groups about ``ROWS_A_TASK`` of the
    rows of ``counted``, and no fewer than the cores.  Of parquet tables only
    the footers are read.  An explicit count is kept by AQE, which otherwise
    joins small shuffle blocks to as few tasks as there are cores, so that a
    task's memory grows with the input."""
    return max(counted.sparkSession.sparkContext.defaultParallelism, -(-counted.count() // ROWS_A_TASK))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
