"""Sinks: versioned table directories, batches of many tables that are
committed as one, and the message log by batch (K1, K9).

A table is a folder of version directories ``v=<batch>``; a version counts
as complete once Spark's ``_SUCCESS`` marker is there.  A merge (K4-K7)
reads the last complete version and writes the next one, so no plan ever
overwrites a path it is reading, and a re-run of a batch rewrites only its
own directory (idempotent by batch id).

Of the tables of a ``Batch`` three kinds are kept.  ``replace``: a version is
the whole table.  ``append``: a version holds the batch's own rows, the table
is all of them.  ``history``: a version holds the current rows after the batch
and those that the batch closed, in two partitions; the table is the last
version's current rows and every version's closed ones.  So a batch neither
reads nor writes what was closed or appended before it.  The list of a
batch's tables, its manifest, is written last: a reader sees all tables of a
batch or none.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path, jvm


def version_path(root: str, batch_id: int) -> str:
    return os.path.join(root, f"v={int(batch_id)}")


def complete_versions(spark: SparkSession, root: str) -> list[int]:
    """Batch ids whose version directory holds ``_SUCCESS`` (a file listing only)."""
    fs, path, jvm = _fs(spark, root)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def has_data(spark: SparkSession, root: str) -> bool:
    """Whether a folder exists and holds anything but markers."""
    fs, path, _ = _fs(spark, root)
    return fs.exists(path) and any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(path))


def read_latest(spark: SparkSession, root: str, schema=None, before: int | None = None) -> DataFrame | None:
    """The last complete version; with ``before``, the last one below it, so a
    batch that runs again reads what it read the first time."""
    versions = [v for v in complete_versions(spark, root) if before is None or v < before]
    if not versions:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(version_path(root, versions[-1]))


def write_version(df: DataFrame, root: str, batch_id: int, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as version ``batch_id`` (overwrite of that version only)."""
    p = version_path(root, batch_id)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(p)
    return p


def append_messages(messages: DataFrame, path: str) -> None:
    """Write the message-log rows of a batch, partitioned by batch id; a batch
    that runs again replaces its own rows."""
    messages.withColumn("message_ts", F.current_timestamp()) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


REPLACE, APPEND, HISTORY = "replace", "append", "history"


def _manifest_path(root: str, batch_id: int) -> str:
    return os.path.join(root, "_batches", f"{int(batch_id)}.json")


def committed_batches(spark: SparkSession, root: str) -> list[int]:
    """Batches whose manifest has been written (a file listing only)."""
    fs, path, _ = _fs(spark, os.path.join(root, "_batches"))
    if not fs.exists(path):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(path)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def read_manifest(spark: SparkSession, root: str, batch_id: int) -> dict[str, dict]:
    """table -> kind, the batch that wrote it last, and its highest surrogate key, if it has one."""
    return json.loads("".join(r[0] for r in spark.read.text(_manifest_path(root, batch_id)).collect()))  # a line


def _read(spark: SparkSession, root: str, name: str, kind: str, batches: list[int]) -> DataFrame:
    """The table as of the last of the batches."""
    folder = os.path.join(root, name)
    if kind == REPLACE:
        return spark.read.parquet(version_path(folder, batches[-1]))
    df = spark.read.option("basePath", folder).parquet(*[version_path(folder, b) for b in batches])
    if kind == HISTORY:
        current = F.col("is_current").cast("boolean")
        df = df.where(~current | (F.col("v") == batches[-1])).withColumn("is_current", current)
    return df.drop("v")


def read_batch(spark: SparkSession, root: str, batch_id: int | None = None) -> dict[str, DataFrame]:
    """All tables as of a committed batch, by default the last; {} before the
    first.  What a load is writing meanwhile isn't seen."""
    batches = [b for b in committed_batches(spark, root) if batch_id is None or b <= batch_id]
    if not batches:
        return {}
    manifests = {b: read_manifest(spark, root, b) for b in batches}
    out = {}
    for name, entry in manifests[batches[-1]].items():
        wrote = [b for b in batches if manifests[b].get(name, {}).get("batch") == b]
        out[name] = _read(spark, root, name, entry["kind"], wrote)
    return out


class CheckFailed(ValueError):
    """Rows of a table break a rule that it must keep."""


class Batch:
    """The tables that one load writes and commits together."""

    def __init__(self, spark: SparkSession, root: str, batch_id: int):
        self.spark, self.root, self.batch_id = spark, root, int(batch_id)
        # never this batch's own output, nor a later one's: a batch that runs again starts from the same state
        self.before = [b for b in committed_batches(spark, root) if b < self.batch_id]
        self._earlier = {b: read_manifest(spark, root, b) for b in self.before}
        self.tables: dict[str, dict] = dict(self._earlier[self.before[-1]]) if self.before else {}
        for later in committed_batches(spark, root):
            if later >= self.batch_id:  # made from what this run replaces
                fs, path, _ = _fs(spark, _manifest_path(root, later))
                fs.delete(path, False)

    def _wrote(self, name: str) -> list[int]:
        return [b for b in self.before if self._earlier[b].get(name, {}).get("batch") == b]

    def previous(self, name: str) -> DataFrame | None:
        """The table as of the batch before, None if there is none."""
        wrote = self._wrote(name)
        return _read(self.spark, self.root, name, self._earlier[wrote[-1]][name]["kind"], wrote) if wrote else None

    def highest(self, name: str) -> int:
        """The highest surrogate key given out so far."""
        return int(self.tables.get(name, {}).get("highest", 0))

    def save(self, name: str, df: DataFrame, kind: str = REPLACE, key: str | None = None,
             rules: Sequence[str] = ()) -> DataFrame:
        """Write a table's version of this batch; returns the table as of it.
        ``key`` is its surrogate key, whose highest value goes to the manifest.
        ``rules`` are SQL conditions that each row must keep, null counting
        as kept; broken ones are counted by the writing job itself, and raise
        ``CheckFailed``, so that the batch is never committed."""
        folder = os.path.join(self.root, name)
        checked = Observation() if rules else None
        observed = df
        if checked is not None:
            observed = df.observe(checked, *[F.count_if(~F.expr(rule)).alias(rule) for rule in rules])
        write_version(observed, folder, self.batch_id, ["is_current"] if kind == HISTORY else None)
        if checked is not None:
            broken = {rule: n for rule, n in checked.get.items() if n}
            if broken:
                raise CheckFailed(f"{name}, batch {self.batch_id}: rows that break a rule: {broken}")
        entry = {"kind": kind, "batch": self.batch_id}
        if key:
            top = self.spark.read.parquet(version_path(folder, self.batch_id)).agg(F.max(key)).first()[0]
            entry["highest"] = max(self.highest(name), int(top or 0))
        self.tables[name] = entry
        return _read(self.spark, self.root, name, kind, [*self._wrote(name), self.batch_id]).select(*df.columns)

    def commit(self) -> None:
        """Make the batch's tables the ones that readers see.  The manifest is
        written under another name and renamed, so it is there whole or not."""
        target = _manifest_path(self.root, self.batch_id)
        fs, path, jvm = _fs(self.spark, target)
        draft = jvm.org.apache.hadoop.fs.Path(target + ".draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(self.tables).encode()))
        out.close()
        if not fs.rename(draft, path):
            raise RuntimeError(f"could not commit batch {self.batch_id}: {target}")
