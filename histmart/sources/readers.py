"""Readers for the raw extracts.

Every reader takes an explicit schema, returns a lazy DataFrame and lets the
scan split files across tasks; nothing is read through the driver except
the one-line batch date.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from histmart.session import materialize
from histmart.sources import schemas as S

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = "|",
                   header: bool = False) -> DataFrame:
    """Headerless typed delimited text."""
    return (spark.read.schema(schema)
            .option("sep", sep).option("header", str(header).lower())
            .option("timestampFormat", TS_FORMAT).option("dateFormat", "yyyy-MM-dd")
            .option("mode", "PERMISSIVE").option("nullValue", "")
            .csv(path))


CORRUPT = "_corrupt_record"


class BatchFiles:
    """The delimited files of a batch folder, with their malformed rows.

    ``read`` gives the rows of a file that fit its schema; a row with another
    number of fields, or a value that isn't of its field's type, is a reject.
    ``rejects`` has the text of every reject with its file.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._rejects: list[DataFrame] = []

    def read(self, name: str, schema: StructType, sep: str = "|") -> DataFrame:
        text = StructType([StructField(f.name, StringType(), True) for f in schema.fields] + [StructField(CORRUPT, StringType(), True)])
        rows = (self.spark.read.schema(text).option("sep", sep).option("header", "false").option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).option("nullValue", "")
                .option("columnPruning", "false")  # fields are counted whatever is selected
                .csv(os.path.join(self.folder, name)))
        typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
        wrong = F.col(CORRUPT).isNotNull()
        for c, value in typed.items():
            wrong = wrong | (F.col(c).isNotNull() & value.isNull())
        as_read = F.concat_ws(sep, *[F.coalesce(c, F.lit("")) for c in typed])
        record = F.when(wrong, F.coalesce(CORRUPT, as_read))
        # each file is parsed once: its typed rows and its rejects are read from the stage
        staged = materialize(rows.select(*[value.alias(c) for c, value in typed.items()], record.alias(CORRUPT)), "file")
        self._rejects.append(staged.where(F.col(CORRUPT).isNotNull()).select(F.lit(name).alias("file"), F.col(CORRUPT).alias("record")))
        return staged.where(F.col(CORRUPT).isNull()).drop(CORRUPT)

    def rejects(self) -> DataFrame:
        """(file, record) of all files read so far."""
        out = self._rejects[0]
        for r in self._rejects[1:]:
            out = out.unionByName(r)
        return out


def parse_delimited(lines: DataFrame, col: str, schema: StructType, sep: str = "|") -> DataFrame:
    """Parse a text column with ``from_csv`` (same options as the file reader)."""
    opts = {"sep": sep, "timestampFormat": TS_FORMAT, "dateFormat": "yyyy-MM-dd", "nullValue": ""}
    return lines.select(F.from_csv(F.col(col), schema.simpleString(), opts).alias("__r")).select("__r.*")


def read_cdc(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Change-data file: ``CDC_FLAG`` and ``CDC_DSN`` lead each row."""
    return read_delimited(spark, path, schema)


def read_batch_date(spark: SparkSession, path: str):
    """``BatchDate.txt``: one ``yyyy-MM-dd`` line -> a driver-side date scalar."""
    row = spark.read.text(path).select(F.to_date(F.trim("value")).alias("d")).first()
    return row["d"] if row else None


def _fw_fields(layout, start: int) -> list[tuple[str, int, int]]:
    out, pos = [], start
    for name, width in layout:
        out.append((name, pos, width))
        pos += width
    return out


def fixed_width_columns(value: Column, layout, start: int) -> list[Column]:
    """``substring(value, pos, len)`` trimmed, for each (field, width)."""
    return [F.trim(F.substring(value, pos, width)).alias(name)
            for name, pos, width in _fw_fields(layout, start)]


def read_fixed_width_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw FINWIRE lines with posting time and record type split off once.

    Files are selected by the path glob; order comes from the posting time,
    never from file order.
    """
    return parse_fixed_width(spark.read.text(path), "value")


def parse_fixed_width(lines: DataFrame, col: str = "value") -> DataFrame:
    v = F.col(col)
    return lines.select(
        F.try_to_timestamp(F.substring(v, 1, 15), F.lit("yyyyMMdd-HHmmss")).alias("PTS"),
        F.substring(v, 16, 3).alias("RecType"), v.alias("__line"))


def fixed_width_records(parsed: DataFrame, rec_type: str, layouts=None) -> DataFrame:
    """One record type out of the parsed lines, its fields split by width."""
    layouts = layouts or S.FINWIRE_LAYOUTS
    layout = layouts[rec_type]
    start = sum(w for _, w in S.FINWIRE_PREFIX) + 1
    return (parsed.where(F.col("RecType") == rec_type)
                  .select("PTS", "RecType", *fixed_width_columns(F.col("__line"), layout, start)))


def read_actions(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """Customer-management XML actions (S8); ``row_tag`` is their element name,
    with its namespace prefix if it has one.

    Attributes arrive as ``_NAME``; an absent element reads as null, an empty
    one as ''.  The ``Account`` list is an array of structs (S9).  The file
    is read as text cut at the closing tag, so one file of any size is split
    over many tasks; each record is then parsed by itself.  ``seq`` orders
    records by their place in the file; write it with them, before they are
    shuffled, if they are read more than once.
    """
    name = row_tag.rpartition(":")[2]
    lines = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    # where the record stands: file, split, and place in the split's reading order
    lines = lines.select("value", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                                           F.monotonically_increasing_id().alias("record")).alias("seq"))
    start = F.regexp_instr("value", F.lit(f"<{row_tag}[\\s>]"))  # not the root, whose name is longer
    record = F.concat(F.expr("substring(value, __start)"), F.lit(f"</{row_tag}>"))
    bare = F.replace(F.replace(record, F.lit(f"<{row_tag}"), F.lit(f"<{name}")), F.lit(f"</{row_tag}>"), F.lit(f"</{name}>"))
    return parse_actions(lines.withColumn("__start", start).where("__start > 0").select(bare.alias("value"), "seq"), "value", "seq")


def parse_actions(lines: DataFrame, col: str, seq: str) -> DataFrame:
    """``from_xml`` over a column of ``<Action>`` elements (same schema), with
    the column that orders them as ``seq``."""
    return lines.select(F.from_xml(F.col(col), S.ACTION, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias("a"),
                        F.col(seq).alias("seq")).select("a.*", "seq")


def explode_accounts(actions: DataFrame) -> DataFrame:
    """One row per (action, listed account) (S9); actions without a list vanish."""
    return actions.select(
        "_ActionType", "_ActionTS", "seq", F.col("Customer._C_ID").alias("C_ID"),
        F.explode("Customer.Account").alias("acct")).select(
        "_ActionType", "_ActionTS", "seq", "C_ID", F.col("acct._CA_ID").alias("CA_ID"),
        F.col("acct._CA_TAX_ST").alias("CA_TAX_ST"), F.col("acct.CA_B_ID").alias("CA_B_ID"),
        F.col("acct.CA_NAME").alias("CA_NAME"))


def read_audit(spark: SparkSession, paths) -> DataFrame:
    """Audit expectation CSVs with headers padded by blanks.

    Read as text with the header, then columns renamed to their trimmed names
    and cast to the audit schema.
    """
    raw = (spark.read.option("header", "true").option("ignoreLeadingWhiteSpace", "true")
           .option("ignoreTrailingWhiteSpace", "true").csv(paths))
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in S.AUDIT.fields])
