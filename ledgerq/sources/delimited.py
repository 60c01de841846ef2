"""Delimited files with a fixed positional schema.

A record is one physical line, as a line reader sees it: quotes do not join lines. ``scan`` reads the lines that hold
something. Whatever counts or numbers lines goes through ``framed``, which gives every line a row, blank ones
included, and leaves comments out; the header, the first line of a file that is no comment, is taken out when
the written lines are numbered, as only then it is known which line of a file is the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerq.operators.rules import CORRUPT, READ, Rule
from ledgerq.sources.workspace import cut

# One header line per file, columns by position, quotes doubled inside quotes, '#' comment lines.
OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "encoding": "UTF-8",
    "comment": "#",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # With pruning a line is only cut up to the columns asked for, and one that is too short or
    # too long would pass unnoticed in a query that asks for few.
    "columnPruning": "false",
}
# Some 200 MB in memory, the splits of 128 TB; more of them meet their rows in a shuffle.
_BROADCAST_SPLITS = 1_000_000
FILE_POSITION = ("_metadata.file_path AS _file", "_metadata.file_block_start AS _block")
#: Where a line comes from; ``number_rows`` turns it into a row number.
PLACE = ("_file", "_block", "_row")


def with_malformed(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def scan(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The data lines that are not blank; a line that does not fit has its text in the malformed column.

    A missing path fails at once. Text columns stay text, so that bad values reach the rules.
    """
    return spark.read.schema(with_malformed(schema)).options(**OPTIONS).csv(path)


def scan_ordered(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Every data line, blank ones too, plus ``seq``: its 1-based number in file order (path, then offset).

    The files are read once, into a table of placed lines; whatever happens to the split layout
    later, every pass reads that table.
    """
    return number_rows(cut(framed(spark, path, schema), "lines"))


def framed(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Every physical line but comments, headers still among them, with its columns and its place.

    Only good for one pass. Write the rows before they are numbered. A missing path fails at once.
    """
    return parsed(placed(spark.read.text(path).selectExpr(*FILE_POSITION, "value")), schema)


def placed(lines: DataFrame) -> DataFrame:
    """Leave comment lines out and give each other line a place that rises within its file split."""
    kept = lines.where(~F.col("value").startswith(OPTIONS["comment"]))
    return kept.select(*PLACE[:2], F.monotonically_increasing_id().alias(PLACE[2]), "value")


def parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of placed lines; one that does not fit, as no blank line does, is malformed."""
    record = F.from_csv("value", with_malformed(schema).simpleString()[len("struct<") : -1].replace(":", " "), OPTIONS)
    columns = [F.col(f"_record.{c}").alias(c) for c in schema.names]
    # A blank line parses to nothing at all, and is not marked by the parser.
    malformed = F.when(F.trim("value") == "", F.col("value")).otherwise(F.col(f"_record.{CORRUPT}"))
    return lines.withColumn("_record", record).select(*PLACE, *columns, malformed.alias(CORRUPT))


def number_rows(written: DataFrame) -> DataFrame:
    """``seq``, the 1-based row number by file and offset, in place of the columns of ``placed``; headers go.

    ``written`` is a table. Rows per split are counted, these counts alone are put in order, and a
    row adds its place in its split to the rows before the split. No sort of the data.
    """
    splits = written.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per split (128 MB of input or so): small enough for one ordered window.
    opens = (F.row_number().over(Window.partitionBy("_file").orderBy("_block")) == 1).cast("long")
    rows = F.col("_n") - F.col("_head")
    before = F.sum(rows).over(Window.orderBy("_file", "_block")) - rows
    starts = splits.withColumn("_head", opens).select("_file", "_block", "_first", "_head", before.alias("_before"))
    starts = cut(starts, "splits")
    if starts.count() <= _BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    place = F.col("_row") - F.col("_first") - F.col("_head")
    rest = [c for c in written.columns if c not in PLACE]
    return written.join(starts, ["_file", "_block"]).where(place >= 0).select((place + F.col("_before") + 1).alias("seq"), *rest)


def malformed_rule(df: DataFrame) -> list[Rule]:
    """The read-phase rule, for frames that come from a scan."""
    if CORRUPT not in df.columns:
        return []
    line = F.col(CORRUPT)
    return [Rule("linea_malformada", line.isNotNull(), "linea con formato incorrecto: %s", line, READ)]
