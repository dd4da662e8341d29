"""Bulk exports: tab-separated cp1252 text whose records may run over several lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bytes that cp1252 gives no character.
UNMAPPED = "[\\u0081\\u008D\\u008F\\u0090\\u009D]"
#: What the bytes 80 to 9F are as ISO-8859-1, and the characters of cp1252 that they stand for.
_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_PLAIN, _MEANT = "".join(map(chr, _BYTES)), bytes(_BYTES).decode("cp1252")
#: What begins a record: two fields of digits.
START = r"^[0-9]+\t[0-9]+\t"


def from_latin(text: Column) -> Column:
    """Text of cp1252 bytes that was read as ISO-8859-1. Spark reads that one without an option of the session."""
    return F.translate(text, _PLAIN, _MEANT)


def to_latin(text: Column) -> Column:
    """Text to be written as ISO-8859-1, so that the bytes are cp1252."""
    return F.translate(text, _MEANT, _PLAIN)


def scan_unmapped(spark: SparkSession, path: str) -> DataFrame:
    """file, n of the bytes that no character stands for. The scan is splittable: lines are read as bytes."""
    raw = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("v"))
    return raw.groupBy("file").agg(F.sum(F.regexp_count("v", F.lit(UNMAPPED))).alias("n")).filter("n > 0")


def read_bulk_tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A cp1252 table with a header. Refuses files with unmapped bytes."""
    if bad := scan_unmapped(spark, path).limit(3).collect():
        raise ValueError("bytes without a character: " + ", ".join(f"{r.n} in {r.file}" for r in bad))
    reader = spark.read.option("sep", "\t").option("header", True).option("encoding", "ISO-8859-1").option("quote", '"').option("escape", '"')
    table = (reader.schema(schema).option("mode", "FAILFAST") if schema else reader).csv(path)
    return table.select(*[from_latin(F.col(f"`{c}`")).alias(c) if kind == "string" else F.col(f"`{c}`") for c, kind in table.dtypes])


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, pos, value: lines in their order within a file block, decoded, without a carriage return."""
    text = spark.read.option("lineSep", "\n").text(path)
    value = F.regexp_replace(from_latin(F.decode(F.col("value").cast("binary"), "ISO-8859-1")), "\r$", "")
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), value.alias("value"))


def reassemble(lines: DataFrame, start: str = START) -> DataFrame:
    """file, record, lines, text: a line that start matches begins a record, others continue the one before. Lines
    before the first start are record 0.

    Records are numbered inside each block by a running sum; what earlier blocks of the file have is added from
    a table of one row a block, so a record that runs over a block's edge stays whole."""
    marked = lines.withColumn("s", F.col("value").rlike(start).cast("long"))
    blocks = marked.groupBy("file", "block").agg(F.sum("s").alias("n"))
    before = blocks.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.withColumn("i", F.sum("s").over(inside)).join(before, ["file", "block"]).withColumn("record", F.col("before") + F.col("i"))
    parts = F.array_sort(F.collect_list(F.struct("block", "pos", "value")))
    return numbered.groupBy("file", "record").agg(F.count(F.lit(1)).alias("lines"), F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("text"))


def split_admit_quarantine(records: DataFrame, n_fields: int, number: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Records as arrays of n_fields, short ones filled with ""; and those that are too long or fail the test of number."""
    cells = F.split("text", "\t")
    fields = F.when(F.size(cells) < n_fields, F.concat(cells, F.array_repeat(F.lit(""), n_fields - F.size(cells)))).otherwise(cells)
    cut = records.withColumn("size", F.size(cells)).withColumn("fields", fields)
    ok = F.col("size") <= n_fields
    if number is not None:
        ok = ok & F.coalesce(number, F.lit(False))
    return cut.filter(ok).drop("text"), cut.filter(~ok).select("file", "record", "lines", "text", "size")


def assert_accounting(lines: DataFrame, records: DataFrame) -> None:
    """Every physical line is in a record."""
    have, want = records.agg(F.sum("lines")).first()[0] or 0, lines.count()
    if have != want:
        raise ValueError(f"{want} lines, {have} in records")


def in_quarantine(quarantine: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Wanted ids that occur as a field of quarantined text; must be empty."""
    words = quarantine.select(F.explode(F.split("text", "[\t\n]")).alias(key), "file", "record")
    return words.join(ids.select(F.col(key).cast("string").alias(key)).distinct(), key, "left_semi")


def read_receipts(df: DataFrame, required: Sequence[str], committee: str) -> DataFrame:
    """Receipts with the required columns and without blank rows. Empty input is refused; more than one committee is
    reported in a column."""
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"columns {missing} are missing")
    full = df.filter(F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in required]).isNotNull())
    if full.isEmpty():
        raise ValueError("no rows")
    many = full.select(committee).distinct().limit(2).count() > 1
    return full.withColumn("several_committees", F.lit(many))
