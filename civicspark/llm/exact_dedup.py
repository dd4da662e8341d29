"""Exact dedup: 128-bit content hash groups, byte comparison, one stable row stays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, materialise, text_or_empty


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text))


def _groups(docs: DataFrame, id_col: str, text_col: str, keep: str, hash_of: Callable[[Column], Column]) -> tuple[DataFrame, list[str]]:
    """A row for each distinct normalised text, and the columns that name it.

    The grouping key holds the text itself beside its hash, so the aggregate compares bytes; copies
    collapse before the shuffle, which makes a huge group of copies as cheap as a small one. Only
    if two texts share a hash do the later joins need the text too.
    """
    pick = {"max": F.max, "min": F.min}[keep]
    keyed = docs.select(F.col(id_col).alias("_id"), ascii_lower(text_or_empty(text_col)).alias("_text"))
    grouped = keyed.withColumn("_hash", hash_of(F.col("_text"))).groupBy("_hash", "_text").agg(pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # The SHA-256 stands for the text in what is stored; it is computed for each distinct text once.
    held = materialise(grouped.select("_hash", F.sha2("_text", 256).alias("text_sha256"), "keep_id", "group_size"), "exact-groups")
    clash = held.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if clash.isEmpty():
        return held, ["_hash"]
    texts = grouped.select("_hash", "_text", "keep_id", "group_size", F.sha2("_text", 256).alias("text_sha256"))
    return texts, ["_hash", "_text"]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. keep says whether
    the largest or the smallest id stays. A null id never stays unless its whole group has null ids,
    in which case keep_id is null. Rows that repeat both id and text count in group_size, and one of
    them is kept. An empty table gives an empty result; other columns are ignored.
    """
    groups, names = _groups(docs, id_col, text_col, keep, hash_of)
    rows = docs.select(F.col(id_col).alias("_id"), ascii_lower(text_or_empty(text_col)).alias("_text"))
    rows = rows.withColumn("_hash", hash_of(F.col("_text"))).select("_id", *names)
    # Dealt by hash and id, so a large group of copies is spread; copies of one row are numbered.
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*names, "_id").orderBy(F.lit(0))))
    joined = rows.join(groups, names)
    return joined.select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_n") == 1)).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """docs without the rows that exact_dedup() marks as not kept; all columns stay as they are."""
    groups, names = _groups(docs, id_col, text_col, keep, hash_of)
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(id_col).alias("_id"), ascii_lower(text_or_empty(text_col)).alias("_text"))
    inner = inner.withColumn("_hash", hash_of(F.col("_text"))).select("_row", "_id", *names)
    stay = groups.select(*[F.col(n).alias(f"g{n}") for n in names], "keep_id")
    on = [F.col(n) == F.col(f"g{n}") for n in names] + [F.col("_id").eqNullSafe(F.col("keep_id"))]
    kept = inner.join(stay, on, "left_semi")
    # The join has dealt the rows by these columns: numbering repeated rows needs no shuffle of its own.
    kept = kept.withColumn("_n", F.row_number().over(Window.partitionBy(*names, "_id").orderBy(F.lit(0)))).filter("_n = 1")
    return kept.select("_row.*")
