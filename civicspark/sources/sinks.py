"""Outputs: files by key, shards, fingerprints, and publishing that is all or nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a key that one task writes; those of a key with more are dealt to several.
ROWS_A_FILE = 1_000_000


def write_per_key(df: DataFrame, path: str, key: str, layout: Sequence[str], rows_a_file: int = ROWS_A_FILE) -> None:
    """A folder of CSV for each key. The key stands in the folder's name and in a column of the layout if it is one.

    A key has one file, and one for each rows_a_file rows beyond, so that files grow with keys and rows but not with
    tasks."""
    large = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_a_file).select(F.col(key).alias("_key"), F.ceil(F.col("_n") / rows_a_file).alias("_files"))
    dealt = df.join(large, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("_deal", F.when(F.col("_files") > 1, F.pmod(F.xxhash64(*df.columns), "_files")))
    # The work is in the files, so the parts are counted and not left to their bytes.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = dealt.repartition(parts, F.col(key), F.col("_deal")).select(F.col(key).alias(f"by_{key}"), *layout)
    rows.write.mode("overwrite").partitionBy(f"by_{key}").option("header", True).csv(path)


def write_shards(tables: dict[str, tuple[DataFrame, Sequence[str]]], path: str) -> None:
    """Each table's columns to a dataset of its own."""
    for name, (df, columns) in tables.items():
        df.select(*columns).write.mode("overwrite").parquet(f"{path}/{name}")


def canonical(df: DataFrame) -> Column:
    """A row as text that any engine can repeat: columns by name; whole numbers and text as they are, fractions with four
    digits, times to the microsecond, each with its length before it, and n for null."""
    def told(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            c = c.cast("decimal(38,4)")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        c = c.cast("string")
        return F.when(c.isNull(), "n").otherwise(F.concat(F.length(c).cast("string"), F.lit(":"), c))

    kinds = dict(df.dtypes)
    return F.concat(*[told(c, kinds[c]) for c in sorted(df.columns)])


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """rows, w1 to w4: the same for the same rows in any order, counted with repetitions; a row for each value of by.

    The w are sums of the four words of each row's MD5, so fingerprints of parts merge by addition."""
    row = F.md5(canonical(df))
    words = [F.conv(F.substring("_row", 8 * i + 1, 8), 16, 10).cast("decimal(38,0)").alias(f"w{i + 1}") for i in range(4)]
    hashed = df.select(*by, row.alias("_row")).select(*by, *words, F.lit(1).cast("long").alias("rows"))
    return merged_fingerprints(hashed, by)


def merged_fingerprints(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One fingerprint of several: of a table's parts, or of tables that are appended. No rows have zeros."""
    zero = lambda c, kind: F.coalesce(F.sum(c), F.lit(0)).cast(kind).alias(c)
    return parts.groupBy(*by).agg(zero("rows", "long"), *[zero(f"w{i}", "decimal(38,0)") for i in range(1, 5)])


def publish(spark: SparkSession, tables: dict[str, DataFrame], path: str, version: str, check: Callable[[dict[str, DataFrame]], None]) -> str:
    """Writes the tables beside what is published, checks what was written, and only then points to it.

    The pointer is a one-row table that is written last: readers that go through current() see the old version or
    the new one, whole. A failing check leaves the pointer as it was."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{version}/{name}")
    check({name: spark.read.parquet(f"{path}/{version}/{name}") for name in tables})
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").json(f"{path}/_current")
    return version


def current(spark: SparkSession, path: str, name: str) -> DataFrame:
    version = spark.read.schema("version string").json(f"{path}/_current").first()["version"]
    return spark.read.parquet(f"{path}/{version}/{name}")
