"""Numbers in one order over all rows of a table, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from civicspark.sources.work import folder

#: Rows of a partition that Spark's own row ids leave room for, as a power of two.
ID_BITS = 33


def numbered(rows: DataFrame, out: str, order: Sequence[Column | str]) -> DataFrame:
    """rows with out: 1, 2, 3, ... in the order given (as long).

    Rows are dealt by ranges of the order, sorted inside each range and written once with their place there; then each
    range goes on where the one before has ended. Only one count for each partition reaches the driver. Rows that are
    equal in the whole order lie in one partition, so the order should end in a key; among equal rows the numbers are
    arbitrary but distinct. An empty table gives no rows.
    """
    spark = rows.sparkSession
    path = folder(spark, "numbered")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    held = spark.read.schema(StructType([*rows.schema.fields, StructField("_at", LongType())])).parquet(path).withColumn("_part", F.shiftright("_at", ID_BITS).cast("int"))
    counts = sorted((r["_part"], r["count"]) for r in held.groupBy("_part").count().collect())
    before = [0, *accumulate(n for _, n in counts)]
    starts = spark.createDataFrame([(part, start) for (part, _), start in zip(counts, before)], "_part int, _before long")
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << ID_BITS) - 1)) + 1
    return held.join(F.broadcast(starts), "_part").select(*[F.col(f"`{c}`") for c in rows.columns], place.alias(out))
