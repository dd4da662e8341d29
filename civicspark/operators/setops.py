"""Set and multiset operations between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def occurrence(df: DataFrame, keys: Sequence[str], out: str = "occurrence") -> DataFrame:
    """df with the number of each row among those of its keys, in a fixed order of all columns."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c) for c in df.columns if c not in keys] or [F.lit(0)])))


def multiset_union(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each content key as many rows as the source that has more; a's rows are preferred."""
    na, nb = occurrence(a, keys), occurrence(b, keys)
    return na.withColumn("source", F.lit("a")).unionByName(nb.join(na.select(*keys, "occurrence"), [*keys, "occurrence"], "left_anti").withColumn("source", F.lit("b")))


def multiset_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, in_a, in_b, of keys whose counts differ."""
    na = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("in_a"), F.lit(0).cast("long").alias("in_b"))
    nb = b.groupBy(*keys).agg(F.lit(0).cast("long").alias("in_a"), F.count(F.lit(1)).alias("in_b"))
    return na.unionByName(nb).groupBy(*keys).agg(F.sum("in_a").alias("in_a"), F.sum("in_b").alias("in_b")).filter("in_a <> in_b")


def explain_differences(diff: DataFrame, keys: Sequence[str], moved_on: Sequence[str]) -> DataFrame:
    """diff with a class: "moved" where both sides have rows equal but for one column, "extra" or "missing" else."""
    both = diff.groupBy(*moved_on).agg(F.max((F.col("in_a") > F.col("in_b")).cast("int")).alias("x"), F.max((F.col("in_a") < F.col("in_b")).cast("int")).alias("y"))
    j = diff.join(both, list(moved_on))
    return j.withColumn("class", F.when((F.col("x") == 1) & (F.col("y") == 1), "moved").when(F.col("in_a") > F.col("in_b"), "extra").otherwise("missing")).drop("x", "y")


def symmetric_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only, and which."""
    x, y = a.select(*keys).distinct().withColumn("a", F.lit(True)), b.select(*keys).distinct().withColumn("b", F.lit(True))
    return x.join(y, list(keys), "full_outer").filter("a IS NULL OR b IS NULL").select(*keys, F.when(F.col("a"), "a").otherwise("b").alias("only_in"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """path, old, new, change of every value that was added, removed or changed between two tables."""
    def flat(df: DataFrame, out: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
        return df.select(F.col(key).cast("string").alias("k"), F.explode(pairs).alias("p")).select(F.concat_ws(".", "k", "p.c").alias("path"), F.col("p.v").alias(out))

    j = flat(old, "old").filter("old IS NOT NULL").join(flat(new, "new").filter("new IS NOT NULL"), "path", "full_outer")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return j.select("path", "old", "new", change.alias("change")).filter("change IS NOT NULL")


def shrink_only(failures: DataFrame, known: DataFrame, key: str, most: str = "most") -> DataFrame:
    """key, verdict: failures that aren't on the list, listed ones that are gone, and ones above their pinned count.
    failures: key, n. known: key, most."""
    j = failures.select(key, "n").join(known.select(key, most), key, "full_outer")
    verdict = F.when(F.col(most).isNull(), "new failure").when(F.col("n").isNull(), "stale entry").when(F.col("n") > F.col(most), "grew")
    return j.select(key, verdict.alias("verdict")).filter("verdict IS NOT NULL")


def occurrences(tables: dict[str, DataFrame], key: str, wanted: DataFrame, control: DataFrame) -> DataFrame:
    """table, key, n of wanted ids over several tables. A control id that must occur is looked up first: if it
    isn't found the search itself is broken, and that is an error."""
    everything = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("table"), F.col(key).cast("string").alias("key"))
        everything = part if everything is None else everything.unionByName(part)
    keys = lambda d: d.select(F.col(key).cast("string").alias("key")).distinct()
    if everything.join(keys(control), "key", "left_semi").isEmpty():
        raise ValueError("the control id occurs nowhere: the search finds nothing it should")
    return everything.join(keys(wanted), "key", "left_semi").groupBy("table", "key").agg(F.count(F.lit(1)).alias("n"))


def row_parity(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys and, for each column, whether two versions of a row differ in it; rows that agree are left out."""
    j = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns]).join(b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in columns]), list(keys))
    out = j.select(*keys, *[(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))).alias(c) for c in columns])
    return out.filter(" OR ".join(f"`{c}`" for c in columns))
