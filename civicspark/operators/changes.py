"""Plans of changes: staged edits against the live table and the snapshot they were made on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import numbered


def parse_list(c: Column) -> Column:
    """A comma list to an array of trimmed, non-empty items."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def parse_flags(c: Column) -> Column:
    """"type|url|note; ..." to an array of structs; a segment without a type is dropped."""
    part = lambda s, i: F.trim(F.coalesce(F.try_element_at(F.split(s, r"\|"), F.lit(i)), F.lit("")))
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda s: F.struct(part(s, 1).alias("type"), part(s, 2).alias("url"), part(s, 3).alias("note"))), lambda f: f["type"] != "")


def encode_flags(flags: Column) -> Column:
    """The reverse; separators inside a value become spaces."""
    clean = lambda x: F.translate(F.coalesce(x, F.lit("")), ";|", "  ")
    return F.array_join(F.transform(flags, lambda f: F.rtrim(F.concat_ws("|", clean(f["type"]), clean(f["url"]), clean(f["note"])), F.lit("|"))), "; ")


def sanitise(c: Column, is_url: bool) -> tuple[Column, Column]:
    """The value without separators, and null, "warn" or, for an address, "hold" where it had any."""
    clean = F.translate(F.coalesce(c, F.lit("")), ";|", "  ")
    return clean, F.when(clean != F.coalesce(c, F.lit("")), "hold" if is_url else "warn")


def classify_edits(staged: DataFrame, live: DataFrame, snapshot: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """key, cell, action, old, new of every edited cell (non-null in staged).

    NEW: the row isn't live nor in the snapshot. COLLISION: it isn't in the snapshot but is live. HELD: the row was
    in the snapshot and is gone. CONFLICT: the live cell has changed since to something else. UPDATE: else.
    Cells that already hold the value are left out."""
    def cells(df: DataFrame, out: str) -> DataFrame:
        return df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("cell"), F.col(c).cast("string").alias(out)) for c in columns])).alias("x")).select(key, "x.*")

    s = cells(staged, "new").filter("new IS NOT NULL")
    j = s.join(cells(live, "old").withColumn("is_live", F.lit(True)), [key, "cell"], "left").join(cells(snapshot, "was").withColumn("known", F.lit(True)), [key, "cell"], "left")
    is_live, known = F.col("is_live").isNotNull(), F.col("known").isNotNull()
    action = F.when(~is_live & ~known, "NEW").when(is_live & ~known, "COLLISION").when(~is_live & known, "HELD").when(~F.col("old").eqNullSafe(F.col("was")), "CONFLICT").otherwise("UPDATE")
    return j.filter(~(is_live & F.col("old").eqNullSafe(F.col("new")))).select(key, "cell", action.alias("action"), "old", "new")


def mint_ids(rows: DataFrame, taken: DataFrame, id_col: str, prefix: str, order: str) -> DataFrame:
    """rows with the next numbers of a namespace, in order."""
    last = taken.filter(F.col(id_col).startswith(prefix)).agg(F.max(F.regexp_extract(id_col, "([0-9]+)$", 1).cast("long")).alias("m")).first()["m"] or 0
    out = numbered(rows, "_next", [order]).withColumn(id_col, F.concat(F.lit(prefix), (F.lit(last) + F.col("_next")).cast("string")))
    return out.drop("_next")


def check_families(members: DataFrame) -> DataFrame:
    """cluster_id, violation: fewer than two members, not exactly one parent, a repeated member."""
    g = members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("role") == "parent").alias("p"), F.countDistinct("donor_id").alias("d"))
    rules = F.array(F.when(F.col("n") < 2, "too few members"), F.when(F.col("p") != 1, "not one parent"), F.when(F.col("d") < F.col("n"), "repeated member"))
    return g.select("cluster_id", F.explode(F.array_compact(rules)).alias("violation"))


def new_families(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """Members (cluster_id, donor_id, role) of requested families; ids follow those that exist. requests: request, parent_id, members (array)."""
    numbered = mint_ids(requests, existing.select("cluster_id"), "cluster_id", "fam-", "request")
    spread = numbered.select("cluster_id", "parent_id", F.explode(F.array_distinct(F.concat(F.array("parent_id"), "members"))).alias("donor_id"))
    return spread.select("cluster_id", "donor_id", F.when(F.col("donor_id") == F.col("parent_id"), "parent").otherwise("alt-name").alias("role"))


def edit_families(members: DataFrame, requests: DataFrame) -> DataFrame:
    """Members after add, remove, promote and delete requests: cluster_id, op, donor_id. A promoted member demotes the old
    parent; removing a member that isn't there changes nothing."""
    r = requests.select("cluster_id", "op", "donor_id")
    kept = members.join(r.filter("op = 'delete'").select("cluster_id").distinct(), "cluster_id", "left_anti").join(r.filter("op = 'remove'").select("cluster_id", "donor_id").distinct(), ["cluster_id", "donor_id"], "left_anti")
    added = r.filter("op = 'add'").select("cluster_id", "donor_id").distinct().join(members.select("cluster_id").distinct(), "cluster_id", "left_semi").join(kept.select("cluster_id", "donor_id"), ["cluster_id", "donor_id"], "left_anti").withColumn("role", F.lit("alt-name"))
    now = kept.select("cluster_id", "donor_id", "role").unionByName(added.join(r.filter("op = 'delete'").select("cluster_id").distinct(), "cluster_id", "left_anti"))
    up = r.filter("op = 'promote'").groupBy("cluster_id").agg(F.max("donor_id").alias("up"))
    return now.join(up, "cluster_id", "left").select("cluster_id", "donor_id", F.when(F.col("up").isNull(), F.col("role")).when(F.col("up") == F.col("donor_id"), "parent").otherwise("alt-name").alias("role"))


def merge_families(members: DataFrame, merges: DataFrame) -> DataFrame:
    """Members after family drop is merged into family keep: its rows move, former parents become alt-name, each donor once.
    merges: keep, drop (each drop once)."""
    m = members.join(merges.withColumnRenamed("drop", "cluster_id"), "cluster_id", "left")
    moved = m.select(F.coalesce("keep", "cluster_id").alias("cluster_id"), "donor_id", F.when(F.col("keep").isNotNull(), "alt-name").otherwise(F.col("role")).alias("role"))
    return moved.groupBy("cluster_id", "donor_id").agg(F.max("role").alias("role"))
