"""Read models: figures and lists of a page, each one DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.functions.money import total

from .numbering import numbered

#: Rows of a part of the facts dealt by donor, on average, at most.
PART_ROWS = 500_000


def candidate_figures(money: DataFrame, spending: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total, self, own committee, third party, count; and money spent for and against. Rows without a window are refused.

    money: keys, amount, is_self, is_own. spending: keys, amount, stance."""
    third = ~F.col("is_self") & ~F.col("is_own")
    m = money.groupBy(*keys).agg(total(F.col("amount")).alias("total"), total(F.when(F.col("is_self"), F.col("amount"))).alias("self_money"), total(F.when(F.col("is_own"), F.col("amount"))).alias("own_committee"), total(F.when(third, F.col("amount"))).alias("third_party"), F.count(F.lit(1)).alias("gifts"))
    s = spending.groupBy(*keys).agg(total(F.when(F.col("stance") == "support", F.col("amount"))).alias("ie_support"), total(F.when(F.col("stance") == "oppose", F.col("amount"))).alias("ie_oppose"))
    return m.join(s, list(keys), "full_outer").na.fill(0)


def contributor_lines(money: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A line for each family: amount, gifts, marks, and the in-kind share. money: keys, parent_id, amount, is_self, is_own, in_kind."""
    g = money.groupBy(*keys, "parent_id").agg(total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("gifts"), F.bool_or("is_self").alias("is_self"), F.bool_or("is_own").alias("is_own"), total(F.when(F.col("in_kind"), F.col("amount"))).alias("in_kind"))
    return g.withColumn("in_kind_share", F.round(F.when(F.col("amount") != 0, F.col("in_kind").cast("double") / F.col("amount").cast("double")).otherwise(0.0), 4))


def by_donor(facts: DataFrame, rows: int) -> DataFrame:
    """facts by donor, in as many parts as a shuffle has, and more where a part would have over PART_ROWS of all rows. Counted
    parts are not merged up to a size: few bytes of a shuffle are many groups in memory."""
    parts = max(int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS))
    return facts.repartition(parts, "donor_id")


def donor_footprint(money: DataFrame) -> DataFrame:
    """level, donor_id, part, amount, n: a donor's money by recipient, by year, by cycle and by office, in one pass. Money
    that is dealt by_donor() is summed where it lies."""
    cols = ["committee_id", "year", "cycle", "office"]
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).cast("string").alias("part")) for c in cols])).alias("x")
    return money.select("donor_id", "amount", parts).groupBy("donor_id", "x.level", "x.part").agg(total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("n"))


def committee_profile(spending: DataFrame) -> DataFrame:
    """spender_id, window_id, targets, support, oppose, methods: how a group spends in each election."""
    return spending.groupBy("spender_id", "window_id").agg(F.countDistinct("target_id").alias("targets"), total(F.when(F.col("stance") == "support", F.col("amount"))).alias("support"), total(F.when(F.col("stance") == "oppose", F.col("amount"))).alias("oppose"), F.array_join(F.array_sort(F.collect_set("method")), ",").alias("methods"))


def industries_of(facts: DataFrame, key: str) -> DataFrame:
    """key, tag, direct, support, oppose; a row without tags is "uncategorized". facts: key, tags (array), stream, amount."""
    tags = F.when(F.size("tags") > 0, F.col("tags")).otherwise(F.array(F.lit("uncategorized")))
    spread = facts.select(key, F.explode(tags).alias("tag"), "stream", "amount")
    return spread.groupBy(key, "tag").agg(*[total(F.when(F.col("stream") == s, F.col("amount"))).alias(s) for s in ("direct", "support", "oppose")])


def browse_donors(money: DataFrame) -> DataFrame:
    """parent_id, amount, direct, via_groups, recipients, gifts, self_share."""
    g = money.groupBy("parent_id").agg(total(F.col("amount")).alias("amount"), total(F.when(~F.col("to_group"), F.col("amount"))).alias("direct"), total(F.when(F.col("to_group"), F.col("amount"))).alias("via_groups"), F.countDistinct("committee_id").alias("recipients"), F.count(F.lit(1)).alias("gifts"), total(F.when(F.col("is_self"), F.col("amount"))).alias("own"))
    return g.withColumn("self_share", F.round(F.when(F.col("amount") != 0, F.col("own").cast("double") / F.col("amount").cast("double")).otherwise(0.0), 4)).drop("own")


def facets(donors: DataFrame) -> DataFrame:
    """facet, value, n: types, tags and whether any donor has none. donors: type, tags (array)."""
    tags = F.when(F.size("tags") > 0, F.col("tags")).otherwise(F.array(F.lit("uncategorized")))
    pairs = donors.select(F.explode(F.concat(F.array(F.struct(F.lit("type").alias("facet"), F.col("type").alias("value"))), F.transform(tags, lambda t: F.struct(F.lit("tag").alias("facet"), t.alias("value"))))).alias("x"))
    return pairs.groupBy("x.facet", "x.value").agg(F.count(F.lit(1)).alias("n"))


def donor_filter(donors: DataFrame, kind: str | None = None, tag: str | None = None, text: str | None = None) -> DataFrame:
    """The donors of a type, of a tag ("uncategorized" for none) and with a text in any of their names. donors: type, tags, names (arrays)."""
    out = donors
    if kind:
        out = out.filter(F.col("type") == kind)
    if tag:
        out = out.filter(F.size("tags") == 0 if tag == "uncategorized" else F.array_contains("tags", tag))
    if text:
        out = out.filter(F.exists("names", lambda n: F.contains(F.lower(n), F.lit(text.lower()))))
    return out


def pinned_search(rows: DataFrame, key: str, fields: Sequence[str], amount: str, text: str, cap: int = 100) -> DataFrame:
    """At most cap rows with the text in any field, an exact key first, then by amount, then key."""
    hay = F.lower(F.concat_ws(" ", *[F.col(f).cast("string") for f in fields]))
    pin = F.col(key).cast("string") == text
    return rows.filter(pin | F.contains(hay, F.lit(text.lower()))).withColumn("pinned", pin).orderBy(F.col("pinned").desc(), F.col(amount).desc(), key).limit(cap)


def group_scale(rows: DataFrame, group: str, value: str) -> DataFrame:
    """rows with the largest value of their group, and each one's share of it."""
    w = Window.partitionBy(group)
    return rows.withColumn("scale", F.max(value).over(w)).withColumn("share", F.round(F.when(F.col("scale") != 0, F.col(value).cast("double") / F.col("scale").cast("double")).otherwise(0.0), 6))


def framed_races(races: DataFrame, spending: DataFrame) -> DataFrame:
    """Races of the frame always, others only with money. races: race_id, in_frame. spending: race_id, amount."""
    s = spending.groupBy("race_id").agg(total(F.col("amount")).alias("spent"))
    out = races.join(s, "race_id", "left").withColumn("has_money", F.col("spent").isNotNull())
    return out.filter(F.col("in_frame") | F.col("has_money")).withColumn("spent", F.coalesce("spent", F.lit(0)).cast("decimal(18,2)"))


def worklist(money: DataFrame, donors: DataFrame, label: Column, least: float, n: int | None = None) -> DataFrame:
    """Donors to classify by dollars: total, gifts, distinct recipients as text. money: donor_id, amount, and what label needs."""
    g = money.join(donors, "donor_id").groupBy("donor_id", "name").agg(total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("gifts"), F.array_join(F.array_sort(F.collect_set(label)), "; ").alias("recipients")).filter(F.col("amount") >= least)
    ranked = g.orderBy(F.col("amount").desc(), "donor_id")
    return ranked.limit(n) if n else ranked


def before_windows(money: DataFrame, earliest: DataFrame) -> DataFrame:
    """Receipts before an office type's earliest window. money: candidate_id, office_type, date, amount. earliest: office_type, start_date."""
    early = money.join(earliest, "office_type").filter(F.col("date") < F.col("start_date"))
    return early.groupBy("candidate_id").agg(total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("n"), F.max("date").alias("last"))


def page_cap(rows: DataFrame, value: str, key: str, floor: float, page: int) -> DataFrame:
    """Rows ranked by value, as many as reach floor, and a page at least."""
    best = [F.col(value).desc(), F.col(key)]
    reach = rows.filter(F.col(value) >= floor)
    if reach.limit(page).count() < page:  # a page decides: so many rows at most
        return rows.orderBy(*best).limit(page).withColumn("rank", F.row_number().over(Window.orderBy(*best)).cast("long"))
    return numbered(reach, "rank", best)
