"""Roll-ups of counted money. Streams are kept apart: no column adds giving, self-funding and spending for or against."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.functions.money import MONEY, total

ALL = "all"


def by_parent(counted: DataFrame, members: DataFrame, independent: Column) -> DataFrame:
    """parent_id, cycle ("all" or a cycle's code), direct, independent, total, n, committees, members.

    counted: parent_id, cycle, committee_id, amount. Money is summed by recipient first, so that distinct
    recipients are rows and both levels sum what is left. members: parent_id, members."""
    sums = [total(F.col(c)).alias(c) for c in ("direct", "independent", "total")] + [F.sum("n").alias("n")]
    money = counted.select("parent_id", "cycle", "committee_id", F.when(~independent, F.col("amount")).alias("direct"), F.when(independent, F.col("amount")).alias("independent"), F.col("amount").alias("total"), F.lit(1).cast("long").alias("n"))
    base = money.groupBy("parent_id", "cycle", "committee_id").agg(*sums)
    count = F.count(F.lit(1)).alias("committees")
    of_cycle = base.groupBy("parent_id", "cycle").agg(*sums, count)
    of_all = base.groupBy("parent_id", "committee_id").agg(*sums).groupBy("parent_id").agg(*sums, count).withColumn("cycle", F.lit(ALL))
    rolled = of_cycle.unionByName(of_all)
    return rolled.join(members, "parent_id", "left").select("parent_id", "cycle", "direct", "independent", "total", "n", "committees", F.coalesce("members", F.lit(1)).cast("long").alias("members"))


def by_tag(facts: DataFrame, tags: str = "tags", amount: str = "amount", stream: str = "stream") -> DataFrame:
    """tag, cycle ("all" or a code) and a column a stream. A row counts once under each of its tags, so the
    tags' sums exceed the streams' by design. facts: tags (array), cycle, amount, stream."""
    spread = facts.select(F.explode(tags).alias("tag"), "cycle", amount, stream)
    rolled = spread.rollup("tag", "cycle").agg(F.grouping("tag").alias("gt"), F.grouping("cycle").alias("g"), total(F.when(F.col(stream) == "direct", F.col(amount))).alias("direct"), total(F.when(F.col(stream) == "independent", F.col(amount))).alias("independent"))
    return rolled.filter("gt = 0").select("tag", F.when(F.col("g") == 1, ALL).otherwise(F.col("cycle")).alias("cycle"), "direct", "independent")


def by_key_streams(facts: DataFrame, keys: Sequence[str], streams: Sequence[str], amount: str = "amount", counts: bool = False) -> DataFrame:
    """Sums (and counts) of each stream in a column of its own. facts: keys, stream, amount."""
    out: list[Column] = []
    for s in streams:
        out.append(total(F.when(F.col("stream") == s, F.col(amount))).alias(s))
        if counts:
            out.append(F.count_if(F.col("stream") == s).alias(f"{s}_n"))
    return facts.groupBy(*keys).agg(*out)


def by_keys_grouped(facts: DataFrame, sets: Sequence[str], streams: Sequence[str], amount: str = "amount") -> DataFrame:
    """kind, key and a column a stream, for each of several keys in one pass: every row is counted once
    under each key that it has. facts: sets (nullable), stream, amount."""
    keyed = facts.select(F.explode(F.array(*[F.struct(F.lit(s).alias("kind"), F.col(s).cast("string").alias("key")) for s in sets])).alias("k"), "stream", amount).select("k.kind", "k.key", "stream", amount)
    return by_key_streams(keyed.filter("key IS NOT NULL"), ["kind", "key"], streams, amount)


def person_totals(facts: DataFrame) -> DataFrame:
    """level, person_id, part, donor_id, amount: a person's direct money in all, by window, by year, and by
    donor, each row once however many candidacies share its committee. facts: person_id, window_id, year,
    donor_id, amount, one row a contribution."""
    sets = facts.groupingSets([["person_id"], ["person_id", "window_id"], ["person_id", "year"], ["person_id", "donor_id"]], "person_id", "window_id", "year", "donor_id")
    rolled = sets.agg(F.grouping_id("person_id", "window_id", "year", "donor_id").alias("g"), total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("n"))
    level = F.when(F.col("g") == 7, "all").when(F.col("g") == 3, "window").when(F.col("g") == 5, "year").otherwise("donor")
    part = F.when(F.col("g") == 3, F.col("window_id")).when(F.col("g") == 5, F.col("year").cast("string")).when(F.col("g") == 6, F.col("donor_id").cast("string"))
    return rolled.select("person_id", level.alias("level"), part.alias("part"), "amount", "n")


def excluded_magnitude(facts: DataFrame, reasons: dict[str, Column], amount: str = "amount") -> DataFrame:
    """reason, amount, n: what each rule leaves out, each row under the first rule that meets it. Every
    reason has a row, also at nothing."""
    first = None
    for name, rule in reasons.items():
        hit = F.coalesce(rule, F.lit(False))
        first = F.when(hit, name) if first is None else first.when(hit, name)
    found = facts.select(first.alias("reason"), amount).filter("reason IS NOT NULL").groupBy("reason").agg(total(F.col(amount)).alias("amount"), F.count(F.lit(1)).alias("n"))
    names = facts.sparkSession.createDataFrame([(r,) for r in reasons], "reason string")
    return F.broadcast(names).join(found, "reason", "left").select("reason", F.coalesce("amount", F.lit(0)).cast(MONEY).alias("amount"), F.coalesce("n", F.lit(0)).alias("n"))


def apportion(df: DataFrame, keys: Sequence[str], name: str, value: str, scale: int = 1_000_000, out: str = "units") -> DataFrame:
    """Whole units for each row of a group that sum to scale exactly: floors, then one more for the largest
    remainders, ties by name. A group that sums to 0 gets 0s."""
    group = Window.partitionBy(*keys)
    whole = F.sum(value).over(group)
    exact = F.when(whole != 0, F.col(value).cast("decimal(20,2)") * F.lit(scale) / whole.cast("decimal(20,2)")).otherwise(F.lit(0))
    cut = df.withColumn("_exact", exact.cast("decimal(30,10)")).withColumn("_floor", F.floor("_exact").cast("long"))
    short = F.when(whole != 0, F.lit(scale) - F.sum("_floor").over(group)).otherwise(0)
    rank = F.row_number().over(group.orderBy((F.col("_exact") - F.col("_floor")).desc(), F.col(name)))
    return cut.withColumn("_short", short).withColumn("_rank", rank).withColumn(out, F.col("_floor") + (F.col("_rank") <= F.col("_short")).cast("long")).drop("_exact", "_floor", "_short", "_rank")


def coverage(rows: DataFrame, keys: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """Dollars and apportioned shares by industry class, and whether the substantive share meets the threshold.

    rows: keys, industry_class, amount. The classes are few, so a row of them is apportioned as apportion() does, in place:
    floors, then one more for the largest remainders, ties by name."""
    classes, scale = ["individual_only", "substantive", "unclassified"], 1_000_000
    by_class = [total(F.when(F.col("industry_class") == c, F.col("amount"))).alias(c) for c in classes]
    sums = rows.groupBy(*keys).agg(*by_class, total(F.col("amount")).alias("donor_total"), F.count(F.lit(1)).alias("donor_count"))
    whole = sum((F.col(c) for c in classes[1:]), F.col(classes[0]))
    exact = {c: F.when(whole != 0, F.col(c).cast("decimal(20,2)") * F.lit(scale) / whole.cast("decimal(20,2)")).otherwise(F.lit(0)).cast("decimal(30,10)") for c in classes}
    cut = sums.withColumns({f"_{c}": x for c, x in exact.items()}).withColumns({f"_f_{c}": F.floor(f"_{c}").cast("long") for c in classes})
    rest = F.array_sort(F.array(*[F.struct((F.col(f"_f_{c}") - F.col(f"_{c}")).alias("less"), F.lit(c).alias("class")) for c in classes]))
    short = F.when(whole != 0, F.lit(scale) - sum((F.col(f"_f_{c}") for c in classes[1:]), F.col(f"_f_{classes[0]}"))).otherwise(F.lit(0)).cast("int")
    raised = cut.withColumn("_up", F.transform(F.slice(rest, F.lit(1), short), lambda x: x["class"]))
    out = raised.withColumns({f"{c}_units": F.col(f"_f_{c}") + F.array_contains("_up", c).cast("long") for c in classes})
    return out.select(*keys, *classes, "donor_total", "donor_count", *[f"{c}_units" for c in classes], (F.col("substantive_units") >= int(threshold * scale)).alias("meets"))


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= n)


def unified_worklists(lists: DataFrame, key: str, tool: str, amount: str, fields: Sequence[str]) -> DataFrame:
    """One row a key over several tools' lists: the larger total leads, missing fields come from the others.

    lists: key, tool, amount, fields."""
    lead = F.max(F.struct(amount, tool)).alias("lead")
    filled = [F.max_by(f, F.when(F.col(f).isNotNull(), F.struct(F.col(amount), F.col(tool)))).alias(f) for f in fields]
    grouped = lists.groupBy(key).agg(lead, *filled, F.count(F.lit(1)).alias("tools"), F.array_join(F.array_sort(F.collect_set(tool)), ",").alias("seen_in"))
    return grouped.select(key, F.col(f"lead.{amount}").alias(amount), F.col(f"lead.{tool}").alias(tool), *fields, "tools", "seen_in")
