"""Filed reports: which version is final, what was sworn, and how our rows compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicspark.functions.money import MONEY, total

from .calendar import first_period


def latest_versions(filings: DataFrame) -> DataFrame:
    """committee_id, beg, fin, doc_id, received, superseded: of the filings for one period the latest received, ties to
    the larger document."""
    return filings.groupBy("committee_id", "beg", "fin").agg(F.max(F.struct("received", "doc_id")).alias("v"), (F.count(F.lit(1)) - 1).alias("superseded")).select("committee_id", "beg", "fin", F.col("v.doc_id").alias("doc_id"), F.col("v.received").alias("received"), "superseded")


#: Finals that one filer may have to be gathered in a row; those of filers with more meet by blocks of days.
GATHERED = 64
#: Blocks of days are 1, 2, 4 and so on up to 2 ** LEVELS days long.
LEVELS = 10


def _blocks(beg: Column, fin: Column) -> Column:
    """The fewest blocks (level, number) that make up beg to fin; longer spans take several of the longest."""
    first, after = F.unix_date(beg), F.unix_date(fin) + 1

    def at(level: int) -> Column:
        low, high = -F.shiftright(-first, level), F.shiftright(after, level)  # whole blocks only
        if level == LEVELS:
            numbers = F.when(low < high, F.sequence(low, high - 1))
        else:
            odd = lambda n, block: F.when((low < high) & (n % 2 != 0), block)
            numbers = F.array_compact(F.array(odd(low, low), odd(high, high - 1)))
        return F.transform(F.coalesce(numbers, F.array().cast("array<int>")), lambda n: F.struct(F.lit(level).alias("level"), n.alias("number")))

    return F.concat(*[at(k) for k in range(LEVELS + 1)])


def _blocks_of_day(day: Column) -> Column:
    """The block of each level that holds a day."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(F.unix_date(day), k).alias("number")) for k in range(LEVELS + 1)])


def _latest_by_blocks(finals: DataFrame) -> DataFrame:
    """finals with by: the latest (received, doc_id) of the same filer's with an overlapping period, itself included.

    Two periods overlap where one begins within the other, that is where a block of the one's span holds the other's
    first day. Spans and first days are told as blocks, the latest of each block is kept, and each final looks up its
    own: some thirty light rows a final, no pair, and no key but a filer's block of days."""
    span, first = _blocks("beg", "fin"), _blocks_of_day(F.col("beg"))

    def told(spans: str, firsts: str) -> Column:
        kind = lambda blocks, name: F.transform(blocks, lambda b: F.struct(F.lit(name).alias("kind"), b["level"].alias("level"), b["number"].alias("number")))
        return F.concat(kind(span, spans), kind(first, firsts))

    each = finals.select("committee_id", F.struct("received", "doc_id").alias("_one"), F.explode(told("span", "first")).alias("_block")).groupBy("committee_id", "_block").agg(F.max("_one").alias("by"))
    asked = finals.select("*", F.explode(told("first", "span")).alias("_block")).join(each, ["committee_id", "_block"])
    return asked.groupBy(*finals.columns).agg(F.max("by").alias("by"))


def _superseding(finals: DataFrame) -> DataFrame:
    """finals with by (received, doc_id): the latest of the same filer's that was received later and whose period
    overlaps; null where there is none, as for finals without a filer, a date or with an end before the beginning."""
    found = finals.groupBy("committee_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GATHERED).select(F.col("committee_id").alias("_crowded"))
    same = F.col("committee_id").eqNullSafe(F.col("_crowded"))
    sound = F.col("committee_id").isNotNull() & F.col("received").isNotNull() & F.coalesce(F.col("beg") <= F.col("fin"), F.lit(False))

    few = finals.join(found, same, "left_anti")
    listed = few.groupBy("committee_id").agg(F.collect_list(F.struct(*finals.columns)).alias("all"))
    each = listed.select(F.explode("all").alias("f"), F.filter("all", lambda x: x["beg"] <= x["fin"]).alias("all")).select("f.*", "all")
    later = F.filter("all", lambda x: (x["received"] > F.col("received")) & (F.col("beg") <= x["fin"]) & (x["beg"] <= F.col("fin")))
    gathered = each.withColumn("by", F.when(sound, F.array_max(F.transform(later, lambda x: F.struct(x["received"].alias("received"), x["doc_id"].alias("doc_id"))))))

    many = finals.join(found, same, "left_semi")
    latest = _latest_by_blocks(many.filter(sound))
    by_blocks = latest.withColumn("by", F.when(F.col("by.received") > F.col("received"), F.col("by")))
    outcome = by_blocks.unionByName(many.filter(~sound), allowMissingColumns=True)
    return gathered.drop("all").unionByName(outcome)


def overlap_superseders(finals: DataFrame) -> DataFrame:
    """committee_id, doc_id, by_doc, by_received: finals that a later-received one of the same filer with an
    overlapping period supersedes, with the latest such. One pass: a superseded filing still supersedes
    others. Equal times supersede nothing; nor does a final without a filer or a date, or that ends before it begins.
    finals: of latest_versions(), one a filer and period, of any number a filer."""
    return _superseding(finals).filter("by IS NOT NULL").select("committee_id", "doc_id", F.col("by.doc_id").alias("by_doc"), F.col("by.received").alias("by_received"))


def unsuperseded(latest: DataFrame) -> DataFrame:
    """Rows of latest_versions() without those that a later-received one with an overlapping period supersedes. latest is
    read three times, so a table that is long to make is best written before."""
    return _superseding(latest).filter("by IS NULL").drop("by")


def final_filings(filings: DataFrame) -> DataFrame:
    """The latest versions that no later-received one with an overlapping period supersedes."""
    return unsuperseded(latest_versions(filings))


def sworn_amounts(finals: DataFrame, sworn: DataFrame) -> DataFrame:
    """finals with itemised and in_kind; a final without a row of totals counts as 0 and is marked missing."""
    s = sworn.select("doc_id", (F.col("individual") + F.col("transfers") + F.col("loans") + F.col("other")).cast(MONEY).alias("_i"), F.col("in_kind").alias("_k"))
    zero = F.lit(0).cast(MONEY)
    return finals.join(s, "doc_id", "left").select(*finals.columns, F.coalesce("_i", zero).alias("itemised"), F.coalesce("_k", zero).alias("in_kind"), F.col("_i").isNull().alias("missing"))


def orphan_totals(sworn: DataFrame, filings: DataFrame) -> DataFrame:
    """Rows of totals whose document was never filed: a structural failure."""
    return sworn.join(filings.select("doc_id"), "doc_id", "left_anti").select("doc_id")


def matched_facts(periods: DataFrame, facts: DataFrame, itemised_types: list[str], in_kind_type: str, aggregate: Column) -> DataFrame:
    """committee_id, beg, fin, date, itemised, in_kind, open, aggregate: sums of the facts by the first filed period that
    holds their date, and by date where none does (beg is null). open is itemised money that isn't aggregate. One pass
    for both grains of a reconciliation.

    periods: committee_id, beg, fin. facts: committee_id, date, amount, contribution_type and what aggregate needs."""
    item, kind = F.col("contribution_type").isin(*itemised_types), F.col("contribution_type") == in_kind_type
    money = lambda c: F.when(c, F.col("amount"))
    marked = facts.select("committee_id", "date", money(item).alias("itemised"), money(kind).alias("in_kind"), money(item & ~aggregate).alias("open"), money(aggregate).alias("aggregate"))
    # Few bytes of a shuffle are many rows in memory, so the parts are counted and not merged up to a size.
    marked = marked.repartition(int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "committee_id")
    hit = first_period(marked, periods.select("committee_id", "beg", "fin"), ["committee_id"], "date", ["beg", "fin"])
    by = hit.groupBy("committee_id", "beg", "fin", F.when(F.col("beg").isNull(), F.col("date")).alias("date"))
    return by.agg(*[total(F.col(c)).alias(c) for c in ("itemised", "in_kind", "open", "aggregate")])


def reconcile_periods(periods: DataFrame, matched: DataFrame) -> DataFrame:
    """Ours against sworn, by filed period. Each fact counts in the first period that holds its date.

    periods: committee_id, beg, fin, itemised, in_kind. matched: of matched_facts()."""
    ours = matched.filter("beg IS NOT NULL").select("committee_id", "beg", "fin", F.col("itemised").alias("ours_itemised"), F.col("in_kind").alias("ours_in_kind"))
    zero = F.lit(0).cast(MONEY)
    out = periods.join(ours, ["committee_id", "beg", "fin"], "left").withColumn("ours_itemised", F.coalesce("ours_itemised", zero)).withColumn("ours_in_kind", F.coalesce("ours_in_kind", zero))
    return out.select("committee_id", "beg", "fin", "itemised", "ours_itemised", (F.col("ours_itemised") - F.col("itemised")).cast(MONEY).alias("residual"), "in_kind", "ours_in_kind", ((F.col("ours_itemised") == 0) & (F.col("itemised") > 0)).alias("coverage_miss"))


def reconcile_committees(periods: DataFrame, matched: DataFrame, threshold: float, filers: DataFrame) -> DataFrame:
    """State and flags of each of filers: RECONCILED when every period agrees to the cent in sum, else RESIDUAL;
    TOO-NEW, without flags or figures, where no period has been filed. PENDING for money after the last filed
    period, OVER-THRESHOLD, COVERAGE-MISS. periods: of sworn_amounts(). matched: of matched_facts()."""
    by_period = reconcile_periods(periods, matched)
    differs = (F.col("ours_itemised") + F.col("ours_in_kind")) != (F.col("itemised") + F.col("in_kind"))
    sums = by_period.groupBy("committee_id").agg(F.count(F.lit(1)).alias("periods"), total(F.col("itemised")).alias("sworn_itemised"), total(F.col("ours_itemised")).alias("ours_itemised"), total(F.col("in_kind")).alias("sworn_in_kind"), total(F.col("ours_in_kind")).alias("ours_in_kind"), F.bool_or(differs).alias("differs"), F.bool_or("coverage_miss").alias("miss"), F.max("fin").alias("last_end"))
    pend = matched.join(sums.select("committee_id", "last_end"), "committee_id").groupBy("committee_id").agg(total(F.when(F.col("date") > F.col("last_end"), F.col("open"))).alias("pending"), total(F.col("aggregate")).alias("aggregate"))
    zero = F.lit(0).cast(MONEY)
    out = sums.join(pend, "committee_id", "left").withColumn("residual", (F.col("ours_itemised") - F.col("sworn_itemised")).cast(MONEY)).withColumn("pending", F.coalesce("pending", zero)).withColumn("aggregate", F.coalesce("aggregate", zero))
    flags = F.concat_ws(",", F.when(F.col("pending") > 0, "PENDING"), F.when(F.abs("residual") > threshold, "OVER-THRESHOLD"), F.when(F.col("miss"), "COVERAGE-MISS"))
    state = F.when(F.col("differs"), "RESIDUAL").otherwise("RECONCILED")
    figures = ["sworn_itemised", "ours_itemised", "residual", "sworn_in_kind", "ours_in_kind", "pending", "aggregate"]
    known = out.select("committee_id", "periods", state.alias("state"), flags.alias("flags"), *figures, "last_end")
    every = filers.select("committee_id").distinct().join(known, "committee_id", "left")
    return every.select("committee_id", F.coalesce("periods", F.lit(0)).cast("long").alias("periods"), F.coalesce("state", F.lit("TOO-NEW")).alias("state"), F.coalesce("flags", F.lit("")).alias("flags"), *[F.coalesce(c, zero).alias(c) for c in figures], "last_end")


def headline(committees: DataFrame) -> DataFrame:
    """One row: totals, counts by state, and the share that match of filers that have filed."""
    return committees.agg(F.count(F.lit(1)).alias("committees"), F.count_if(F.col("state") == "TOO-NEW").alias("too_new"), F.count_if(F.col("state") == "RECONCILED").alias("reconciled"), F.count_if(F.col("state") == "RESIDUAL").alias("with_residual"), total(F.col("sworn_itemised")).alias("sworn"), total(F.col("ours_itemised")).alias("ours"), F.round(100.0 * F.count_if(F.col("state") == "RECONCILED") / F.count_if(F.col("state") != "TOO-NEW"), 1).alias("match_percent"))


def apply_known_gaps(by_period: DataFrame, gaps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Periods whose residual a listed gap explains to the cent, and the listed gaps that no longer occur.

    gaps: committee_id, beg, fin, amount, reason."""
    keys = ["committee_id", "beg", "fin"]
    known = by_period.join(gaps.withColumnRenamed("amount", "residual"), [*keys, "residual"]).select(*keys, "residual", "reason")
    stale = gaps.join(by_period.select(*keys, F.col("residual").alias("amount")), [*keys, "amount"], "left_anti")
    return known, stale


def latest_cash(committees: DataFrame, finals: DataFrame, sworn: DataFrame) -> DataFrame:
    """committee_id, doc_id, as_of, cash: from the final report with the latest period; nulls where there is none.
    A final report without totals makes cash null and is marked."""
    last = finals.groupBy("committee_id").agg(F.max_by(F.struct("doc_id", "fin"), F.struct("fin", "beg", "doc_id")).alias("r")).select("committee_id", F.col("r.doc_id").alias("doc_id"), F.col("r.fin").alias("as_of"))
    out = committees.select("committee_id").join(last, "committee_id", "left").join(sworn.select("doc_id", "cash"), "doc_id", "left")
    return out.select("committee_id", "doc_id", "as_of", F.round("cash", 2).cast(MONEY).alias("cash"), (F.col("doc_id").isNotNull() & F.col("cash").isNull()).alias("lacks_totals"))


def small_gifts(finals: DataFrame, sworn: DataFrame) -> DataFrame:
    """committee_id, periods (array of beg, fin, amount, doc, in order; none of 0) and their total."""
    s = finals.join(sworn.select("doc_id", "small_gifts"), "doc_id").withColumn("amount", F.round("small_gifts", 2).cast(MONEY)).filter("amount <> 0")
    return s.groupBy("committee_id").agg(F.array_sort(F.collect_list(F.struct("beg", "fin", "amount", "doc_id"))).alias("periods"), total(F.col("amount")).alias("small_total"))


def tabulated_filings(facts: DataFrame, filings: DataFrame) -> DataFrame:
    """Facts with the document they were reported on: kind, period and date received; all kept."""
    return facts.join(filings.select(F.col("doc_id").alias("source_filing"), "kind", "beg", "fin", "received"), "source_filing", "left")


def review_queue(committees: DataFrame, activity: DataFrame, selected: DataFrame, since: str) -> DataFrame:
    """Committees with activity since a date that aren't selected. activity: committee_id, date."""
    active = activity.groupBy("committee_id").agg(F.max("date").alias("last_active")).filter(F.col("last_active") >= F.lit(since).cast("date"))
    return committees.join(active, "committee_id").join(selected.select("committee_id"), "committee_id", "left_anti")
