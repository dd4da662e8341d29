"""Nested read models of pages: the cards of a race, the sections of a person, the finance record of a member.

Several facts (receipts, independent spending) are one tagged union. It is joined once with the candidacies that read
it, summed to a line for each candidacy, stream and counterparty, and then brought together by candidacy: lists are
ranked and gathered where the figures are summed, by one more exchange of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.functions.money import total

#: Lines of a list on a page; the figures beside it count all of them.
LISTED = 10
#: Candidacies that are broadcast at most (three columns, some 40 MB); beyond that, facts are shuffled to them.
BROADCAST = 500_000
STREAMS = ("direct", "other", "small", "support", "oppose", "before")


def funded(cards: DataFrame) -> DataFrame:
    """cards with owner_id (the person's latest candidacy that owns a committee), funding_id (the candidacy whose receipts a
    card shows: itself if it has a committee, else the owner if the card says so) and borrowed.

    cards: candidacy_id, person_id, election, has_committee, owns_committee, on_current_record."""
    owners = cards.filter("owns_committee").groupBy("person_id").agg(F.max_by("candidacy_id", F.struct("election", "candidacy_id")).alias("owner_id"))
    out = cards.join(owners, "person_id", "left")
    funding = F.when(F.col("has_committee"), F.col("candidacy_id")).when(F.col("on_current_record"), F.col("owner_id"))
    return out.withColumn("funding_id", funding).withColumn("borrowed", F.coalesce(F.col("funding_id") != F.col("candidacy_id"), F.lit(False)))


def tagged(receipts: DataFrame, spending: DataFrame) -> DataFrame:
    """One table of facts: role, key, stream, other (the counterparty), date, amount, in_kind, self_money, own_committee.

    receipts: committee_id, family_id, stream (direct, other, small), date, amount, in_kind, is_self, is_own. spending:
    target_id, spender_id, stance, date, amount."""
    part = lambda c: F.when(F.col(c), F.col("amount")).otherwise(F.lit(0)).cast("decimal(18,2)")
    got = receipts.select(
        F.lit("receipts").alias("role"), F.col("committee_id").alias("key"), "stream", F.col("family_id").alias("other"), "date", "amount",
        part("in_kind").alias("in_kind"), part("is_self").alias("self_money"), part("is_own").alias("own_committee"),
    )
    none = F.lit(0).cast("decimal(18,2)")
    spent = spending.select(
        F.lit("spending").alias("role"), F.col("target_id").alias("key"), F.col("stance").alias("stream"), F.col("spender_id").alias("other"), "date", "amount",
        none.alias("in_kind"), none.alias("self_money"), none.alias("own_committee"),
    )
    return got.unionByName(spent)


def inside(start: Column, end: Column, date: Column) -> Column:
    """Whether a date lies in a window; null bounds are open, a null date lies in none."""
    return date.isNotNull() & (start.isNull() | (date >= start)) & (end.isNull() | (date <= end))


def read_in_window(facts: DataFrame, key: str, date: Column, cards: DataFrame) -> DataFrame:
    """The facts that some candidacy reads in its own window, by a key that names it: so few that they are best found before
    they are joined with anything else. cards: candidacy_id, start_date, end_date."""
    windows = cards.select("candidacy_id", "start_date", "end_date")
    windows = F.broadcast(windows) if windows.limit(BROADCAST + 1).count() <= BROADCAST else windows
    return facts.join(windows, (F.col(key) == F.col("candidacy_id")) & inside(F.col("start_date"), F.col("end_date"), date), "left_semi")


def card_facts(cards: DataFrame, facts: DataFrame) -> DataFrame:
    """The facts that each candidacy reads, with candidacy_id. Receipts are read through funding_id, spending through the
    candidacy itself. Direct receipts before the window are a stream of their own, on the card whose committee it is.

    cards: candidacy_id, funding_id, borrowed, start_date, end_date. facts: of tagged()."""
    ways = F.array(F.struct(F.lit("receipts").alias("role"), F.col("funding_id").alias("key")), F.struct(F.lit("spending").alias("role"), F.col("candidacy_id").alias("key")))
    readers = cards.select("candidacy_id", "borrowed", "start_date", "end_date", F.explode(ways).alias("way")).select("*", "way.*").drop("way").filter("key IS NOT NULL")
    early = (F.col("stream") == "direct") & (F.col("date") < F.col("start_date")) & ~F.col("borrowed")
    stream = F.when(inside(F.col("start_date"), F.col("end_date"), F.col("date")), F.col("stream")).when(early, F.lit("before"))
    return facts.join(readers, ["role", "key"]).withColumn("stream", stream).filter("stream IS NOT NULL")


def card_sums(cards: DataFrame, facts: DataFrame) -> DataFrame:
    """candidacy_id, contributions, other_receipts, small_gifts, ie_support, ie_oppose: the sums of what it reads in its own
    window, without a line for each counterparty. cards, facts: of card_facts(); of facts, role, key, stream, date and amount."""
    streams = {"contributions": "direct", "other_receipts": "other", "small_gifts": "small", "ie_support": "support", "ie_oppose": "oppose"}
    sums = [total(F.when(F.col("stream") == s, F.col("amount"))).alias(c) for c, s in streams.items()]
    return card_facts(cards, facts).filter(F.col("stream").isin(*streams.values())).groupBy("candidacy_id").agg(*sums)


def card_lines(cards: DataFrame, facts: DataFrame) -> DataFrame:
    """candidacy_id, stream, other, amount, n, in_kind, self_money, own_committee, last: what each candidacy reads of the
    facts, summed by counterparty. cards, facts: of card_facts()."""
    read = card_facts(cards, facts)
    sums = [total(F.col(c)).alias(c) for c in ("amount", "in_kind", "self_money", "own_committee")]
    return read.groupBy("candidacy_id", "stream", "other").agg(*sums, F.count(F.lit(1)).alias("n"), F.max("date").alias("last"))


def card_figures(lines: DataFrame, listed: int = LISTED) -> DataFrame:
    """A row for each candidacy with lines: the sums of every stream, kept apart, and its longest lines as lists of
    structs. At most `listed` lines of a stream are gathered, ranked before they meet."""
    order = Window.partitionBy("candidacy_id", "stream").orderBy(F.col("amount").desc(), "other")
    ranked = lines.repartition("candidacy_id").withColumn("rank", F.row_number().over(order))
    of = lambda s, c: total(F.when(F.col("stream") == s, F.col(c)))
    count = lambda s: F.coalesce(F.sum(F.when(F.col("stream") == s, F.col("n"))), F.lit(0)).cast("long")
    third = F.col("amount") - F.col("self_money") - F.col("own_committee")
    line = F.struct("rank", "other", "amount", "n", "in_kind")
    details = lambda s: F.sort_array(F.collect_list(F.when((F.col("stream") == s) & (F.col("rank") <= listed), line)))
    return ranked.groupBy("candidacy_id").agg(
        of("direct", "amount").alias("contributions"), of("direct", "self_money").alias("self_money"), of("direct", "own_committee").alias("own_committee"),
        total(F.when(F.col("stream") == "direct", third)).alias("third_party"), count("direct").alias("gifts"),
        F.count_if(F.col("stream") == "direct").alias("families"),
        of("other", "amount").alias("other_receipts"), count("other").alias("other_count"), of("small", "amount").alias("small_gifts"),
        total(F.when(F.col("stream").isin("direct", "other", "small"), F.col("amount"))).alias("raised"),
        of("support", "amount").alias("ie_support"), count("support").alias("ie_support_count"), of("oppose", "amount").alias("ie_oppose"), count("oppose").alias("ie_oppose_count"),
        of("before", "amount").alias("before"), count("before").alias("before_count"), F.max(F.when(F.col("stream") == "before", F.col("last"))).alias("before_last"),
        details("direct").alias("contributors"), details("support").alias("supporters"), details("oppose").alias("opponents"),
    )


def race_cards(cards: DataFrame, facts: DataFrame, listed: int = LISTED) -> DataFrame:
    """A row for each card of a race: its facets, figures and lists; candidates who run for another race instead are not
    cards but names that the race's rows carry.

    cards: candidacy_id, person_id, name, race_id, election, office, start_date, end_date, has_committee, owns_committee,
    on_current_record, elsewhere (a committee kept by another office), ballot_status, vacating_for and any more columns,
    which stay. A card's committee without itemized receipts states so instead of figures of zero."""
    known = funded(cards)
    races = cards.select(F.col("race_id").alias("vacating_for")).distinct().withColumn("_there", F.lit(True))
    known = known.join(races, "vacating_for", "left")
    filed = facts.filter("role = 'receipts'").select(F.col("key").alias("funding_id")).distinct().withColumn("_itemized", F.lit(True))
    known = known.join(filed, "funding_id", "left")
    council, empty = F.col("office") == "alderperson", F.col("_itemized").isNull()
    known = known.withColumn("no_itemized", council & F.col("funding_id").isNotNull() & empty)
    known = known.withColumn("funding_id", F.when(~F.col("no_itemized"), F.col("funding_id"))).withColumn("borrowed", F.col("borrowed") & F.col("funding_id").isNotNull())
    figures = card_figures(card_lines(known, facts), listed)
    owners = cards.select(F.col("candidacy_id").alias("funding_id"), F.col("election").alias("_under"))
    last = Window.partitionBy("person_id").orderBy("election", "candidacy_id")
    has = F.col("funding_id").isNotNull()
    facet = F.when(F.col("no_itemized"), "committee_no_itemized").when(council & ~F.col("has_committee") & ~has, F.when(F.col("elsewhere"), "committee_elsewhere").otherwise("no_committee"))
    out = known.withColumn("prior_election", F.lag("election").over(last)).join(figures, "candidacy_id", "left").join(owners, "funding_id", "left")
    race = Window.partitionBy("race_id")
    gone = F.col("_there").isNotNull()
    out = out.withColumns(
        {
            "has_finance": has,
            "finance_facet": facet,
            "off_ballot": F.col("ballot_status").isin("not_filed", "removed"),
            "filed_under": F.when(F.col("borrowed"), F.col("_under")),
            "race_has_finance": F.bool_or(has).over(race),
            "vacating": F.sort_array(F.collect_list(F.when(gone, F.struct("name", "vacating_for"))).over(race)),
        }
    )
    return out.filter(~gone).drop("_there", "_itemized", "_under", "no_itemized")


def person_sections(cards: DataFrame, facts: DataFrame) -> DataFrame:
    """A row for each candidacy of each person, newest first (place): the owning committee's receipts in the candidacy's
    window, the candidacy's own independent spending beside them, the person's career total over the sections, and
    whether the committee has counted receipts outside all of the person's windows.

    cards: candidacy_id, person_id, election, start_date, end_date, owns_committee and any more columns."""
    every = funded(cards.withColumns({"has_committee": F.lit(False), "on_current_record": F.lit(True)})).withColumn("borrowed", F.lit(True))
    figures = card_figures(card_lines(every, facts), 0)
    windows = every.groupBy("owner_id").agg(F.collect_list(F.struct("start_date", "end_date")).alias("windows")).filter("owner_id IS NOT NULL")
    direct = facts.filter("role = 'receipts' AND stream = 'direct'").groupBy(F.col("key").alias("owner_id"), "date").agg(F.count(F.lit(1)).alias("n"))
    outside = direct.join(windows, "owner_id").groupBy("owner_id").agg(F.bool_or(~F.exists("windows", lambda w: inside(w["start_date"], w["end_date"], F.col("date")))).alias("out_of_window"))
    out = every.join(figures, "candidacy_id", "left").join(outside, "owner_id", "left")
    person = Window.partitionBy("person_id")
    return out.withColumns(
        {
            "place": F.row_number().over(person.orderBy(F.col("election").desc(), F.col("candidacy_id").desc())),
            "career": F.sum(F.coalesce("contributions", F.lit(0))).over(person).cast("decimal(18,2)"),
            "out_of_window": F.coalesce("out_of_window", F.lit(False)),
        }
    )


def member_records(members: DataFrame, cards: DataFrame, facts: DataFrame, donors: DataFrame) -> DataFrame:
    """A row for each member of a board and each election of the candidacies that the member's reference names; members
    without a record have one row without an election.

    members: member_id, seat, candidacy_ref ("" or null: none; "vacancy"; "p-" and a person; "c-" and a candidacy).
    donors: candidacy_id, election, donor_id, amount, n, is_self: itemized lines of the candidacies' own committees.

    finance_state is vacancy, no_record, full (a person) or totals_only (a candidacy). Only members in full have donor
    lists: donors who don't fund themselves, by amount, at most LISTED of them, with the share of the election's money
    that all of them cover. A reference to no known candidacy has no elections."""
    ref = F.trim(F.coalesce("candidacy_ref", F.lit("")))
    kind = F.when(ref == "", "no_record").when(ref == "vacancy", "vacancy").when(ref.startswith("p-"), "full").otherwise("totals_only")
    m = members.withColumn("finance_state", kind).withColumn("_id", F.when(kind.isin("full", "totals_only"), F.regexp_extract(ref, "([0-9]+)$", 1).try_cast("long")))
    own = cards.withColumns({"funding_id": F.when(F.col("has_committee"), F.col("candidacy_id")), "borrowed": F.lit(False)})
    money = ["contributions", "other_receipts", "small_gifts", "ie_support", "ie_oppose"]
    figures = card_sums(own, facts)
    order = Window.partitionBy("candidacy_id", "is_self").orderBy(F.col("amount").desc(), "donor_id")
    ranked = donors.repartition("candidacy_id").withColumn("rank", F.row_number().over(order))
    them = ~F.col("is_self")
    lists = F.sort_array(F.collect_list(F.when(them & (F.col("rank") <= LISTED), F.struct("rank", "donor_id", "amount", "n"))))
    listed = ranked.groupBy("candidacy_id").agg(
        F.when(F.count_if(them) > 0, lists).alias("donors"), F.count_if(them).alias("donor_count"),
        F.sum(F.when(them, F.col("amount"))).cast("decimal(18,2)").alias("covered"), F.count_if("is_self").alias("self_funders"),
    )
    facts_of = own.join(figures, "candidacy_id", "left").join(listed, "candidacy_id", "left")
    by = facts_of.select(
        F.explode(F.array(F.struct(F.lit("full").alias("finance_state"), F.col("person_id").alias("_id")), F.struct(F.lit("totals_only").alias("finance_state"), F.col("candidacy_id").alias("_id")))).alias("w"),
        "candidacy_id", "election", F.col("funding_id").alias("committee_id"), *[F.coalesce(c, F.lit(0)).cast("decimal(18,2)").alias(c) for c in money], "donors", "donor_count", "covered", "self_funders",
    ).select("w.*", "*").drop("w")
    out = m.join(by, ["finance_state", "_id"], "left").drop("_id")
    full = F.col("finance_state") == "full"
    cents = lambda c: (F.col(c) * 100).cast("long")
    share = F.when(full & (F.col("contributions") > 0), F.floor(cents("covered") * 1000 / cents("contributions")).cast("long"))
    return out.withColumns(
        {
            "donors": F.when(full, F.col("donors")),
            "donor_count": F.when(full, F.coalesce("donor_count", F.lit(0))),
            "self_funders": F.when(full, F.coalesce("self_funders", F.lit(0))),
            "coverage_milli": share,
            "has_donor_detail": full & F.coalesce(F.col("donor_count") > 0, F.lit(False)),
        }
    ).drop("covered")
