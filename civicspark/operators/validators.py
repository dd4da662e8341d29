"""Families of data-quality rules that look at several tables at once (DQ-3, 8, 10, 12, 14, 16, 17, 18).

Each gives violations as `quality` does. Every function reads a table once for all rules on its rows, and
compares tables by joins and sums on their keys; nothing is gathered by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import entities, quality

MONEY = "decimal(18,2)"


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def text_of(*names: str) -> Column:
    return F.concat_ws("/", *[F.col(n).cast("string") for n in names])


def differs(a: str, b: str) -> Column:
    return ~F.col(a).eqNullSafe(F.col(b))


def compared(a: DataFrame, b: DataFrame, keys: Sequence[str], rules: dict[str, str], severity: str = quality.ERROR) -> DataFrame:
    """Columns that differ between two tables of one row a key: rules maps a column to its rule. A side
    without the row counts as 0; nulls in the given rows too."""
    x = a.select(*keys, *[F.col(c).alias(f"x_{c}") for c in rules])
    y = b.select(*keys, *[F.col(c).alias(f"y_{c}") for c in rules])
    j = x.join(y, list(keys), "full_outer").withColumn("key", text_of(*keys))
    zero = F.lit(0)
    return quality.row_rules(j, "key", {rule: F.coalesce(f"x_{c}", zero) != F.coalesce(f"y_{c}", zero) for c, rule in rules.items()}, severity)


def missing(df: DataFrame, on: Sequence[str], known: DataFrame, rule: str, key: Column, severity: str = quality.ERROR) -> DataFrame:
    """Rows of df whose key has a value and stands in no row of known (columns named as on)."""
    held = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    return quality.violations(df.filter(held).join(known.select(*on).distinct(), list(on), "left_anti"), rule, key, "", severity)


def vote_rules(votes: DataFrame, meta: DataFrame, positions: DataFrame, roster: DataFrame | None, declared: DataFrame) -> DataFrame:
    """DQ-3. votes: vote_id, date, type. meta: code, vote_id, reverse_coded. positions: vote_id, seat. roster: seat, code.
    declared: term_votes, a row.

    Without a roster (None) or with an empty one, one violation says which, and the two rules that need it don't run.
    """
    n = votes.agg(F.count(F.lit(1)).alias("votes"), F.lit(None).cast("bigint").alias("said"))
    both = n.unionByName(declared.select(F.lit(None).cast("bigint").alias("votes"), F.col("term_votes").cast("bigint").alias("said")))
    count = both.agg(F.max("votes").alias("votes"), F.max("said").alias("said")).filter("said <> votes")
    found = [
        quality.not_unique(votes, "vote id is unique", ["vote_id"]),
        quality.violations(count, "declared count is the count", F.lit("votes"), F.concat_ws(" vs ", F.col("said").cast("string"), F.col("votes").cast("string"))),
        quality.row_rules(votes, "vote_id", {"vote is dated": F.col("date").isNull(), "type is a list as text": ~F.col("type").rlike(r"^\[.*\]$")}),
        missing(meta, ["vote_id"], votes, "featured vote resolves", F.col("code")),
        quality.row_rules(meta, "code", {"retired field is absent": F.col("reverse_coded").isNotNull()}),
    ]
    state = "absent" if roster is None else "empty" if roster.isEmpty() else None
    if state:
        one = declared.sparkSession.range(1)
        return union([*found, quality.violations(one, "roster is there", F.lit("roster"), state)])
    return union([*found, quality.unresolved(roster, "code", meta, "code", "code resolves"), quality.unresolved(positions, "seat", roster, "seat", "seat resolves")])


def person_rules(persons: DataFrame, members: DataFrame, candidacies: DataFrame, by_year: DataFrame, banned: Sequence[str]) -> DataFrame:
    """DQ-8. persons: person_id, display_name, total. members: person_id, candidacy_id, election_id, owns_committee.
    candidacies: candidacy_id, election_id, direct, on_current_record. by_year: person_id, year, amount.

    The total is that of the candidacies owned. The earliest candidacy of a person of two or more, with money in
    all and in that election's year, is exactly what is flagged as on the current record.
    """
    known = candidacies.select("candidacy_id", F.col("election_id").alias("actual"), "direct", "on_current_record")
    m = members.join(known, "candidacy_id", "left")
    own = F.when(F.col("owns_committee"), F.coalesce("direct", F.lit(0))).otherwise(0)
    per = m.groupBy("person_id").agg(F.sum(own).alias("owned"), F.count(F.lit(1)).alias("n"), F.min(F.struct(F.coalesce("election_id", F.lit("")).alias("e"), "candidacy_id")).alias("first"))
    p = persons.join(per, "person_id", "left")
    rules = {
        "person has members": F.col("n").isNull(),
        "person has a name": F.trim(F.coalesce("display_name", F.lit(""))) == "",
        "total is the sum owned": F.abs(F.coalesce("total", F.lit(0)) - F.coalesce("owned", F.lit(0))) > 0.01,
    }
    first = p.filter("n >= 2 AND total > 0").select("person_id", F.split("first.e", "-")[0].alias("year"), F.col("first.candidacy_id").alias("candidacy_id"))
    paid = by_year.filter("amount > 0").select("person_id", F.col("year").cast("string").alias("year")).distinct()
    prior = first.join(paid, ["person_id", "year"], "left_semi").select("candidacy_id").distinct()
    flagged = candidacies.filter("on_current_record").select("candidacy_id").distinct()
    return union([
        quality.row_rules(p, "person_id", rules),
        quality.row_rules(m, "candidacy_id", {"member exists": F.col("actual").isNull(), "member's election is its own": F.col("election_id") != F.col("actual")}),
        missing(flagged, ["candidacy_id"], prior, "flag has a link", F.col("candidacy_id")),
        missing(prior, ["candidacy_id"], flagged, "link has a flag", F.col("candidacy_id")),
        quality.violations(persons.limit(1), "no spenders' key", F.lit("persons"), ",".join(quality.banned_keys(persons, banned))).filter("detail <> ''"),
    ])


def linkage_rules(committees: DataFrame, candidacies: DataFrame, members: DataFrame) -> DataFrame:
    """DQ-10. committees: committee_id, filing_id, type, candidate_id. candidacies: candidate_id, filing_id, election_date, ord,
    direct. members: person_id, candidate_id, owns_committee."""
    claims = candidacies.withColumn("committee_id", F.col("filing_id")).withColumn("race_id", F.lit(None).cast("string"))
    owners = entities.owning_candidacy(claims).select(F.col("committee_id").alias("filing_id"), F.col("candidate_id").alias("owner"))
    stamped = committees.filter("type = 'candidate' AND filing_id IS NOT NULL").join(owners, "filing_id")
    own = committees.select("candidate_id", "filing_id").distinct()
    winners = owners.select(F.col("owner").alias("candidate_id"), F.lit(True).alias("wins")).distinct()
    held = candidacies.select("candidate_id", F.col("filing_id").isNotNull().alias("claims")).join(winners, "candidate_id", "left")
    m = members.join(held, "candidate_id", "left")
    expect = F.coalesce(F.col("claims") & F.col("wins"), F.lit(False))
    return union([
        quality.row_rules(stamped, "committee_id", {"stamp is the owner": differs("candidate_id", "owner")}),
        quality.violations(candidacies.filter("direct <> 0").join(own, ["candidate_id", "filing_id"], "left_anti"), "money has its own claim", F.col("candidate_id")),
        quality.row_rules(m.withColumn("key", text_of("person_id", "candidate_id")), "key", {"flag of ownership agrees": F.coalesce("owns_committee", F.lit(False)) != expect}),
    ])


def ward_rules(candidacies: DataFrame, races: DataFrame, committees: DataFrame, ward_map: DataFrame) -> DataFrame:
    """DQ-12. candidacies: candidate_id, race_id, filing_id, incumbent. races: race_id, office, ward. committees: filing_id.
    ward_map: ward, mapped (a row a ward). A candidacy may precede its committee, so that rule warns only."""
    wards = races.filter("office = 'alderperson' AND ward IS NOT NULL").select("race_id", "ward").join(ward_map, "ward", "left")
    sitting = candidacies.filter("incumbent").join(wards, "race_id")
    return union([
        quality.not_unique(candidacies.filter("filing_id IS NOT NULL"), "committee is used once", ["filing_id"]),
        missing(candidacies, ["filing_id"], committees, "committee exists", F.col("candidate_id"), quality.WARNING),
        quality.row_rules(sitting, "candidate_id", {"incumbent has the ward's committee": differs("filing_id", "mapped")}),
    ])


def split_rules(facts: DataFrame, counted: Column, committees: DataFrame, stored: DataFrame, dues: str, receipt: str) -> DataFrame:
    """DQ-14. facts: key, parent_id, committee_id, contribution_type, amount. counted: which rows are in totals.
    committees: committee_id, type. stored: parent_id, direct, independent, total.

    Outside dues a row has the spenders' type exactly when it goes to a spender; the stored parts are those of a
    recount, and where they are they make the total.
    """
    to = committees.select("committee_id", (F.col("type") == "independent_expenditure").alias("spends"))
    f = facts.filter(F.col("contribution_type") != dues).join(to, "committee_id", "left").withColumn("typed", F.col("contribution_type") == receipt)
    into = F.coalesce("spends", F.lit(False))
    part = lambda c: F.sum(F.when(c, F.col("amount")).otherwise(0)).cast(MONEY)
    again = f.filter(counted).groupBy("parent_id").agg(part(~F.col("typed")).alias("d"), part(F.col("typed")).alias("i"))
    j = stored.join(again, "parent_id", "full_outer")
    zero = F.lit(0)
    off = (F.coalesce("direct", zero) != F.coalesce("d", zero)) | (F.coalesce("independent", zero) != F.coalesce("i", zero))
    rules = {"parts are the recount": off, "parts make the total": ~off & (F.col("direct") + F.col("independent") != F.col("total"))}
    return union([
        quality.row_rules(f, "key", {"typed row goes to a spender": F.col("typed") & ~into, "row to a spender is typed": into & ~F.col("typed")}),
        quality.row_rules(j, "parent_id", rules),
    ])


def report_rules(inputs: DataFrame, current: DataFrame, known: DataFrame, runs: DataFrame, strings: DataFrame, gaps: DataFrame) -> DataFrame:
    """DQ-17, for any number of reports. inputs: report_id, name, path, sha. current: name, now (no row: absent).
    known: report_id, name, owner, removal, most. runs: report_id, data_through, pulled (text), residual, keys, expected (arrays).
    strings: report_id, path, value. gaps: report_id, amount.

    An input fails when its entry is malformed, absent or moved. Known failures only shrink: more than `most`, an entry
    without owner or condition, or one that no longer fails are errors; a failing input with a known entry is none.
    """
    i = inputs.join(current.select("name", "now"), "name", "left").withColumn("key", text_of("report_id", "name"))
    malformed = F.coalesce("sha", F.lit("")).eqNullSafe("") | F.coalesce("path", F.lit("")).eqNullSafe("")
    why = F.when(malformed, "malformed").when(F.col("now").isNull(), "absent").when(F.col("now") != F.col("sha"), "moved")
    j = i.select("report_id", "name", why.alias("why")).join(known.select("report_id", "name", "owner", "removal", F.lit(True).alias("pinned")), ["report_id", "name"], "full_outer").withColumn("key", text_of("report_id", "name"))
    grew = known.groupBy("report_id").agg(F.count(F.lit(1)).alias("n"), F.max("most").alias("most")).filter("most IS NULL OR n > most")
    iso = r"^\d{4}-\d{2}-\d{2}$"
    dated = F.coalesce(F.col("data_through").rlike(iso), F.lit(False)) & F.coalesce(F.col("pulled").rlike(iso), F.lit(False))
    told = gaps.groupBy("report_id").agg(F.sum("amount").cast(MONEY).alias("told"))
    r = runs.join(told, "report_id", "left")
    return union([
        quality.violations(j.filter("why IS NOT NULL AND pinned IS NULL"), "input is unchanged", F.col("key"), F.col("why")),
        quality.row_rules(j, "key", {"known failure still fails": F.col("pinned") & F.col("why").isNull(), "known failure has an owner": F.col("pinned") & ((F.coalesce("owner", F.lit("")) == "") | (F.coalesce("removal", F.lit("")) == ""))}),
        quality.violations(grew, "known failures shrink", F.col("report_id")),
        quality.violations(strings.filter(F.startswith("value", F.lit("/")) | F.contains("value", F.lit("/Users/")) | F.contains("value", F.lit("/home/"))), "path is relative", text_of("report_id", "path")),
        quality.row_rules(r, "report_id", {
            "dates are there": ~dated,
            "data end before the pull": dated & (F.col("data_through") > F.col("pulled")),
            "disclosed is the residual": F.coalesce("told", F.lit(0)) != F.coalesce("residual", F.lit(0)),
            "no key is missing": F.size(F.array_except("expected", "keys")) > 0,
            "no key is unexpected": F.size(F.array_except("keys", "expected")) > 0,
        }),
        missing(runs, ["report_id"], strings, "report has strings", F.col("report_id")),
    ])


def anchor_rules(seats: DataFrame, candidacies: DataFrame, person_members: DataFrame) -> DataFrame:
    """DQ-16, who a seat's money belongs to. seats: seat, name, ref, kind (person, candidate, none, vacancy). candidacies:
    candidate_id. person_members: person_id, candidate_id."""
    ref = F.coalesce("ref", F.lit(""))
    s = seats.join(candidacies.select(F.col("candidate_id").alias("ref"), F.lit(True).alias("stands")).distinct(), "ref", "left")
    s = s.join(person_members.select(F.col("person_id").alias("ref"), F.lit(True).alias("person")).distinct(), "ref", "left")
    s = s.join(person_members.select(F.col("candidate_id").alias("ref"), F.lit(True).alias("linked")).distinct(), "ref", "left")
    kind = F.col("kind")
    return quality.row_rules(s, "seat", {
        "kind is known": ~F.coalesce(kind.isin("person", "candidate", "none", "vacancy"), F.lit(False)),
        "only a vacancy is blank": (kind == "vacancy") & (F.trim(F.coalesce("name", F.lit(""))) != ""),
        "no placeholder": F.startswith(ref, F.lit("inc-")),
        "candidate resolves": (kind == "candidate") & F.col("stands").isNull(),
        "person resolves": (kind == "person") & F.col("person").isNull(),
        "person is preferred": (kind == "candidate") & F.col("linked"),
    })


def donor_list_rules(figures: DataFrame, source: DataFrame, donors: DataFrame, items: DataFrame, coverage: DataFrame, self_funders: DataFrame) -> DataFrame:
    """DQ-16, money of a seat and an election. figures, source: seat, election, direct, self_funding, ie_support, ie_oppose (a row each).
    donors: seat, election, donor_id, amount, n. items: seat, election, donor_id, date (text), amount. coverage: seat, election,
    dollars, donor_total, donor_count, share_sum, substantive_share, meets, threshold. self_funders: seat, donor_id."""
    k, d = ["seat", "election"], ["seat", "election", "donor_id"]
    streams = ("direct", "self_funding", "ie_support", "ie_oppose")
    rows = donors.groupBy(*k).agg(F.sum("amount").cast(MONEY).alias("rows"), F.count(F.lit(1)).alias("row_count"))
    zero = F.lit(0)
    # Figures and coverage meet the donors' sums together; a rule on columns that the row's table lacks is not broken.
    told = figures.unionByName(coverage, allowMissingColumns=True).join(rows, k, "left").withColumn("key", text_of(*k))
    told = told.withColumns({c: F.coalesce(c, zero) for c in ("rows", "row_count")})
    iso = F.coalesce(F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))
    per = items.groupBy(*d).agg(F.sum("amount").cast(MONEY).alias("item_sum"), F.count(F.lit(1)).alias("item_count"), F.count_if(~iso).alias("undated"))
    j = donors.join(per, d, "left").withColumn("key", text_of(*d))
    return union([
        compared(figures, source, k, {s: f"{s} is its source" for s in streams}),
        quality.violations(donors.join(self_funders.select("seat", "donor_id").distinct(), ["seat", "donor_id"], "left_semi"), "no self-funder among donors", text_of(*d)),
        quality.row_rules(j, "key", {
            "donor has items": F.col("item_count").isNull(),
            "items are dated": F.col("undated") > 0,
            "items make the donor": F.col("item_count").isNotNull() & (F.col("item_sum") != F.col("amount")),
            "item count is the donor's": F.col("item_count").isNotNull() & ~F.col("item_count").eqNullSafe(F.col("n")),
        }),
        quality.row_rules(told, "key", {
            "donors make direct": F.col("rows") != F.col("direct"),
            "donors leave out self-funding": (F.col("self_funding") > 0) & (F.col("rows") == F.col("direct") + F.col("self_funding")),
            "coverage makes the total": F.col("dollars") != F.col("donor_total"),
            "donors make the total": F.col("rows") != F.col("donor_total"),
            "donors are counted": F.col("row_count") != F.col("donor_count"),
            "shares make one": (F.abs(F.col("share_sum") - 1) >= 1e-6) & (F.col("row_count") > 0),
            "threshold agrees with its share": F.col("meets") != (F.col("substantive_share") >= F.col("threshold")),
        }),
    ])


def scope_rules(scope: DataFrame, facts: DataFrame, stated: DataFrame, recorded: DataFrame, listed: DataFrame) -> DataFrame:
    """DQ-16, what a board's page says of its own scope, counted again from the facts in one pass.

    scope: seat, committee_id. facts: committee_id, donor_id, date, amount, other_receipt (left out of the page), report
    (quarterly, large_gift or null), is_self. stated: one row: other_amount, other_count, quarterly, large_gift (latest dates), built.
    recorded, listed: seat, donor_id: self-funders as recorded, and donors that the page lists. A committee may serve several seats."""
    seats = scope.groupBy("committee_id").agg(F.collect_set("seat").alias("seats"))
    within = facts.join(seats, "committee_id", "left")
    inside = F.col("seats").isNotNull() & F.col("other_receipt")
    latest = lambda kind: F.max(F.when(F.col("report") == kind, F.col("date"))).alias(f"r_{kind}")
    again = within.agg(F.coalesce(F.sum(F.when(inside, F.col("amount"))), F.lit(0)).alias("r_amount"), F.count_if(inside).alias("r_count"), latest("quarterly"), latest("large_gift"))
    late = lambda kind: F.coalesce(F.col(kind) > F.col("built"), F.lit(False))
    one = quality.row_rules(stated.join(again, F.lit(True)).withColumn("page", F.lit("page")), "page", {
        "other receipts are the recount": F.col("other_amount") != F.col("r_amount"),
        "other receipts are counted": F.col("other_count") != F.col("r_count"),
        "quarterly date is the latest": differs("quarterly", "r_quarterly"),
        "large gift date is the latest": differs("large_gift", "r_large_gift"),
        "no date is after the build": late("quarterly") | late("large_gift"),
    })
    selves = within.filter(F.col("is_self") & F.col("seats").isNotNull()).select(F.explode("seats").alias("seat"), "donor_id").distinct()
    sides = union([df.select("seat", "donor_id", F.lit(i).alias("side")) for i, df in enumerate((selves, recorded, listed))])
    each = sides.groupBy("seat", "donor_id").agg(*[F.bool_or(F.col("side") == i).alias(n) for i, n in enumerate(("source", "recorded", "listed"))])
    people = quality.row_rules(each.withColumn("key", text_of("seat", "donor_id")), "key", {
        "self-funder is not listed": F.col("source") & F.col("listed"),
        "self-funder is recorded": F.col("source") & ~F.col("recorded"),
        "recorded self-funder is one": F.col("recorded") & ~F.col("source"),
    })
    return union([one, people])


def vocabulary_rules(used: DataFrame, vocabulary: DataFrame, clusters_used: DataFrame, clusters: DataFrame) -> DataFrame:
    """DQ-16, labels. used: tag. vocabulary: tag, label, colour. clusters_used, clusters: cluster_id."""
    blank = (F.coalesce("label", F.lit("")) == "") | (F.coalesce("colour", F.lit("")) == "")
    return union([
        quality.unresolved(used, "tag", vocabulary, "tag", "tag has an entry"),
        quality.unresolved(vocabulary, "tag", used, "tag", "entry is used"),
        quality.row_rules(vocabulary, "tag", {"entry is complete": blank}),
        quality.unresolved(clusters_used, "cluster_id", clusters, "cluster_id", "cluster resolves"),
    ])


def slice_rules(items: DataFrame, spenders: DataFrame, windows: DataFrame) -> DataFrame:
    """DQ-16, outside spending. items: election, spender_id, date, amount. spenders: election, spender_id, amount (a row each).
    windows: election, start_date, end_date (null: open)."""
    w = items.join(windows, "election", "left")
    inside = F.coalesce(F.col("date") >= F.col("start_date"), F.col("start_date").isNull()) & F.coalesce(F.col("date") <= F.col("end_date"), F.col("end_date").isNull())
    k = ["election", "spender_id"]
    sums = items.groupBy(*k).agg(F.sum("amount").cast(MONEY).alias("amount"))
    outside = w.filter(F.col("date").isNull() | ~inside).groupBy(*k).agg(F.count(F.lit(1)).alias("n"))
    return union([
        quality.violations(outside, "item is in its election", text_of(*k), F.col("n")),
        compared(spenders, sums, k, {"amount": "items make the spender"}),
    ])


def home_rules(
    donors: DataFrame, facts: DataFrame, items: DataFrame, recipients: DataFrame, streams: DataFrame, groups: DataFrame, spending: DataFrame, feed: DataFrame, votes: DataFrame,
    inputs: DataFrame, candidacies: DataFrame, link: str, least: float = 1_000, itemised: float = 50_000, rows: int = 10,
) -> DataFrame:
    """DQ-18, the home page counted again from the facts (HP-1 to HP-9).

    facts: donor_id (the parent), committee_id, stream, cycle, amount, own_group; rows with own_group are counted apart.
    donors: donor_id, cycle, place, amount (a row a donor and cycle). items: donor_id, committee_id, amount. recipients:
    committee_id, office, filing_id, person. streams: stream, amount ("own_group" for what is apart). groups: group_id,
    amount. spending: group_id, amount. feed, votes: date, vote_id, body; votes has all that may stand in the feed, which
    takes the latest; feed has link, which is `link` and the vote for the school board's. inputs: name, sha, now.
    candidacies: filing_id (each once), candidacy_id, race, person.

    What is counted twice is one tagged union of both sides, each table read once, and one sum for each rule and key.
    """
    text = lambda c: F.col(c).cast("string")
    none = F.lit(None).cast(MONEY)

    def said(rule: str, key: Column, have: Column = none, want: Column = none, part: Column | None = None) -> Column:
        return F.struct(F.lit(rule).alias("rule"), key.alias("key"), (F.lit("") if part is None else part).alias("part"), have.cast(MONEY).alias("have"), want.cast(MONEY).alias("want"))

    def told(df: DataFrame, *entries: Column) -> DataFrame:
        return df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")

    amount, one = F.col("amount"), F.lit(1)
    stream, donor, item, there, group = "HP-2 stream is the recount", "HP-3 donor is the recount", "HP-5 items make the donor", "HP-6 recipient is there", "HP-7 group is the recount"
    both = union([
        told(facts, said(stream, F.when(F.col("own_group"), "own_group").otherwise(F.col("stream")), want=amount), F.when(~F.col("own_group"), said(donor, text("donor_id"), want=amount, part=text("cycle")))),
        told(streams, said(stream, F.col("stream"), have=amount)),
        told(donors, said(donor, text("donor_id"), have=amount, part=text("cycle")), said(item, text("donor_id"), want=amount)),
        told(items, said(item, text("donor_id"), have=amount), F.when(F.col("committee_id").isNotNull(), said(there, text("committee_id"), have=one))),
        told(recipients, said(there, text("committee_id"), want=one)),
        told(groups, said(group, text("group_id"), have=amount)),
        told(spending, said(group, text("group_id"), want=amount)),
    ])
    sums = both.groupBy("rule", "key", "part").agg(F.sum("have").cast(MONEY).alias("have"), F.sum("want").cast(MONEY).alias("want"))
    of_key = F.sum("want").over(Window.partitionBy("rule", "key"))
    meant = F.when((F.col("rule") == donor) & (F.col("total") < least), None).when((F.col("rule") == item) & (F.col("want") < itemised), None).otherwise(F.col("want"))
    differs_from = F.when(F.col("rule") == there, F.col("have").isNotNull() & F.col("want").isNull()).otherwise(F.coalesce("have", F.lit(0)) != F.coalesce("meant", F.lit(0)))
    counted = sums.withColumn("total", of_key).withColumn("meant", meant).filter(differs_from)
    found = counted.select("rule", F.lit(quality.ERROR).alias("severity"), F.concat_ws("/", "key", F.nullif("part", F.lit(""))).alias("key"), F.lit("").alias("detail"))

    # In the order of their places no total may rise, and equal totals go by id: neighbours are places that differ by one.
    shown = donors.groupBy("donor_id").agg(F.sum("amount").alias("total"), F.min("place").alias("place"))
    beside = shown.select(F.explode(F.array(F.struct("place", F.lit(False).alias("next")), F.struct((F.col("place") - 1).alias("place"), F.lit(True).alias("next")))).alias("x"), F.struct("total", "donor_id").alias("d"))
    pairs = beside.groupBy("x.place").agg(F.max(F.when(~F.col("x.next"), F.col("d"))).alias("a"), F.max(F.when(F.col("x.next"), F.col("d"))).alias("b"))
    wrong = (F.col("b.total") > F.col("a.total")) | (F.col("b.total") == F.col("a.total")) & (F.col("b.donor_id") < F.col("a.donor_id"))
    ranked = quality.violations(pairs.filter(wrong), "HP-4 donors are ranked", F.col("a.donor_id"))

    mine = candidacies.select(F.col("filing_id").alias("_filing"), "candidacy_id", "race", F.col("person").alias("_person"))
    known = recipients.join(mine, F.col("filing_id") == F.col("_filing"), "left")
    mayor = F.col("office") == "mayor"
    for_mayor = F.coalesce(F.col("race") == "mayor", F.lit(False))
    people = quality.row_rules(known, "committee_id", {
        "HP-6 mayoral recipient has a candidacy": mayor & ~for_mayor,
        "HP-6 mayoral recipient names its candidacy": mayor & for_mayor & ~F.col("person").eqNullSafe(F.concat(F.lit("mayor-"), F.get(F.split("candidacy_id", "-"), F.lit(1)))),
        "HP-6 recipient names its person": ~mayor & ~for_mayor & F.col("_person").isNotNull() & ~F.col("person").eqNullSafe(F.col("_person")),
    })

    fed = ["date", "body", "vote_id"]
    latest = votes.orderBy(F.desc("date"), F.desc("body"), F.desc("vote_id")).limit(rows).select(*fed, F.lit(-1).alias("n"), F.lit(True).alias("linked"))
    right = F.concat(F.lit(link), F.replace(F.url_encode("vote_id"), F.lit("+"), F.lit("%20")))
    linked = (F.col("body") != "school_board") | F.col("link").eqNullSafe(right)
    each = feed.select(*fed, F.lit(1).alias("n"), linked.alias("linked")).unionAll(latest).groupBy(*fed).agg(F.sum("n").cast("int").alias("n"), F.count_if(~F.col("linked")).cast("int").alias("astray"))
    fault = lambda rule, detail, times: F.array_repeat(F.struct(F.lit(rule).alias("rule"), F.lit(detail).alias("detail")), F.greatest(times, F.lit(0)))
    faults = F.concat(fault("HP-8 feed is the latest", "extra", F.col("n")), fault("HP-8 feed is the latest", "missing", -F.col("n")), fault("HP-8 link leads to the vote", "", F.col("astray")))
    news = each.select(F.explode(faults).alias("f"), "vote_id").select("f.rule", F.lit(quality.ERROR).alias("severity"), F.col("vote_id").alias("key"), "f.detail")
    unchanged = quality.row_rules(inputs, "name", {"HP-1 input is unchanged": differs("sha", "now")})
    return union([unchanged, found, ranked, people, news])
