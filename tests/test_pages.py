"""Nested read models on a small race, a person who runs again, and a board."""

import datetime

import pytest
from pyspark.sql import functions as F

from civicspark.operators import pages

D = datetime.date
CARDS = "candidacy_id long, person_id long, name string, race_id string, election string, office string, start_date date, end_date date, has_committee boolean, owns_committee boolean, on_current_record boolean, elsewhere boolean, ballot_status string, vacating_for string"


@pytest.fixture(scope="module")
def cards(spark):
    rows = [
        (1, 10, "Ada", "r1", "2019", "alderperson", D(2018, 1, 1), D(2019, 12, 31), True, True, False, False, "on_ballot", None),
        (2, 10, "Ada", "r2", "2023", "alderperson", D(2022, 1, 1), D(2023, 12, 31), False, False, True, False, "on_ballot", None),
        (3, 11, "Ben", "r2", "2023", "alderperson", D(2022, 1, 1), D(2023, 12, 31), True, False, False, False, "removed", None),
        (4, 12, "Cleo", "r2", "2023", "alderperson", D(2022, 1, 1), D(2023, 12, 31), False, False, False, True, "not_filed", None),
        (5, 13, "Dan", "r2", "2023", "alderperson", D(2022, 1, 1), D(2023, 12, 31), False, False, False, False, "on_ballot", "r1"),
        (6, 14, "Eve", "r2", "2023", "alderperson", D(2022, 1, 1), D(2023, 12, 31), False, False, False, False, "on_ballot", "nowhere"),
    ]
    return spark.createDataFrame(rows, CARDS)


@pytest.fixture(scope="module")
def facts(spark):
    receipts = [
        (1, 100, "direct", D(2022, 5, 1), 50.0, False, True, False), (1, 100, "direct", D(2022, 6, 1), 25.0, True, False, False),
        (1, 101, "direct", D(2018, 5, 1), 10.0, False, False, True), (1, 102, "direct", D(2016, 5, 1), 7.0, False, False, False),
        (1, 103, "other", D(2023, 5, 1), 3.0, False, False, False), (1, 104, "small", D(2022, 7, 1), 4.0, False, False, False), (1, 105, "direct", None, 99.0, False, False, False),
    ]
    r = spark.createDataFrame(receipts, "committee_id long, family_id long, stream string, date date, amount double, in_kind boolean, is_self boolean, is_own boolean")
    s = spark.createDataFrame([(2, 500, "support", D(2022, 3, 1), 30.0), (2, 500, "support", D(2019, 3, 1), 8.0), (4, 501, "oppose", D(2023, 1, 1), 9.0)], "target_id long, spender_id long, stance string, date date, amount double")
    return pages.tagged(*[x.withColumn("amount", F.col("amount").cast("decimal(18,2)")) for x in (r, s)])


def test_race_cards(cards, facts):
    got = {r.candidacy_id: r for r in pages.race_cards(cards, facts, 1).collect()}
    assert set(got) == {1, 2, 3, 4, 6}
    two = got[2]  # reads the committee of 1 in its own window
    assert (two.funding_id, two.borrowed, two.filed_under, two.prior_election) == (1, True, "2019", "2019")
    assert [float(two[c]) for c in ("contributions", "self_money", "third_party", "other_receipts", "small_gifts", "raised", "ie_support", "ie_oppose")] == [75, 50, 25, 3, 4, 82, 30, 0]
    assert [(x.other, float(x.amount), x.n, float(x.in_kind)) for x in two.contributors] == [(100, 75, 2, 25)] and two.before_count == 0
    assert (float(got[1].contributions), float(got[1].own_committee), float(got[1].before), got[1].before_last) == (10, 10, 7, D(2016, 5, 1))
    assert [got[i].finance_facet for i in (1, 2, 3, 4, 6)] == [None, None, "committee_no_itemized", "committee_elsewhere", "no_committee"]
    assert [got[i].off_ballot for i in (2, 3, 4)] == [False, True, True] and not got[3].has_finance and got[4].race_has_finance
    assert [tuple(x) for x in got[6].vacating] == [("Dan", "r1")] and got[1].vacating == []


def test_lists_are_cut_and_figures_are_not(spark, cards):
    rows = [(1, 200 + i, "direct", D(2018, 6, 1), i + 1, False, False, False) for i in range(40)]
    r = spark.createDataFrame(rows, "committee_id long, family_id long, stream string, date date, amount long, in_kind boolean, is_self boolean, is_own boolean").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    none = spark.createDataFrame([], "target_id long, spender_id long, stance string, date date, amount decimal(18,2)")
    one = pages.race_cards(cards, pages.tagged(r, none)).filter("candidacy_id = 1").first()
    assert one.families == 40 and float(one.contributions) == 820 and [x.other for x in one.contributors] == [239 - i for i in range(pages.LISTED)]


def test_person_sections(cards, facts):
    got = {r.candidacy_id: r for r in pages.person_sections(cards, facts).collect()}
    assert [(got[i].place, float(got[i].contributions), got[i].owner_id) for i in (2, 1)] == [(1, 75, 1), (2, 10, 1)]
    assert float(got[1].career) == 85 and got[1].out_of_window and float(got[2].ie_support) == 30
    assert got[3].owner_id is None and got[3].contributions is None and not got[3].out_of_window and float(got[4].ie_oppose) == 9


def test_member_records(spark, cards, facts):
    members = spark.createDataFrame([(1, "s1", "p-10"), (2, "s2", "c-1"), (3, "s3", "vacancy"), (4, "s4", None), (5, "s5", "p-999")], "member_id long, seat string, candidacy_ref string")
    donors = spark.createDataFrame([(1, "2019", 7, 10.0, 2, False), (1, "2019", 8, 5.0, 1, True)], "candidacy_id long, election string, donor_id long, amount double, n long, is_self boolean").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    rows = pages.member_records(members, cards, facts, donors).collect()
    by = {(r.member_id, r.election): r for r in rows}
    assert set(by) == {(1, "2019"), (1, "2023"), (2, "2019"), (3, None), (4, None), (5, None)}
    full = by[1, "2019"]
    assert [tuple(x)[1:] for x in full.donors] == [(7, full.donors[0].amount, 2)] and (full.donor_count, full.self_funders, full.coverage_milli, full.has_donor_detail) == (1, 1, 1000, True)
    assert by[2, "2019"].donors is None and by[2, "2019"].finance_state == "totals_only" and float(by[2, "2019"].contributions) == 10
    assert [by[i, None].finance_state for i in (3, 4, 5)] == ["vacancy", "no_record", "full"]


def test_member_sums_need_no_counterparties(spark, cards, facts):
    """A member's money is summed by candidacy, not first by counterparty; one who alone funds an election has no list."""
    members = spark.createDataFrame([(1, "s1", "p-10")], "member_id long, seat string, candidacy_ref string")
    donors = spark.createDataFrame([(1, "2019", 8, 5, 1, True)], "candidacy_id long, election string, donor_id long, amount long, n long, is_self boolean").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    bare = facts.select("role", "key", "stream", "date", "amount")
    row = pages.member_records(members, cards, bare, donors).filter("election = '2019'").first()
    own = cards.withColumns({"funding_id": F.when(F.col("has_committee"), F.col("candidacy_id")), "borrowed": F.lit(False)})
    line = pages.card_figures(pages.card_lines(own, facts)).filter("candidacy_id = 1").first()
    assert [row[c] for c in ("contributions", "other_receipts", "small_gifts", "ie_support", "ie_oppose")] == [line[c] for c in ("contributions", "other_receipts", "small_gifts", "ie_support", "ie_oppose")]
    assert (row.donors, row.donor_count, row.self_funders, row.coverage_milli, row.has_donor_detail) == (None, 0, 1, None, False)


@pytest.mark.parametrize("most", [pages.BROADCAST, 0])
def test_facts_are_read_in_a_window(spark, monkeypatch, most):
    """Facts in a window of their own candidacy, bounds included and open ones too, whether or not the windows are broadcast."""
    monkeypatch.setattr(pages, "BROADCAST", most)
    windows = spark.createDataFrame([(1, D.fromisoformat("2019-01-01"), D.fromisoformat("2019-12-31")), (2, None, D.fromisoformat("2019-12-31")), (3, D.fromisoformat("2019-01-01"), None)], "candidacy_id long, start_date date, end_date date")
    days = [None, "2018-12-31", "2019-01-01", "2019-12-31", "2020-01-01"]
    rows = spark.createDataFrame([(i, k, s and D.fromisoformat(s)) for i, k in enumerate((1, 2, 3, 4, None)) for s in days], "n int, k long, day date")
    got = {(r.k, str(r.day)) for r in pages.read_in_window(rows, "k", F.col("day"), windows).collect()}
    assert got == {(1, "2019-01-01"), (1, "2019-12-31"), (2, "2018-12-31"), (2, "2019-01-01"), (2, "2019-12-31"), (3, "2019-01-01"), (3, "2019-12-31"), (3, "2020-01-01")}
