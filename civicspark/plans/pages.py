"""Queries of the nested read models: AG-48 race cards, AG-49 person sections, AG-55 member records.

Lists are told as text, one line after another, so that both sides say the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions.money import total
from civicspark.operators import pages

from .model import given, oracle, raw
from .money import M
from .registry import query

CARDS = """SELECT k.*, right(k.window_id, 4) AS election, w.start_date, w.end_date, k.window_id || '-' || CAST(k.block AS VARCHAR(20)) AS race_id,
    CASE WHEN k.candidacy_id % 17 = 4 THEN k.window_id || '-' || CAST(k.block + 3 AS VARCHAR(20)) END AS vacating_for
  FROM (SELECT s_suppkey AS candidacy_id, CAST(floor(s_suppkey / 3) AS BIGINT) AS person_id, CAST(floor(s_suppkey / 8) AS BIGINT) AS block, s_name AS name,
      CASE s_suppkey % 4 WHEN 0 THEN 'mayor' WHEN 1 THEN 'alderperson' WHEN 2 THEN 'school_board_member' ELSE 'alderperson' END AS office,
      CASE WHEN s_suppkey % 8 = 2 THEN 'sb-1998' WHEN s_suppkey % 8 = 6 THEN 'sb-2001' WHEN CAST(floor(s_suppkey / 4) AS BIGINT) % 3 = 0 THEN 'muni-1997'
        WHEN CAST(floor(s_suppkey / 4) AS BIGINT) % 3 = 1 THEN 'muni-1999' ELSE 'muni-2001' END AS window_id,
      s_suppkey % 3 <> 1 AND s_suppkey % 7 <> 5 AS has_committee, s_suppkey % 3 = 0 OR s_suppkey % 9 = 2 AS owns_committee, s_suppkey % 5 <> 3 AS on_current_record,
      s_suppkey % 4 = 1 AS elsewhere, s_suppkey % 6 = 0 AS incumbent, s_suppkey % 13 = 0 AS write_in,
      CASE s_suppkey % 5 WHEN 0 THEN 'won' WHEN 1 THEN 'lost' END AS result,
      CASE s_suppkey % 11 WHEN 3 THEN 'not_filed' WHEN 7 THEN 'removed' ELSE 'on_ballot' END AS ballot_status,
      CASE WHEN s_suppkey % 10 = 7 THEN 'ran as a write-in' END AS qualifier
    FROM supplier) k JOIN windows w ON k.window_id = w.window_id"""
RECEIPTS = """SELECT c.committee_id, c.donor_id, d.parent_id AS family_id, c.date, c.amount, c.contribution_type = 'In-kind Contribution' AS in_kind,
    CASE WHEN c.is_aggregate THEN 'small' WHEN c.contribution_type = 'Other Receipt' AND NOT c.is_own_committee THEN 'other' ELSE 'direct' END AS stream,
    c.donor_id % 100 = c.committee_id % 100 AS is_self, c.is_own_committee AND c.donor_id % 100 <> c.committee_id % 100 AS is_own
  FROM contributions c JOIN donors d ON c.donor_id = d.donor_id WHERE c.contribution_type <> 'IE Committee Dues Transfer' AND c.committee_id % 23 <> 9"""
SPENDING = """SELECT l_suppkey AS spender_id, CAST(floor(l_partkey / 20) AS BIGINT) AS target_id, CASE l_linestatus WHEN 'F' THEN 'support' ELSE 'oppose' END AS stance,
    CAST(l_shipdate AS DATE) AS date, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem WHERE l_suppkey % 5 = 0"""

HEADS = f""", cards AS ({CARDS}), receipts AS ({RECEIPTS}), spending AS ({SPENDING}),
  owners AS (SELECT person_id, arg_max(candidacy_id, (election, candidacy_id)) AS owner_id FROM cards WHERE owns_committee GROUP BY 1)"""


def figures_sql(readers: str) -> str:
    """Figures and lists of the candidacies in readers (candidacy_id, funding_id, borrowed, start_date, end_date)."""
    within = "(start_date IS NULL OR date >= start_date) AND (end_date IS NULL OR date <= end_date)"
    of = lambda s, c="amount": M.format(f"CASE WHEN stream = '{s}' THEN {c} END")
    count = lambda s: f"CAST(coalesce(sum(CASE WHEN stream = '{s}' THEN n END), 0) AS BIGINT)"
    told = "other || ':' || amount || ':' || n || ':' || CAST(in_kind * 100 AS BIGINT) * 1000 // CAST(amount * 100 AS BIGINT)"
    listed = lambda s: f"coalesce(string_agg(CASE WHEN stream = '{s}' AND rank <= {pages.LISTED} THEN {told} END, ';' ORDER BY rank), '')"
    return f""", read AS (SELECT candidacy_id, CASE WHEN {within} THEN stream WHEN stream = 'direct' AND date < start_date AND NOT borrowed THEN 'before' END AS stream, family_id AS other, date, amount,
        CASE WHEN in_kind THEN amount ELSE 0 END AS in_kind, CASE WHEN is_self THEN amount ELSE 0 END AS self_money, CASE WHEN is_own THEN amount ELSE 0 END AS own_committee
      FROM {readers} JOIN receipts ON committee_id = funding_id WHERE date IS NOT NULL
      UNION ALL SELECT candidacy_id, CASE WHEN {within} THEN stance END, spender_id, date, amount, 0, 0, 0 FROM {readers} JOIN spending ON target_id = candidacy_id),
    lines AS (SELECT candidacy_id, stream, other, sum(amount) AS amount, sum(in_kind) AS in_kind, sum(self_money) AS self_money, sum(own_committee) AS own_committee, count(*) AS n, max(date) AS last
      FROM read WHERE stream IS NOT NULL GROUP BY 1, 2, 3),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY candidacy_id, stream ORDER BY amount DESC, other) AS rank FROM lines),
    figures AS (SELECT candidacy_id, {of('direct')} AS contributions, {of('direct', 'self_money')} AS self_money, {of('direct', 'own_committee')} AS own_committee,
        {of('direct', '(amount - self_money - own_committee)')} AS third_party, {count('direct')} AS gifts, count(CASE WHEN stream = 'direct' THEN 1 END) AS families,
        {of('other')} AS other_receipts, {count('other')} AS other_count, {of('small')} AS small_gifts, {M.format("CASE WHEN stream IN ('direct', 'other', 'small') THEN amount END")} AS raised,
        {of('support')} AS ie_support, {count('support')} AS ie_support_count, {of('oppose')} AS ie_oppose, {count('oppose')} AS ie_oppose_count,
        {of('before')} AS before, {count('before')} AS before_count, max(CASE WHEN stream = 'before' THEN last END) AS before_last,
        {listed('direct')} AS contributors, {listed('support')} AS supporters, {listed('oppose')} AS opponents
      FROM ranked GROUP BY 1)"""


def told(lines: Column) -> Column:
    """A list as text: counterparty, amount, number and the share in kind, in thousandths."""
    cents = lambda c: (c * 100).cast("long")
    share = lambda x: F.floor(cents(x["in_kind"]) * 1000 / cents(x["amount"])).cast("long")
    return F.array_join(F.transform(lines, lambda x: F.concat_ws(":", x["other"].cast("string"), x["amount"].cast("string"), x["n"].cast("string"), share(x).cast("string"))), ";")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.tagged(given(spark, sf_dir, RECEIPTS), given(spark, sf_dir, SPENDING))


FIGURES = [
    "contributions", "self_money", "own_committee", "third_party", "gifts", "families", "other_receipts", "other_count", "small_gifts", "raised",
    "ie_support", "ie_support_count", "ie_oppose", "ie_oppose_count", "before", "before_count", "before_last",
]
FACETS = ["race_id", "candidacy_id", "name", "office", "election", "incumbent", "result", "ballot_status", "off_ballot", "write_in", "finance_facet", "has_finance", "prior_election", "funding_id", "borrowed", "filed_under", "race_has_finance"]


@query("ag48_race_view", oracle(HEADS + """, f AS (SELECT c.*, owner_id, CASE WHEN has_committee THEN candidacy_id WHEN on_current_record THEN owner_id END AS fid FROM cards c LEFT JOIN owners o ON c.person_id = o.person_id),
    g AS (SELECT *, office = 'alderperson' AND fid IS NOT NULL AND fid NOT IN (SELECT committee_id FROM receipts) AS no_itemized FROM f),
    k AS (SELECT *, CASE WHEN NOT no_itemized THEN fid END AS funding_id, NOT no_itemized AND coalesce(fid <> candidacy_id, false) AS borrowed, lag(election) OVER (PARTITION BY person_id ORDER BY election, candidacy_id) AS prior_election FROM g)"""
    + figures_sql("k")
    + """, v AS (SELECT k.*, coalesce(vacating_for IN (SELECT race_id FROM cards), false) AS gone FROM k),
    r AS (SELECT race_id, bool_or(funding_id IS NOT NULL) AS race_has_finance, coalesce(string_agg(CASE WHEN gone THEN name || '>' || vacating_for END, ';' ORDER BY name, vacating_for), '') AS vacating FROM v GROUP BY 1)
  SELECT v.race_id, v.candidacy_id, v.name, v.office, v.election, v.incumbent, v.result, v.ballot_status, v.ballot_status IN ('not_filed', 'removed') AS off_ballot, v.write_in,
    CASE WHEN v.no_itemized THEN 'committee_no_itemized' WHEN v.office = 'alderperson' AND NOT v.has_committee AND v.funding_id IS NULL THEN CASE WHEN v.elsewhere THEN 'committee_elsewhere' ELSE 'no_committee' END END AS finance_facet,
    v.funding_id IS NOT NULL AS has_finance, v.prior_election, v.funding_id, v.borrowed, CASE WHEN v.borrowed THEN o.election END AS filed_under, r.race_has_finance,
    """ + ", ".join(f"p.{c}" for c in [*FIGURES, "contributors", "supporters", "opponents"]) + """, r.vacating
  FROM v JOIN r ON v.race_id = r.race_id LEFT JOIN figures p ON p.candidacy_id = v.candidacy_id LEFT JOIN cards o ON o.candidacy_id = v.funding_id WHERE NOT v.gone"""))
def ag48(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.race_cards(given(spark, sf_dir, CARDS), facts(spark, sf_dir))
    vacating = F.array_join(F.transform("vacating", lambda x: F.concat_ws(">", x["name"], x["vacating_for"])), ";")
    return rows.select(*FACETS, *FIGURES, *[told(F.col(c)).alias(c) for c in ("contributors", "supporters", "opponents")], vacating.alias("vacating"))


@query("ag49_person_view", oracle(HEADS + """, k AS (SELECT c.*, owner_id AS funding_id, true AS borrowed FROM cards c LEFT JOIN owners o ON c.person_id = o.person_id)"""
    + figures_sql("k")
    + """, away AS (SELECT k.funding_id, bool_or(NOT EXISTS (SELECT 1 FROM k j WHERE j.funding_id = r.committee_id AND r.date IS NOT NULL AND (j.start_date IS NULL OR r.date >= j.start_date) AND (j.end_date IS NULL OR r.date <= j.end_date))) AS out_of_window
      FROM (SELECT DISTINCT funding_id FROM k WHERE funding_id IS NOT NULL) k JOIN (SELECT DISTINCT committee_id, date FROM receipts WHERE stream = 'direct') r ON r.committee_id = k.funding_id GROUP BY 1)
  SELECT k.person_id, k.candidacy_id, CAST(row_number() OVER (PARTITION BY k.person_id ORDER BY k.election DESC, k.candidacy_id DESC) AS INT) AS place, k.election, k.office, k.race_id, k.qualifier, k.funding_id AS owner_id,
    """ + ", ".join(f"p.{c}" for c in ("contributions", "self_money", "own_committee", "third_party", "gifts", "other_receipts", "other_count", "ie_support", "ie_support_count", "ie_oppose", "ie_oppose_count")) + """,
    CAST(sum(coalesce(p.contributions, 0)) OVER (PARTITION BY k.person_id) AS DECIMAL(18,2)) AS career, coalesce(a.out_of_window, false) AS out_of_window
  FROM k LEFT JOIN figures p ON p.candidacy_id = k.candidacy_id LEFT JOIN away a ON a.funding_id = k.funding_id"""))
def ag49(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.person_sections(given(spark, sf_dir, CARDS), facts(spark, sf_dir))
    figures = ["contributions", "self_money", "own_committee", "third_party", "gifts", "other_receipts", "other_count", "ie_support", "ie_support_count", "ie_oppose", "ie_oppose_count"]
    return rows.select("person_id", "candidacy_id", "place", "election", "office", "race_id", "qualifier", "owner_id", *figures, "career", "out_of_window")


MEMBERS = """SELECT s_suppkey AS member_id, 'seat-' || CAST(s_suppkey % 21 AS VARCHAR(20)) AS seat, CASE s_suppkey % 9 WHEN 0 THEN 'vacancy' WHEN 1 THEN '' WHEN 2 THEN 'c-' || CAST(s_suppkey + 2 AS VARCHAR(20))
    WHEN 3 THEN 'p-' || CAST(s_suppkey + 100000000 AS VARCHAR(20)) ELSE 'p-' || CAST(CAST(floor(s_suppkey / 3) AS BIGINT) AS VARCHAR(20)) END AS candidacy_ref FROM supplier"""
#: Itemized lines of the candidacies' own committees in their own windows.
DONATED = """SELECT c.candidacy_id, c.election, r.donor_id, CAST(sum(r.amount) AS DECIMAL(18,2)) AS amount, count(*) AS n, r.is_self FROM cards c JOIN receipts r ON r.committee_id = c.candidacy_id
    WHERE c.has_committee AND r.stream = 'direct' AND r.date IS NOT NULL AND (c.start_date IS NULL OR r.date >= c.start_date) AND (c.end_date IS NULL OR r.date <= c.end_date) GROUP BY c.candidacy_id, c.election, r.donor_id, r.is_self"""
RECORDS = HEADS + f", members AS ({MEMBERS}), donated AS ({DONATED}), k AS (SELECT *, CASE WHEN has_committee THEN candidacy_id END AS funding_id, false AS borrowed FROM cards)" + figures_sql("k") + f""",
    ranked_donors AS (SELECT *, row_number() OVER (PARTITION BY candidacy_id ORDER BY amount DESC, donor_id) AS rank FROM donated WHERE NOT is_self),
    listed AS (SELECT candidacy_id, string_agg(CASE WHEN rank <= {pages.LISTED} THEN donor_id || ':' || amount || ':' || n END, ';' ORDER BY rank) AS donors, count(*) AS donor_count, sum(amount) AS covered FROM ranked_donors GROUP BY 1),
    selves AS (SELECT candidacy_id, count(*) AS self_funders FROM donated WHERE is_self GROUP BY 1),
    m AS (SELECT *, CASE WHEN candidacy_ref = '' THEN 'no_record' WHEN candidacy_ref = 'vacancy' THEN 'vacancy' WHEN candidacy_ref LIKE 'p-%' THEN 'full' ELSE 'totals_only' END AS finance_state FROM members),
    records AS (SELECT m.member_id, m.seat, m.finance_state, k.candidacy_id, k.election, k.funding_id AS committee_id,
      """ + ", ".join(f"CASE WHEN k.candidacy_id IS NOT NULL THEN coalesce(p.{c}, 0::DECIMAL(18,2)) END AS {c}" for c in ("contributions", "other_receipts", "small_gifts", "ie_support", "ie_oppose")) + """,
      CASE WHEN m.finance_state = 'full' THEN l.donors END AS donors, CASE WHEN m.finance_state = 'full' THEN coalesce(l.donor_count, 0) END AS donor_count, CASE WHEN m.finance_state = 'full' THEN coalesce(s.self_funders, 0) END AS self_funders,
      CASE WHEN m.finance_state = 'full' AND p.contributions > 0 THEN CAST(l.covered * 100 AS BIGINT) * 1000 // CAST(p.contributions * 100 AS BIGINT) END AS coverage_milli,
      m.finance_state = 'full' AND coalesce(l.donor_count, 0) > 0 AS has_donor_detail
    FROM m LEFT JOIN k ON (m.finance_state = 'full' AND 'p-' || k.person_id = m.candidacy_ref) OR (m.finance_state = 'totals_only' AND 'c-' || k.candidacy_id = m.candidacy_ref)
      LEFT JOIN figures p ON p.candidacy_id = k.candidacy_id LEFT JOIN listed l ON l.candidacy_id = k.candidacy_id LEFT JOIN selves s ON s.candidacy_id = k.candidacy_id)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = given(spark, sf_dir, CARDS)
    own = cards.filter("has_committee").select("candidacy_id", "election", "start_date", "end_date")
    lines = pages.read_in_window(raw(spark, sf_dir, "lineitem"), "l_suppkey", F.col("l_shipdate").cast("date"), own)
    receipts = given(spark, sf_dir, RECEIPTS, {"lineitem": lines})
    within = pages.inside(F.col("start_date"), F.col("end_date"), F.col("date"))
    donated = receipts.filter("stream = 'direct'").join(own, F.col("committee_id") == F.col("candidacy_id")).filter(within)
    donated = donated.groupBy("candidacy_id", "election", "donor_id", "is_self").agg(total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("n"))
    return pages.member_records(given(spark, sf_dir, MEMBERS), cards, pages.tagged(receipts, given(spark, sf_dir, SPENDING)), donated)


@query("ag55_member_records", oracle(RECORDS + " SELECT * FROM records"))
def ag55(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform("donors", lambda x: F.concat_ws(":", x["donor_id"].cast("string"), x["amount"].cast("string"), x["n"].cast("string")))
    return records(spark, sf_dir).withColumn("donors", F.array_join(lines, ";")).drop("candidacy_ref")


@query("ag55_member_states", oracle(RECORDS + """ SELECT finance_state AS state, count(DISTINCT member_id) AS n, count(candidacy_id) AS elections, CAST(coalesce(sum(donor_count), 0) AS BIGINT) AS donor_rows FROM records GROUP BY 1"""))
def ag55_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = records(spark, sf_dir).groupBy(F.col("finance_state").alias("state"))
    return by.agg(F.countDistinct("member_id").alias("n"), F.count("candidacy_id").alias("elections"), F.coalesce(F.sum("donor_count"), F.lit(0)).cast("long").alias("donor_rows"))
