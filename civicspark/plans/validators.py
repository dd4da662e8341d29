"""Queries of the families of data-quality rules, over tables with planted faults.

`PLANTED` makes the checked tables from all rows of the given ones, in SQL that Spark and DuckDB both read; each
fault is planted by a rule on ids. The rules themselves are written twice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions import money
from civicspark.operators import validators
from civicspark.sources.work import folder

from .model import given, model, oracle
from .registry import query

RECEIPT = "IE Committee Receipt"
D = "DECIMAL(18,2)"

PLANTED = {
    # Votes, their featured entries, positions by seat, and the roster.
    "v_votes": """SELECT o_orderkey - CASE WHEN o_orderkey % 50 = 1 THEN 1 ELSE 0 END AS vote_id,
        CASE WHEN o_orderkey % 31 <> 3 THEN CAST(o_orderdate AS DATE) END AS date,
        CASE WHEN o_orderkey % 41 = 5 THEN 'ordinance' WHEN o_orderkey % 41 <> 6 THEN '["ordinance"]' END AS type FROM orders""",
    "v_meta": "SELECT p_partkey AS code, p_partkey * 9 AS vote_id, CASE WHEN p_partkey % 60 = 7 THEN true END AS reverse_coded FROM part",
    "v_positions": "SELECT l_orderkey AS vote_id, l_partkey % 47 AS seat FROM lineitem",
    "v_roster": "SELECT c_custkey % 45 AS seat, c_custkey * 2 AS code FROM customer",
    "v_declared": "SELECT count(*) + 1 AS term_votes FROM orders",
    # People, their candidacies, and money by year.
    "v_cand": f"""SELECT o_orderkey AS candidacy_id, o_custkey AS person_id, CAST(extract(year FROM o_orderdate) AS VARCHAR(4)) || '-m' AS election_id,
        CAST(o_totalprice AS {D}) AS direct, o_orderkey % 3 = 0 AS on_current_record, o_orderkey % 2 = 0 AS owns_committee FROM orders""",
    "v_member": """SELECT person_id, CASE WHEN candidacy_id % 53 = 1 THEN -1 - candidacy_id ELSE candidacy_id END AS candidacy_id,
        CASE WHEN candidacy_id % 59 = 2 THEN '1901-m' ELSE election_id END AS election_id, owns_committee FROM v_cand WHERE person_id % 29 <> 3""",
    "v_person": f"""SELECT c_custkey AS person_id, CASE WHEN c_custkey % 37 = 5 THEN ' ' ELSE c_name END AS display_name,
        CAST(coalesce(t, 0) + CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS {D}) AS total FROM customer
        LEFT JOIN (SELECT m.person_id AS p, sum(CASE WHEN m.owns_committee THEN c.direct ELSE 0 END) AS t
          FROM v_member m JOIN v_cand c ON m.candidacy_id = c.candidacy_id GROUP BY m.person_id) q ON p = c_custkey""",
    "v_year": f"SELECT person_id, substring(election_id, 1, 4) AS year, CAST(sum(direct) AS {D}) AS amount FROM v_cand WHERE candidacy_id % 2 = 0 GROUP BY 1, 2",
    # Candidacies that claim committees.
    "v_claim": f"""SELECT o_orderkey AS candidate_id, CASE WHEN o_orderkey % 20 = 0 AND o_orderkey % 75 < 25 THEN o_orderkey % 75 * 3
          WHEN o_orderkey % 9 <> 4 THEN o_custkey END AS filing_id, CAST(o_orderdate AS DATE) AS election_date, -o_orderkey AS ord,
        CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice ELSE 0 END AS {D}) AS direct, o_orderkey % 75 AS race_id, o_orderkey % 10 = 0 AS incumbent FROM orders""",
    "v_comm": """SELECT c_custkey AS committee_id, CASE WHEN c_custkey % 21 <> 2 THEN c_custkey END AS filing_id,
        CASE WHEN c_custkey % 5 = 0 THEN 'independent_expenditure' ELSE 'candidate' END AS type, CASE WHEN c_custkey % 7 <> 2 THEN last END AS candidate_id
        FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS last FROM orders GROUP BY o_custkey) q ON o_custkey = c_custkey""",
    "v_owns": "SELECT o_custkey AS person_id, o_orderkey AS candidate_id, o_orderkey % 2 = 0 AS owns_committee FROM orders",
    "v_race": """SELECT n_nationkey AS race_id, CASE WHEN n_nationkey % 4 = 3 THEN 'mayor' ELSE 'alderperson' END AS office,
        CASE WHEN n_nationkey % 6 <> 5 THEN n_nationkey + 1 END AS ward FROM nation""",
    "v_ward": "SELECT n_nationkey + 1 AS ward, n_nationkey * 3 AS mapped FROM nation WHERE n_nationkey % 8 <> 6",
    # Money to spenders, typed as such but for planted rows, and the stored parts of each parent.
    "v_fact": f"""SELECT CAST(c.source_filing AS VARCHAR(20)) || '-' || CAST(c.line AS VARCHAR(4)) AS key, d.parent_id, c.committee_id, c.amount,
        CASE WHEN c.contribution_type = 'IE Committee Dues Transfer' THEN c.contribution_type
          WHEN (c.committee_id % 5 = 0) <> (c.source_filing % 101 = 3) THEN '{RECEIPT}' ELSE c.contribution_type END AS contribution_type,
        c.date >= DATE '1995-06-01' AND NOT c.is_aggregate AND d.type <> 'Aggregate' AND (c.contribution_type <> 'Other Receipt' OR c.is_own_committee) AS counted
        FROM contributions c JOIN donors d ON c.donor_id = d.donor_id""",
    "v_stored": f"""SELECT parent_id, CAST(d + CASE WHEN parent_id % 13 = 0 THEN 1 ELSE 0 END AS {D}) AS direct, CAST(i AS {D}) AS independent,
        CAST(d + i + CASE WHEN parent_id % 17 = 0 THEN 1 ELSE 0 END AS {D}) AS total FROM (SELECT parent_id,
          sum(CASE WHEN contribution_type = '{RECEIPT}' THEN 0 ELSE amount END) AS d, sum(CASE WHEN contribution_type = '{RECEIPT}' THEN amount ELSE 0 END) AS i
          FROM v_fact WHERE counted AND contribution_type <> 'IE Committee Dues Transfer' GROUP BY parent_id) q""",
    # Reports of ten inputs each.
    "v_input": """SELECT c_custkey - c_custkey % 10 AS report_id, c_name AS name, CASE WHEN c_custkey % 23 <> 4 THEN 'vintage/' || c_name END AS path,
        CASE WHEN c_custkey % 19 = 3 THEN '' WHEN c_custkey % 17 = 5 THEN md5('old') ELSE md5(c_mktsegment) END AS sha FROM customer""",
    "v_current": "SELECT c_name AS name, md5(c_mktsegment) AS now FROM customer WHERE c_custkey % 31 <> 6",
    "v_known": """SELECT c_custkey - c_custkey % 10 AS report_id, c_name AS name, CASE WHEN c_custkey % 4 <> 1 THEN 'ops' END AS owner, 'refresh' AS removal,
        CASE WHEN (c_custkey - c_custkey % 10) % 30 = 20 THEN 0 ELSE 5 END AS most FROM customer WHERE c_custkey % 17 = 5 OR c_custkey % 47 = 8""",
    "v_run": f"""SELECT c_custkey AS report_id, CASE WHEN c_custkey % 70 = 0 THEN NULL WHEN c_custkey % 90 = 0 THEN 'soon'
          ELSE '2026-08-1' || CAST(c_nationkey % 10 AS VARCHAR(1)) END AS data_through, '2026-08-15' AS pulled, CAST(c_acctbal AS {D}) AS residual
        FROM customer WHERE c_custkey % 10 = 0""",
    "v_string": """SELECT c_custkey - c_custkey % 10 AS report_id, 'run.' || CAST(c_custkey % 10 AS VARCHAR(1)) AS path, CASE WHEN c_custkey % 33 = 1 THEN '/data/x'
          WHEN c_custkey % 33 = 2 THEN 'x/home/y' ELSE 'vintage/' || c_name END AS value FROM customer WHERE c_custkey - c_custkey % 10 <> 50""",
    "v_gap": f"SELECT c_custkey AS report_id, CAST(c_acctbal AS {D}) AS amount FROM customer WHERE c_custkey % 10 = 0 AND c_custkey % 80 <> 0",
    # Seats, donor lists, their items and coverage.
    "v_seat": """SELECT c_custkey AS seat, CASE WHEN c_custkey % 12 = 3 THEN '' ELSE c_name END AS name,
        CASE WHEN c_custkey % 50 = 7 THEN 'inc-1' ELSE CAST(c_custkey * 3 AS VARCHAR(20)) END AS ref, CASE WHEN c_custkey % 30 = 5 THEN 'other' WHEN c_custkey % 6 = 0 THEN 'person'
          WHEN c_custkey % 6 = 3 THEN 'vacancy' WHEN c_custkey % 3 = 1 THEN 'candidate' ELSE 'none' END AS kind FROM customer""",
    "v_stand": "SELECT CAST(o_orderkey * 2 AS VARCHAR(20)) AS candidate_id FROM orders",
    "v_link": "SELECT CAST(o_custkey * 2 AS VARCHAR(20)) AS person_id, CAST(o_orderkey * 4 AS VARCHAR(20)) AS candidate_id FROM orders",
    "v_gift": f"""SELECT l_suppkey AS seat, CAST(extract(year FROM l_shipdate) AS VARCHAR(4)) AS election, l_partkey % 30 AS donor_id,
        CASE WHEN l_orderkey % 97 <> 3 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) END AS date, CAST(l_extendedprice AS {D}) AS amount FROM lineitem""",
    "v_item": "SELECT * FROM v_gift WHERE donor_id <> 4",
    "v_donor": f"""SELECT seat, election, donor_id, CAST(sum(amount) + CASE WHEN donor_id = 7 THEN 1 ELSE 0 END AS {D}) AS amount,
        count(*) + CASE WHEN donor_id = 9 THEN 1 ELSE 0 END AS n FROM v_gift GROUP BY 1, 2, 3""",
    "v_source": f"SELECT seat, election, CAST(sum(amount) AS {D}) AS direct, CAST(seat % 3 * 10 AS {D}) AS self_funding, CAST(seat AS {D}) AS ie_support, CAST(7 AS {D}) AS ie_oppose, count(*) AS n FROM v_donor GROUP BY 1, 2",
    "v_figure": f"""SELECT seat, election, CAST(direct + CASE WHEN seat % 7 = 2 THEN 5 WHEN seat % 7 = 4 THEN -self_funding ELSE 0 END AS {D}) AS direct, self_funding,
        CAST(ie_support + CASE WHEN seat % 9 = 5 THEN 1 ELSE 0 END AS {D}) AS ie_support, ie_oppose FROM v_source""",
    "v_cover": f"""SELECT seat, election, CAST(direct + CASE WHEN seat % 5 = 1 THEN 1 ELSE 0 END AS {D}) AS dollars, CAST(direct + CASE WHEN seat % 9 = 2 THEN 1 ELSE 0 END AS {D}) AS donor_total,
        n + CASE WHEN seat % 8 = 3 THEN 1 ELSE 0 END AS donor_count, CAST(CASE WHEN seat % 6 = 4 THEN 0.5 ELSE 1 END AS DOUBLE) AS share_sum,
        CAST(seat % 4 AS DOUBLE) AS substantive_share, seat % 8 < 4 AS meets, CAST(2 AS DOUBLE) AS threshold FROM v_source""",
    "v_self": "SELECT s_suppkey AS seat, s_suppkey % 30 AS donor_id FROM supplier",
    "v_used": "SELECT p_name AS tag FROM part",
    "v_vocabulary": """SELECT p_name AS tag, min(CASE WHEN p_partkey % 10 = 1 THEN '' ELSE 'label' END) AS label, 'red' AS colour FROM part WHERE length(p_name) % 5 <> 3 GROUP BY p_name
        UNION ALL SELECT DISTINCT p_brand || ' unused', 'label', 'red' FROM part""",
    "v_clusters_used": "SELECT c_custkey % 40 AS cluster_id FROM customer",
    "v_clusters": "SELECT n_nationkey AS cluster_id FROM nation",
    "v_slice": """SELECT CASE WHEN date <= DATE '1997-02-28' THEN 'muni-1997' WHEN date <= DATE '1999-02-28' THEN 'muni-1999' ELSE 'muni-2001' END AS election,
        spender_id, date, amount FROM expenditures""",
    "v_spender": f"SELECT election, spender_id, CAST(sum(amount) + CASE WHEN spender_id % 10 = 0 THEN 1 ELSE 0 END AS {D}) AS amount FROM v_slice GROUP BY 1, 2",
    "v_window": "SELECT window_id AS election, start_date, end_date FROM windows WHERE office_type = 'municipal'",
    # A board's page: its committees, the facts, and what the page says of them; one committee in seven serves two seats.
    "v_scope": """SELECT s_suppkey % 21 AS seat, s_suppkey AS committee_id FROM supplier WHERE s_suppkey % 4 = 2
        UNION ALL SELECT (s_suppkey + 1) % 21, s_suppkey FROM supplier WHERE s_suppkey % 28 = 2""",
    "v_scope_fact": """SELECT committee_id, donor_id, date, amount, contribution_type = 'Other Receipt' AND NOT is_own_committee AND NOT is_aggregate AS other_receipt,
        CASE source_filing % 3 WHEN 0 THEN 'quarterly' WHEN 1 THEN 'large_gift' END AS report, donor_id % 50 = committee_id % 50 AS is_self FROM contributions""",
    "v_scope_said": f"""SELECT CAST(sum(CASE WHEN other_receipt AND s IS NOT NULL THEN amount ELSE 0 END) + 1 AS {D}) AS other_amount, count(CASE WHEN other_receipt AND s IS NOT NULL THEN 1 END) AS other_count,
        max(CASE WHEN report = 'quarterly' THEN date END) AS quarterly, DATE '2003-01-01' AS large_gift, DATE '2002-06-30' AS built
        FROM v_scope_fact LEFT JOIN (SELECT DISTINCT committee_id AS s FROM v_scope) q ON committee_id = s""",
    "v_scope_self": """SELECT DISTINCT v.seat, CASE WHEN f.donor_id % 12 = 5 THEN -f.donor_id ELSE f.donor_id END AS donor_id FROM v_scope_fact f JOIN v_scope v ON f.committee_id = v.committee_id
        WHERE f.is_self AND f.donor_id % 9 <> 4""",
    "v_scope_list": """SELECT DISTINCT v.seat, f.donor_id FROM v_scope_fact f JOIN v_scope v ON f.committee_id = v.committee_id WHERE NOT f.is_self OR f.donor_id % 40 = 6""",
    # The home page and the facts it is made from.
    "v_home_fact": """SELECT d.parent_id AS donor_id, c.committee_id, CASE WHEN m.type = 'candidate' THEN m.office ELSE 'groups' END AS stream,
        CASE WHEN c.date <= DATE '1997-05-31' THEN '1997' WHEN c.date <= DATE '1999-05-31' THEN '1999' ELSE '2001' END AS cycle, c.amount,
        m.type <> 'candidate' AND c.is_own_committee AS own_group
        FROM contributions c JOIN donors d ON c.donor_id = d.donor_id JOIN committees m ON c.committee_id = m.committee_id WHERE c.date >= DATE '1995-06-01'""",
    "v_home_total": "SELECT donor_id, cycle, sum(amount) AS amount FROM v_home_fact WHERE NOT own_group GROUP BY 1, 2",
    "v_home_large": "SELECT donor_id, sum(amount) AS total FROM v_home_total GROUP BY 1 HAVING sum(amount) >= 1000",
    "v_home_donor": f"""SELECT t.donor_id, t.cycle, t.donor_id AS place, CAST(t.amount + CASE WHEN t.donor_id % 15 = 2 THEN 1 ELSE 0 END AS {D}) AS amount
        FROM v_home_total t JOIN v_home_large l ON t.donor_id = l.donor_id WHERE t.donor_id % 25 <> 6""",
    "v_home_item": f"""SELECT donor_id, committee_id, CAST(sum(amount) AS {D}) AS amount FROM v_home_fact WHERE NOT own_group AND donor_id % 6 <> 1 GROUP BY 1, 2""",
    "v_home_recipient": """SELECT committee_id, office, CASE WHEN committee_id % 13 <> 5 THEN committee_id END AS filing_id,
        CASE WHEN office = 'mayor' THEN 'mayor-' || CAST(CASE WHEN committee_id % 20 = 8 THEN 0 ELSE committee_id END AS VARCHAR(20)) WHEN committee_id % 21 <> 1 THEN 'p-' || CAST(person_id AS VARCHAR(20)) END AS person
        FROM committees WHERE committee_id % 9 <> 4""",
    "v_home_cand": """SELECT committee_id AS filing_id, 'cand-' || CAST(committee_id AS VARCHAR(20)) || '-x' AS candidacy_id, CASE WHEN office = 'mayor' THEN 'mayor' ELSE 'other' END AS race,
        CASE WHEN committee_id % 6 <> 5 THEN 'p-' || CAST(person_id AS VARCHAR(20)) END AS person FROM committees WHERE committee_id % 16 <> 4""",
    "v_home_stream": f"""SELECT CASE WHEN own_group THEN 'own_group' ELSE stream END AS stream, CAST(sum(amount) + max(CASE WHEN stream = 'mayor' THEN 1 ELSE 0 END) AS {D}) AS amount
        FROM v_home_fact GROUP BY 1""",
    "v_home_spending": "SELECT spender_id AS group_id, amount FROM expenditures WHERE date >= DATE '1995-06-01'",
    "v_home_group": f"SELECT group_id, CAST(sum(amount) + CASE WHEN group_id % 10 = 5 THEN 1 ELSE 0 END AS {D}) AS amount FROM v_home_spending GROUP BY 1",
    "v_home_vote": "SELECT DISTINCT date, vote_id, CASE WHEN substring(vote_id, 12, 2) < '12' THEN 'council' ELSE 'school_board' END AS body FROM person_votes",
    "v_home_feed": """SELECT date, CASE WHEN body = 'council' OR substring(vote_id, 12, 2) < '20' THEN vote_id ELSE 'lost' END AS vote_id, body,
          CASE WHEN body = 'school_board' THEN '/votes?vote=' || vote_id || CASE WHEN substring(vote_id, 12, 2) = '19' THEN '0' ELSE '' END END AS link
        FROM (SELECT * FROM v_home_vote ORDER BY date DESC, body DESC, vote_id DESC LIMIT 10) q""",
    "v_home_input": "SELECT c_name AS name, md5(c_mktsegment) AS now, CASE WHEN c_custkey % 33 = 5 THEN '' ELSE md5(c_mktsegment) END AS sha FROM customer",
}


def planted(body: str) -> str:
    """A statement with the planted tables that it names, and those that they name."""
    named: set[str] = set()
    todo = [body]
    while todo:
        found = [n for n in PLANTED if n not in named and re.search(rf"\b{n}\b", todo[-1])]
        todo.pop()
        named.update(found)
        todo.extend(PLANTED[n] for n in found)
    heads = ", ".join(f"{n} AS ({s})" for n, s in PLANTED.items() if n in named)
    return f", {heads} {body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return given(spark, sf_dir, planted(f"SELECT * FROM {name}"))


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in names]


def stored(spark: SparkSession, sf_dir: str, names: list[str], kept: list[str]) -> dict[str, DataFrame]:
    """Planted tables by name. Those in kept are written once, in the order in which they need each other; the rest read
    what is written, so that each given table is read for one of them only."""
    made: dict[str, DataFrame] = {}

    def needs(name: str) -> list[str]:
        found = [n for n in PLANTED if re.search(rf"\b{n}\b", PLANTED[name])]
        return [*dict.fromkeys(x for n in found for x in ([n] if n in made else [*needs(n), n]))]

    for name in sorted(names, key=lambda n: (n not in kept, list(PLANTED).index(n))):
        chain = needs(name)
        heads = ", ".join(f"{n} AS ({PLANTED[n]})" for n in [*chain, name] if n not in made)
        df = given(spark, sf_dir, f", {heads} SELECT * FROM {name}", {n: made[n] for n in chain if n in made})
        if name in kept:
            path = folder(spark, name)
            df.write.parquet(path)
            df = spark.read.schema(df.schema).parquet(path)
        made[name] = df
    return made


def rule(name: str, rows: str, key: str, detail: str = "''", severity: str = "error") -> str:
    """SQL of one rule's violations; rows is what follows FROM."""
    quoted = name.replace("'", "''")
    return f"SELECT '{quoted}' AS rule, '{severity}' AS severity, CAST({key} AS VARCHAR) AS key, CAST({detail} AS VARCHAR) AS detail FROM {rows}"


def rules(*parts: str, heads: str = "") -> str:
    return oracle(planted(heads + " " + " UNION ALL ".join(parts)))


def grouped_twice(name: str, rows: str, key: str) -> str:
    return rule(name, f"(SELECT {key} AS k, count(*) AS n FROM {rows} GROUP BY 1 HAVING count(*) > 1)", "k", "n")


def lost(name: str, rows: str, key: str, known: str, known_key: str, severity: str = "error") -> str:
    """Distinct values of key that known doesn't have."""
    return rule(name, f"(SELECT DISTINCT {key} AS k FROM {rows} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {known_key} FROM {known} WHERE {known_key} IS NOT NULL))", "k", severity=severity)


@query("dq3_vote_family", rules(
    grouped_twice("vote id is unique", "v_votes", "vote_id"),
    rule("declared count is the count", "(SELECT count(*) AS n, (SELECT term_votes FROM v_declared) AS said FROM v_votes) WHERE n <> said", "'votes'", "said || ' vs ' || n"),
    rule("vote is dated", "v_votes WHERE date IS NULL", "vote_id"),
    rule("type is a list as text", "v_votes WHERE type NOT LIKE '[%]'", "vote_id"),
    rule("featured vote resolves", "v_meta WHERE vote_id NOT IN (SELECT vote_id FROM v_votes)", "code"),
    rule("retired field is absent", "v_meta WHERE reverse_coded IS NOT NULL", "code"),
    lost("code resolves", "v_roster", "code", "v_meta", "code"),
    lost("seat resolves", "v_positions", "seat", "v_roster", "seat"),
))
def dq3_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validators.vote_rules(*tables(spark, sf_dir, "v_votes", "v_meta", "v_positions", "v_roster", "v_declared"))


@query("dq8_person_family", rules(
    rule("person has members", "p WHERE n IS NULL", "person_id"),
    rule("person has a name", "p WHERE trim(display_name) = ''", "person_id"),
    rule("total is the sum owned", "p WHERE abs(total - coalesce(owned, 0)) > 0.01", "person_id"),
    rule("member exists", "m WHERE actual IS NULL", "candidacy_id"),
    rule("member's election is its own", "m WHERE election_id <> actual", "candidacy_id"),
    lost("flag has a link", "(SELECT candidacy_id FROM v_cand WHERE on_current_record)", "candidacy_id", "prior", "candidacy_id"),
    lost("link has a flag", "prior", "candidacy_id", "(SELECT candidacy_id FROM v_cand WHERE on_current_record)", "candidacy_id"),
    rule("no spenders' key", "(SELECT 1)", "'persons'", "'ie_support'"),
    heads=""", m AS (SELECT v.*, c.election_id AS actual, c.direct FROM v_member v LEFT JOIN v_cand c ON v.candidacy_id = c.candidacy_id)
      , per AS (SELECT person_id, count(*) AS n, sum(CASE WHEN owns_committee THEN coalesce(direct, 0) ELSE 0 END) AS owned FROM m GROUP BY 1)
      , p AS (SELECT v.*, n, owned FROM v_person v LEFT JOIN per ON v.person_id = per.person_id)
      , earliest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY election_id, candidacy_id) AS o FROM m) WHERE o = 1)
      , prior AS (SELECT e.candidacy_id FROM earliest e JOIN p ON e.person_id = p.person_id JOIN v_year y ON y.person_id = e.person_id AND y.year = substring(e.election_id, 1, 4)
          WHERE p.n >= 2 AND p.total > 0 AND y.amount > 0)""",
))
def dq8_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons, *rest = tables(spark, sf_dir, "v_person", "v_member", "v_cand", "v_year")
    return validators.person_rules(persons.withColumn("ie_support", F.lit(0)), *rest, ["independent", "ie_support", "ie_oppose"])


@query("dq10_committee_linkage", rules(
    rule("stamp is the owner", "v_comm c JOIN owners w ON c.filing_id = w.filing_id WHERE c.type = 'candidate' AND c.candidate_id IS DISTINCT FROM w.candidate_id", "c.committee_id"),
    rule("money has its own claim", "v_claim k WHERE direct <> 0 AND NOT EXISTS (SELECT 1 FROM v_comm c WHERE c.candidate_id = k.candidate_id AND c.filing_id = k.filing_id)", "k.candidate_id"),
    rule("flag of ownership agrees", "v_owns o WHERE o.owns_committee <> (o.candidate_id IN (SELECT candidate_id FROM owners))", "o.person_id || '/' || o.candidate_id"),
    heads=", owners AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY filing_id ORDER BY election_date DESC, ord) AS o FROM v_claim WHERE filing_id IS NOT NULL) WHERE o = 1)",
))
def dq10_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validators.linkage_rules(*tables(spark, sf_dir, "v_comm", "v_claim", "v_owns"))


@query("dq12_ward_linkage", rules(
    grouped_twice("committee is used once", "v_claim WHERE filing_id IS NOT NULL", "filing_id"),
    rule("committee exists", "v_claim WHERE filing_id NOT IN (SELECT filing_id FROM v_comm WHERE filing_id IS NOT NULL)", "candidate_id", severity="warning"),
    rule("incumbent has the ward's committee", """v_claim c JOIN v_race r ON c.race_id = r.race_id LEFT JOIN v_ward w ON r.ward = w.ward
        WHERE c.incumbent AND r.office = 'alderperson' AND r.ward IS NOT NULL AND c.filing_id IS DISTINCT FROM w.mapped""", "c.candidate_id"),
))
def dq12_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validators.ward_rules(*tables(spark, sf_dir, "v_claim", "v_race", "v_comm", "v_ward"))


@query("dq14_spender_split", rules(
    rule("typed row goes to a spender", f"v_fact f JOIN committees c ON f.committee_id = c.committee_id WHERE contribution_type = '{RECEIPT}' AND c.type = 'candidate'", "f.key"),
    rule("row to a spender is typed", f"v_fact f JOIN committees c ON f.committee_id = c.committee_id WHERE contribution_type NOT IN ('{RECEIPT}', 'IE Committee Dues Transfer') AND c.type <> 'candidate'", "f.key"),
    rule("parts are the recount", "j WHERE coalesce(direct, 0) <> coalesce(d, 0) OR coalesce(independent, 0) <> coalesce(i, 0)", "k"),
    rule("parts make the total", "j WHERE coalesce(direct, 0) = coalesce(d, 0) AND coalesce(independent, 0) = coalesce(i, 0) AND direct + independent <> total", "k"),
    heads=f""", again AS (SELECT parent_id, sum(amount) FILTER (contribution_type <> '{RECEIPT}') AS d, sum(amount) FILTER (contribution_type = '{RECEIPT}') AS i
        FROM v_fact WHERE counted AND contribution_type <> 'IE Committee Dues Transfer' GROUP BY 1)
      , j AS (SELECT coalesce(s.parent_id, a.parent_id) AS k, * FROM v_stored s FULL JOIN again a ON s.parent_id = a.parent_id)""",
))
def dq14_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, stored = tables(spark, sf_dir, "v_fact", "v_stored")
    return validators.split_rules(facts, F.col("counted"), model(spark, sf_dir, "committees"), stored, money.DUES_TYPE, RECEIPT)


@query("dq16_anchors", rules(
    rule("kind is known", "v_seat WHERE kind = 'other'", "seat"),
    rule("only a vacancy is blank", "v_seat WHERE kind = 'vacancy' AND name <> ''", "seat"),
    rule("no placeholder", "v_seat WHERE ref LIKE 'inc-%'", "seat"),
    rule("candidate resolves", "v_seat WHERE kind = 'candidate' AND ref NOT IN (SELECT candidate_id FROM v_stand)", "seat"),
    rule("person resolves", "v_seat WHERE kind = 'person' AND ref NOT IN (SELECT person_id FROM v_link)", "seat"),
    rule("person is preferred", "v_seat WHERE kind = 'candidate' AND ref IN (SELECT candidate_id FROM v_link)", "seat"),
))
def dq16_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validators.anchor_rules(*tables(spark, sf_dir, "v_seat", "v_stand", "v_link"))


@query("dq16_scope", rules(
    rule("other receipts are the recount", "said, again WHERE other_amount <> r_amount", "'page'"),
    rule("other receipts are counted", "said, again WHERE other_count <> r_count", "'page'"),
    rule("quarterly date is the latest", "said, again WHERE quarterly IS DISTINCT FROM r_quarterly", "'page'"),
    rule("large gift date is the latest", "said, again WHERE large_gift IS DISTINCT FROM r_large", "'page'"),
    rule("no date is after the build", "said WHERE quarterly > built OR large_gift > built", "'page'"),
    rule("self-funder is not listed", "selves s JOIN v_scope_list l ON s.seat = l.seat AND s.donor_id = l.donor_id", "s.seat || '/' || s.donor_id"),
    rule("self-funder is recorded", "selves s WHERE NOT EXISTS (SELECT 1 FROM v_scope_self r WHERE r.seat = s.seat AND r.donor_id = s.donor_id)", "s.seat || '/' || s.donor_id"),
    rule("recorded self-funder is one", "v_scope_self r WHERE NOT EXISTS (SELECT 1 FROM selves s WHERE r.seat = s.seat AND r.donor_id = s.donor_id)", "r.seat || '/' || r.donor_id"),
    heads=""", said AS (SELECT * FROM v_scope_said)
      , again AS (SELECT sum(amount) FILTER (other_receipt AND committee_id IN (SELECT committee_id FROM v_scope)) AS r_amount, count(*) FILTER (other_receipt AND committee_id IN (SELECT committee_id FROM v_scope)) AS r_count,
          max(date) FILTER (report = 'quarterly') AS r_quarterly, max(date) FILTER (report = 'large_gift') AS r_large FROM v_scope_fact)
      , selves AS (SELECT DISTINCT v.seat, f.donor_id FROM v_scope_fact f JOIN v_scope v ON f.committee_id = v.committee_id WHERE f.is_self)""",
))
def dq16_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["v_scope", "v_scope_fact", "v_scope_said", "v_scope_self", "v_scope_list"]
    made = stored(spark, sf_dir, names, ["v_scope_fact"])
    return validators.scope_rules(*[made[n] for n in names])


@query("dq16_donor_lists", rules(
    *[rule(f"{s} is its source", f"v_figure f JOIN v_source s ON f.seat = s.seat AND f.election = s.election WHERE f.{s} <> s.{s}", "f.seat || '/' || f.election") for s in ("direct", "self_funding", "ie_support", "ie_oppose")],
    rule("donors make direct", "f WHERE got <> direct", "k"),
    rule("donors leave out self-funding", "f WHERE self_funding > 0 AND got = direct + self_funding", "k"),
    rule("no self-funder among donors", "v_donor WHERE (seat, donor_id) IN (SELECT (seat, donor_id) FROM v_self)", "seat || '/' || election || '/' || donor_id"),
    rule("donor has items", "i WHERE item_count IS NULL", "k"),
    rule("items are dated", "i WHERE undated > 0", "k"),
    rule("items make the donor", "i WHERE item_sum <> amount", "k"),
    rule("item count is the donor's", "i WHERE item_count <> n", "k"),
    rule("coverage makes the total", "c WHERE dollars <> donor_total", "k"),
    rule("donors make the total", "c WHERE got <> donor_total", "k"),
    rule("donors are counted", "c WHERE listed <> donor_count", "k"),
    rule("shares make one", "c WHERE abs(share_sum - 1) >= 0.000001", "k"),
    rule("threshold agrees with its share", "c WHERE meets <> (substantive_share >= threshold)", "k"),
    heads=""", g AS (SELECT seat AS s, election AS e, sum(amount) AS got, count(*) AS listed FROM v_donor GROUP BY 1, 2)
      , f AS (SELECT *, seat || '/' || election AS k FROM v_figure JOIN g ON seat = s AND election = e)
      , c AS (SELECT *, seat || '/' || election AS k FROM v_cover JOIN g ON seat = s AND election = e)
      , per AS (SELECT seat, election, donor_id, sum(amount) AS item_sum, count(*) AS item_count, count(*) FILTER (date IS NULL) AS undated FROM v_item GROUP BY 1, 2, 3)
      , i AS (SELECT d.seat || '/' || d.election || '/' || d.donor_id AS k, d.amount, d.n, per.item_sum, per.item_count, per.undated
          FROM v_donor d LEFT JOIN per ON d.seat = per.seat AND d.election = per.election AND d.donor_id = per.donor_id)""",
))
def dq16_donors(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["v_figure", "v_source", "v_donor", "v_item", "v_cover", "v_self"]
    made = stored(spark, sf_dir, names, ["v_donor", "v_source"])
    return validators.donor_list_rules(*[made[n] for n in names])


@query("dq16_vocabulary", rules(
    lost("tag has an entry", "v_used", "tag", "v_vocabulary", "tag"),
    lost("entry is used", "v_vocabulary", "tag", "v_used", "tag"),
    rule("entry is complete", "v_vocabulary WHERE label = ''", "tag"),
    lost("cluster resolves", "v_clusters_used", "cluster_id", "v_clusters", "cluster_id"),
))
def dq16_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validators.vocabulary_rules(*tables(spark, sf_dir, "v_used", "v_vocabulary", "v_clusters_used", "v_clusters"))


@query("dq16_spending_slice", rules(
    rule("item is in its election", """(SELECT i.election || '/' || i.spender_id AS k, count(*) AS n FROM v_slice i JOIN v_window w ON i.election = w.election
        WHERE i.date < w.start_date OR i.date > w.end_date GROUP BY 1)""", "k", "n"),
    rule("items make the spender", """v_spender s JOIN (SELECT election, spender_id, sum(amount) AS again FROM v_slice GROUP BY 1, 2) a
        ON s.election = a.election AND s.spender_id = a.spender_id WHERE s.amount <> a.again""", "s.election || '/' || s.spender_id"),
))
def dq16_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validators.slice_rules(*tables(spark, sf_dir, "v_slice", "v_spender", "v_window"))


@query("dq17_report_family", rules(
    rule("input is unchanged", "j WHERE why IS NOT NULL AND pin IS NULL", "k", "why"),
    rule("known failure still fails", "j WHERE pin IS NOT NULL AND why IS NULL", "k"),
    rule("known failure has an owner", "v_known WHERE owner IS NULL", "report_id || '/' || name"),
    rule("known failures shrink", "(SELECT report_id FROM v_known GROUP BY report_id HAVING count(*) > max(most))", "report_id"),
    rule("path is relative", "v_string WHERE starts_with(value, '/') OR contains(value, '/home/')", "report_id || '/' || path"),
    rule("dates are there", "v_run WHERE data_through IS NULL OR data_through = 'soon'", "report_id"),
    rule("data end before the pull", "v_run WHERE data_through <> 'soon' AND data_through > pulled", "report_id"),
    rule("disclosed is the residual", "v_run r LEFT JOIN v_gap g ON r.report_id = g.report_id WHERE coalesce(g.amount, 0) <> r.residual", "r.report_id"),
    rule("no key is missing", "v_run WHERE report_id % 60 = 20", "report_id"),
    rule("no key is unexpected", "v_run WHERE report_id % 60 = 40", "report_id"),
    rule("report has strings", "v_run WHERE report_id NOT IN (SELECT report_id FROM v_string)", "report_id"),
    heads=""", j AS (SELECT i.report_id || '/' || i.name AS k, q.name AS pin, CASE WHEN path IS NULL OR sha = '' THEN 'malformed' WHEN now IS NULL THEN 'absent' WHEN now <> sha THEN 'moved' END AS why
        FROM v_input i LEFT JOIN v_current c ON i.name = c.name LEFT JOIN v_known q ON i.report_id = q.report_id AND i.name = q.name)""",
))
def dq17_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs, current, known, runs, strings, gaps = tables(spark, sf_dir, "v_input", "v_current", "v_known", "v_run", "v_string", "v_gap")
    words = lambda *names: F.array(*[F.lit(n) for n in names])
    k = F.col("report_id") % 60
    keys = F.when(k == 20, words("run")).when(k == 40, words("run", "headline", "draft")).otherwise(words("headline", "run"))
    return validators.report_rules(inputs, current, known, runs.withColumn("keys", keys).withColumn("expected", words("run", "headline")), strings, gaps)


@query("dq18_home_page", rules(
    rule("HP-1 input is unchanged", "v_home_input WHERE sha <> now", "name"),
    rule("HP-2 stream is the recount", "(SELECT 1) WHERE EXISTS (SELECT 1 FROM v_home_fact WHERE stream = 'mayor')", "'mayor'"),
    rule("HP-3 donor is the recount", "large t LEFT JOIN v_home_donor h ON t.donor_id = h.donor_id AND t.cycle = h.cycle WHERE coalesce(h.amount, 0) <> t.amount", "t.donor_id || '/' || t.cycle"),
    rule("HP-4 donors are ranked", "shown a JOIN shown b ON b.place = a.place + 1 WHERE b.total > a.total OR b.total = a.total AND b.donor_id < a.donor_id", "a.donor_id"),
    rule("HP-5 items make the donor", "(SELECT * FROM shown WHERE total >= 50000) s FULL JOIN listed i ON s.donor_id = i.donor_id WHERE coalesce(s.total, 0) <> coalesce(i.amount, 0)", "coalesce(s.donor_id, i.donor_id)"),
    lost("HP-6 recipient is there", "v_home_item", "committee_id", "v_home_recipient", "committee_id"),
    rule("HP-6 mayoral recipient has a candidacy", "seen WHERE office = 'mayor' AND coalesce(race, '') <> 'mayor'", "committee_id"),
    rule("HP-6 mayoral recipient names its candidacy", "seen WHERE office = 'mayor' AND race = 'mayor' AND person <> 'mayor-' || split_part(candidacy_id, '-', 2)", "committee_id"),
    rule("HP-6 recipient names its person", "seen WHERE office <> 'mayor' AND coalesce(race, '') <> 'mayor' AND linked IS NOT NULL AND person IS DISTINCT FROM linked", "committee_id"),
    rule("HP-8 link leads to the vote", "v_home_feed f WHERE f.body = 'school_board' AND f.link IS DISTINCT FROM '/votes?vote=' || f.vote_id", "f.vote_id"),
    rule("HP-7 group is the recount", "v_home_group g JOIN (SELECT group_id, sum(amount) AS again FROM v_home_spending GROUP BY 1) s ON g.group_id = s.group_id WHERE g.amount <> s.again", "g.group_id"),
    rule("HP-8 feed is the latest", "v_home_feed f WHERE f.vote_id = 'lost'", "f.vote_id", "'extra'"),
    rule("HP-8 feed is the latest", "latest l WHERE NOT EXISTS (SELECT 1 FROM v_home_feed f WHERE f.date = l.date AND f.vote_id = l.vote_id)", "l.vote_id", "'missing'"),
    heads=""", large AS (SELECT t.* FROM v_home_total t JOIN v_home_large l ON t.donor_id = l.donor_id)
      , shown AS (SELECT donor_id, min(place) AS place, sum(amount) AS total FROM v_home_donor GROUP BY 1)
      , listed AS (SELECT donor_id, sum(amount) AS amount FROM v_home_item GROUP BY 1)
      , seen AS (SELECT r.*, c.candidacy_id, c.race, c.person AS linked FROM v_home_recipient r LEFT JOIN v_home_cand c ON r.filing_id = c.filing_id)
      , latest AS (SELECT * FROM v_home_vote ORDER BY date DESC, body DESC, vote_id DESC LIMIT 10)""",
))
def dq18_home(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("donor", "fact", "item", "recipient", "stream", "group", "spending", "feed", "vote", "input", "cand")
    made = stored(spark, sf_dir, [f"v_home_{n}" for n in names], ["v_home_donor", "v_home_fact", "v_home_item", "v_home_spending", "v_home_vote"])
    return validators.home_rules(*[made[f"v_home_{n}"] for n in names], link="/votes?vote=")
