"""The money and vote tables of the model, derived from the given tables.

The statements keep to SQL that Spark and DuckDB both read, so a query and its oracle start from the
same rows; everything after that is written twice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RAW = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

SQL = {
    "cycles": """
        SELECT '1997' AS code, 'Cycle 1997' AS label, DATE '1995-06-01' AS start_date, DATE '1997-05-31' AS end_date, DATE '1997-04-06' AS election_date
        UNION ALL SELECT '1999', 'Cycle 1999', DATE '1997-06-01', DATE '1999-05-31', DATE '1999-04-04'
        UNION ALL SELECT '2001', 'Cycle 2001', DATE '1999-07-01', DATE '2001-05-31', DATE '2001-04-03'""",
    "windows": """
        SELECT 'school_board' AS office_type, 'sb-1998' AS window_id, CAST(NULL AS DATE) AS start_date, DATE '1998-12-31' AS end_date, 1 AS ord
        UNION ALL SELECT 'school_board', 'sb-2001', DATE '1999-01-01', CAST(NULL AS DATE), 2
        UNION ALL SELECT 'municipal', 'muni-1997', DATE '1995-03-01', DATE '1997-02-28', 1
        UNION ALL SELECT 'municipal', 'muni-1999', DATE '1997-03-01', DATE '1999-02-28', 2
        UNION ALL SELECT 'municipal', 'muni-2001', DATE '1999-02-01', DATE '2001-02-28', 3""",
    "contributions": """
        SELECT o_custkey AS donor_id, l_suppkey AS committee_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
          CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_shipdate AS DATE) END AS date,
          CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Individual Contribution' WHEN 'AO' THEN 'Transfer In' WHEN 'NF' THEN 'In-kind Contribution'
            WHEN 'NO' THEN 'Loan Received' WHEN 'RF' THEN 'Other Receipt' ELSE 'IE Committee Dues Transfer' END AS contribution_type,
          l_linenumber = 7 AND l_quantity >= 45 AS is_aggregate, o_custkey % 11 = l_suppkey % 11 AS is_own_committee,
          l_orderkey AS source_filing, l_linenumber AS line
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "donors": """
        SELECT c_custkey AS donor_id, c_name AS name, CASE WHEN c_custkey % 97 = 0 THEN 'Aggregate' WHEN c_custkey % 3 = 0 THEN 'Individual' ELSE 'PAC' END AS type,
          CASE WHEN c_custkey % 4 = 0 THEN min(CASE WHEN c_custkey % 4 = 0 THEN c_custkey END) OVER (PARTITION BY c_nationkey, c_mktsegment) ELSE c_custkey END AS parent_id,
          CASE WHEN c_custkey % 4 = 0 THEN n_name || '-' || c_mktsegment END AS cluster_id,
          CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 10 = 1 THEN 'unclassified' WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) || ',' || lower(r_name) ELSE lower(c_mktsegment) END AS tags,
          c_nationkey AS nation, c_mktsegment AS employer, CAST(c_acctbal AS DECIMAL(18,2)) AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "committees": """
        SELECT s_suppkey AS committee_id, s_name AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'independent_expenditure' ELSE 'candidate' END AS type,
          s_suppkey AS candidate_id, s_suppkey % 30 AS person_id, s_nationkey AS race_id,
          CASE s_suppkey % 4 WHEN 0 THEN 'mayor' WHEN 1 THEN 'alderperson' WHEN 2 THEN 'school_board_member' ELSE 'city_clerk' END AS office,
          CASE s_suppkey % 4 WHEN 2 THEN 'school_board' ELSE 'municipal' END AS office_type,
          CASE WHEN s_suppkey % 4 = 1 THEN s_nationkey + 1 END AS ward, CAST(s_acctbal AS DECIMAL(18,2)) AS balance,
          CASE WHEN s_suppkey % 3 = 0 THEN 'labor' ELSE 'civic' END AS tag
        FROM supplier""",
    "expenditures": """
        SELECT l_suppkey AS spender_id, l_partkey % 40 AS target_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_shipdate AS DATE) AS date,
          CASE l_linestatus WHEN 'F' THEN 'support' ELSE 'oppose' END AS stance, l_orderkey AS doc_id, l_partkey AS part_id, l_returnflag AS flag
        FROM lineitem WHERE l_suppkey % 5 = 0""",
    "filings": """
        SELECT o_orderkey AS doc_id, o_custkey AS committee_id, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS beg,
          CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) + INTERVAL '3' MONTH - INTERVAL '1' DAY AS DATE) AS fin, CAST(o_orderdate AS DATE) AS received,
          o_orderpriority AS kind
        FROM orders""",
    "sworn": """
        SELECT l_orderkey AS doc_id,
          CAST(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS individual,
          CAST(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS transfers,
          CAST(sum(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS loans,
          CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS other,
          CAST(sum(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS in_kind,
          CAST(sum(CASE WHEN l_linenumber = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS small_gifts,
          CAST(sum(CASE WHEN l_linenumber <= 2 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS cash
        FROM lineitem WHERE l_orderkey % 9 <> 0 GROUP BY l_orderkey""",
    "person_votes": """
        SELECT CAST(CAST(ts AS DATE) AS VARCHAR(10)) || '-' || lpad(CAST(extract(hour FROM ts) AS VARCHAR(2)), 2, '0') AS vote_id, CAST(ts AS DATE) AS date, user_id AS voter_id,
          CASE event_type WHEN 'view' THEN 'yes' WHEN 'click' THEN 'no' WHEN 'purchase' THEN 'abstain' WHEN 'signup' THEN 'not voting' ELSE 'absent' END AS option, event_id
        FROM events""",
}
SQL["memberships"] = """
        SELECT user_id AS person_id, (user_id * 7 + block) % 50 AS seat, min(d) AS start_date, CASE WHEN max(d) < DATE '2024-01-20' THEN max(d) END AS end_date
        FROM (SELECT user_id, CAST(ts AS DATE) AS d, CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN 0 WHEN ts < TIMESTAMP '2024-01-21 00:00:00' THEN 1 ELSE 2 END AS block FROM events) e
        WHERE user_id % 2 = 0 OR block = 0 GROUP BY user_id, block"""


def oracle(body: str) -> str:
    """A whole statement for DuckDB: the model tables that body names, then body, which is a SELECT or goes on with ", name AS (...)"."""
    used, todo = [], [n for n in SQL if re.search(rf"\b{n}\b", body)]
    for n in todo:
        used.append(f"{n} AS ({SQL[n]})")
    body = body.strip()
    if not used:
        return body if not body.startswith(",") else "WITH " + body[1:]
    return "WITH " + ",\n".join(used) + "\n" + body


def given(spark: SparkSession, sf_dir: str, body: str, more: dict[str, DataFrame] | None = None) -> DataFrame:
    """The same statement on Spark. Given tables, and frames in more, go in as frames, so no view of the caller is replaced."""
    statement, more = oracle(body).replace("{", "{{").replace("}", "}}"), more or {}
    used = [t for t in [*RAW, *more] if re.search(rf"\b(FROM|JOIN)\s+{t}\b", statement)]
    for t in used:
        statement = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", statement)
    return spark.sql(statement, **{t: more[t] if t in more else raw(spark, sf_dir, t) for t in used})


def model(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return given(spark, sf_dir, SQL[name])


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rules_sql(column: str, rules: list[tuple[str, str]], default: str) -> str:
    """A rule table as DuckDB's CASE."""
    cases = " ".join(f"WHEN regexp_matches(lower({column}), '{p}') THEN '{label}'" for p, label in rules)
    return f"CASE {cases} ELSE {default} END"


def values_sql(column: str, values: dict, default: str = "NULL") -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v!r}" if not isinstance(v, int) else f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {default} END"


def in_sql(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"
