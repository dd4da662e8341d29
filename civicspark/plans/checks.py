"""Queries of the data-quality rules (DQ-1 to DQ-26)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions import text
from civicspark.operators import quality, rollups

from .model import given, model, oracle, raw
from .money import COUNTED, CYCLED, M, counted, cycled, tag_list
from .registry import query

V = "'{}' AS rule, 'error' AS severity"


@query("dq1_families", oracle(", g AS (SELECT cluster_id, count(*) AS n, count(DISTINCT parent_id) AS p, count(*) FILTER (donor_id = parent_id) AS o FROM donors WHERE cluster_id IS NOT NULL AND donor_id % 8 <> 4 GROUP BY 1) " + " UNION ALL ".join(f"SELECT {V.format(r)}, cluster_id AS key, '' AS detail FROM g WHERE {w}" for r, w in (("family has two members", "n < 2"), ("family has one parent", "p <> 1"), ("parent is a member", "o <> 1")))))
def dq1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.family_rules(model(spark, sf_dir, "donors").filter("donor_id % 8 <> 4"))


@query("dq2_unclassified", oracle(f"SELECT {V.format('unclassified stands alone')}, CAST(donor_id AS VARCHAR) AS key, '' AS detail FROM donors WHERE tags = 'unclassified' AND donor_id % 3 = 0"))
def dq2(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").withColumn("tags", F.when(F.col("donor_id") % 3 == 0, F.concat(tag_list(), F.array(F.lit("x")))).otherwise(tag_list()))
    return quality.no_mixed_unclassified(d)


@query("dq3_votes", oracle(f"SELECT {V.format('vote id is unique')}, vote_id AS key, CAST(count(*) AS VARCHAR) AS detail FROM (SELECT DISTINCT vote_id, option FROM person_votes WHERE option IN ('yes', 'no')) GROUP BY vote_id HAVING count(*) > 1 UNION ALL SELECT {V.format('seat resolves')}, CAST(voter_id AS VARCHAR), '' FROM (SELECT DISTINCT voter_id FROM person_votes WHERE voter_id NOT IN (SELECT person_id FROM memberships WHERE seat < 30))"))
def dq3(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = model(spark, sf_dir, "person_votes")
    unique = quality.not_unique(v.filter(F.col("option").isin("yes", "no")).select("vote_id", "option").distinct(), "vote id is unique", ["vote_id"])
    return unique.unionByName(quality.unresolved(v, "voter_id", model(spark, sf_dir, "memberships").filter("seat < 30"), "person_id", "seat resolves"))


@query("dq4_members", oracle(" UNION ALL ".join(f"SELECT {V.format(r)}, CAST(person_id AS VARCHAR) AS key, '' AS detail FROM memberships WHERE {w}" for r, w in (("term starts", "start_date < DATE '2024-01-02'"), ("term ends after it starts", "end_date < start_date"), ("seat is known", "seat >= 45")))))
def dq4(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "memberships")
    return quality.row_rules(m, "person_id", {"term starts": F.col("start_date") < F.lit("2024-01-02").cast("date"), "term ends after it starts": F.col("end_date") < F.col("start_date"), "seat is known": F.col("seat") >= 45})


@query("dq5_shards", oracle("SELECT 'shards equal their source' AS rule, 'error' AS severity, CAST(donor_id AS VARCHAR) AS key, 'none vs ' || CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS VARCHAR) AS detail FROM contributions WHERE donor_id % 17 = 0 GROUP BY donor_id"))
def dq5(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "contributions")
    return quality.equal_sums(c.filter("donor_id % 17 <> 0"), c, ["donor_id"], "amount", "shards equal their source")


@query("dq6_unkeyed_money", oracle(" UNION ALL ".join(f"SELECT {V.format(r)}, CAST(source_filing AS VARCHAR) AS key, '' AS detail FROM contributions WHERE {w}" for r, w in (("dated", "date IS NULL"), ("not an aggregate", "is_aggregate"), ("positive", "amount <= 0"), ("typed", "contribution_type IS NULL")))))
def dq6(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "contributions")
    return quality.row_rules(c, "source_filing", {"dated": F.col("date").isNull(), "not an aggregate": F.col("is_aggregate"), "positive": F.col("amount") <= 0, "typed": F.col("contribution_type").isNull()})


@query("dq7_donors_resolve", oracle(f"SELECT {V.format('donor resolves')}, CAST(donor_id AS VARCHAR) AS key, '' AS detail FROM (SELECT DISTINCT donor_id FROM contributions WHERE donor_id IN (SELECT donor_id FROM donors WHERE donor_id % 19 = 0)) UNION ALL SELECT {V.format('donor has a parent')}, CAST(donor_id AS VARCHAR), '' FROM donors WHERE donor_id % 19 <> 0 AND donor_id % 23 = 0"))
def dq7(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").filter("donor_id % 19 <> 0").withColumn("parent_id", F.when(F.col("donor_id") % 23 != 0, F.col("parent_id")))
    return quality.unresolved(model(spark, sf_dir, "contributions"), "donor_id", d, "donor_id", "donor resolves").unionByName(quality.row_rules(d, "donor_id", {"donor has a parent": F.col("parent_id").isNull()}))


@query("dq8_person_totals", oracle(COUNTED + ", p AS (SELECT m.person_id, c.amount, c.committee_id FROM counted c JOIN committees m ON c.committee_id = m.committee_id WHERE m.type = 'candidate') SELECT 'person total is the sum of candidacies' AS rule, 'error' AS severity, CAST(person_id AS VARCHAR) AS key, CAST(CAST(sum(amount) FILTER (committee_id % 7 <> 1) AS DECIMAL(18,2)) AS VARCHAR) || ' vs ' || CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS VARCHAR) AS detail FROM p GROUP BY person_id HAVING count(*) FILTER (committee_id % 7 = 1) > 0 AND count(*) FILTER (committee_id % 7 <> 1) > 0 UNION ALL SELECT 'person total is the sum of candidacies', 'error', CAST(person_id AS VARCHAR), 'none vs ' || CAST(CAST(sum(amount) AS DECIMAL(18,2)) AS VARCHAR) FROM p GROUP BY person_id HAVING count(*) FILTER (committee_id % 7 <> 1) = 0"))
def dq8(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees").filter("type = 'candidate'").select("committee_id", "person_id")
    p = counted(spark, sf_dir).join(m, "committee_id").select("person_id", "committee_id", "amount")
    return quality.equal_sums(p.filter("committee_id % 7 <> 1"), p, ["person_id"], "amount", "person total is the sum of candidacies")


@query("dq9_election_identity", oracle(f"SELECT {V.format('conventions agree')}, CAST(committee_id AS VARCHAR) AS key, '' AS detail FROM committees WHERE committee_id % 3 <> 0 AND office = 'alderperson' UNION ALL SELECT {V.format('stamp equals race')}, CAST(committee_id AS VARCHAR), '' FROM committees WHERE office = 'alderperson' AND committee_id % 5 = 1"))
def dq9(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("race_id").cast("string")
    c = model(spark, sf_dir, "committees").filter("office = 'alderperson'").withColumn("race", F.concat(F.lit("ward-"), n)).withColumn("cand", F.when(F.col("committee_id") % 3 == 0, F.concat(F.lit("inc-ward-"), n)).otherwise(F.concat(F.lit("x-sb-d"), n))).withColumn("stamp", F.when(F.col("committee_id") % 5 == 1, "2026-school-board").otherwise("2027-municipal"))
    of_race = text.election_of_race(F.col("race"))
    return quality.row_rules(c, "committee_id", {"conventions agree": of_race != text.election_of_candidate(F.col("cand")), "stamp equals race": of_race != F.col("stamp")})


@query("dq10_12_linkage", oracle(f"SELECT {V.format('committee is used once')}, CAST(person_id AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) AS detail FROM committees GROUP BY person_id HAVING count(*) > 1 UNION ALL SELECT {V.format('money implies a claim')}, CAST(committee_id AS VARCHAR), '' FROM (SELECT DISTINCT committee_id FROM contributions WHERE committee_id % 6 = 0)"))
def dq10(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "committees")
    return quality.not_unique(c, "committee is used once", ["person_id"]).unionByName(quality.unresolved(model(spark, sf_dir, "contributions"), "committee_id", c.filter("committee_id % 6 <> 0"), "committee_id", "money implies a claim"))


@query("dq11_stream_fusion", oracle("SELECT 'streams are apart' AS rule, 'error' AS severity, CAST(committee_id AS VARCHAR) AS key, count(*) FILTER (donor_id % 2 = 0) || '/' || count(*) FILTER (donor_id % 2 = 1) AS detail FROM contributions WHERE committee_id % 4 = 0 GROUP BY committee_id HAVING count(*) FILTER (donor_id % 2 = 0) > 0 AND count(*) FILTER (donor_id % 2 = 1) > 0"))
def dq11(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.col("donor_id") % 2 == 1
    stream = F.when(odd & (F.col("committee_id") % 4 == 0), "funder").otherwise("direct")
    return quality.stream_fusion(model(spark, sf_dir, "contributions").withColumn("stream", stream))


@query("dq13_excluded_recount", oracle(CYCLED + f" SELECT contribution_type, count(*) AS n, {M.format('amount')} AS amount FROM cycled WHERE contribution_type IN ('IE Committee Dues Transfer', 'Other Receipt') AND NOT is_aggregate AND NOT (contribution_type = 'Other Receipt' AND is_own_committee) GROUP BY 1"))
def dq13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civicspark.functions import money

    c = cycled(spark, sf_dir).filter("NOT is_aggregate")
    return c.filter((F.col("contribution_type") == money.DUES_TYPE) | money.is_excluded_other(F.col("contribution_type"), F.col("is_own_committee"))).groupBy("contribution_type").agg(F.count(F.lit(1)).alias("n"), money.total(F.col("amount")).alias("amount"))


@query("dq14_split_recount", oracle(COUNTED + " SELECT DISTINCT 'parts make the total' AS rule, 'error' AS severity, CAST(parent_id AS VARCHAR) AS key, '' AS detail FROM counted WHERE parent_id % 9 = 4"))
def dq14(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = model(spark, sf_dir, "donors").groupBy("parent_id").agg(F.count(F.lit(1)).alias("members"))
    p = rollups.by_parent(counted(spark, sf_dir), members, F.col("committee_id") % 5 == 0)
    p = p.filter("cycle = 'all'").withColumn("total", F.col("total") + F.when(F.col("parent_id") % 9 == 4, 1).otherwise(0))
    return quality.row_rules(p, "parent_id", {"parts make the total": F.col("direct") + F.col("independent") != F.col("total")})


@query("dq15_own_committee", oracle(f"SELECT {V.format('own committee has one stamp')}, CAST(source_filing AS VARCHAR) AS key, '' AS detail FROM contributions WHERE is_own_committee AND donor_id % 100 = committee_id % 100"))
def dq15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_rules(model(spark, sf_dir, "contributions"), "source_filing", {"own committee has one stamp": F.col("is_own_committee") & (F.col("donor_id") % 100 == F.col("committee_id") % 100)})


@query("dq16_no_fused_total", "SELECT 'no fused total' AS rule, 'error' AS severity, CAST(o_orderkey AS VARCHAR) AS key, '' AS detail FROM orders WHERE o_orderkey % 4 = 0 AND o_custkey % 7 <> 0 AND o_orderkey <> 0")
def dq16(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = raw(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("a"), (F.col("o_custkey") % 7 * 1000000).alias("b"), F.lit(0).alias("c"), F.lit(0).alias("d"))
    o = o.withColumn("figure", F.when(F.col("a") % 4 == 0, F.col("a") + F.col("b")).otherwise(-1))
    return quality.fused_totals(o, "o_orderkey", ["a", "b", "c", "d"], ["figure"])


@query("dq17_report_rules", oracle("SELECT 'individual money above transfers' AS rule, 'error' AS severity, CAST(doc_id AS VARCHAR) AS key, '' AS detail FROM sworn WHERE individual > transfers AND transfers > 0"))
def dq17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_rules(model(spark, sf_dir, "sworn"), "doc_id", {"individual money above transfers": (F.col("individual") > F.col("transfers")) & (F.col("transfers") > 0)})


@query("dq18_recount", oracle(COUNTED + ", p AS (SELECT parent_id, sum(amount) FILTER (donor_id % 31 <> 5) AS a, sum(amount) AS b FROM counted GROUP BY 1) SELECT 'recount' AS rule, 'error' AS severity, CAST(parent_id AS VARCHAR) AS key, coalesce(CAST(CAST(a AS DECIMAL(18,2)) AS VARCHAR), 'none') || ' vs ' || CAST(CAST(b AS DECIMAL(18,2)) AS VARCHAR) AS detail FROM p WHERE coalesce(a, 0) <> b"))
def dq18(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Another path to the same money: all rows of known donors less what each rule takes away.
    from civicspark.functions import money

    c = cycled(spark, sf_dir)
    plain = model(spark, sf_dir, "donors").filter("type <> 'Aggregate'").select("donor_id", "parent_id")
    taken = c.filter(F.col("is_aggregate") | F.col("cycle").isin("pre-2011", "undated") | (F.col("contribution_type") == money.DUES_TYPE) | money.is_excluded_other(F.col("contribution_type"), F.col("is_own_committee")))
    net = c.select("donor_id", "amount").unionByName(taken.select("donor_id", (-F.col("amount")).alias("amount"))).join(plain, "donor_id")
    return quality.equal_sums(counted(spark, sf_dir).filter("donor_id % 31 <> 5"), net, ["parent_id"], "amount", "recount")


#: Texts with faults by rule: an edge space, a double space, a control character, a replacement mark.
FAULTY_TEXT = """SELECT doc_id, CASE doc_id % 50 WHEN 1 THEN ' ' || text WHEN 2 THEN text || '  x' WHEN 3 THEN text || chr(7) || 'x' WHEN 4 THEN text || '\ufffd' ELSE text END AS text FROM documents"""


@query("dq19_text", "WITH t AS (" + FAULTY_TEXT + """) SELECT rule, 'error' AS severity, CAST(doc_id AS VARCHAR) AS key, '' AS detail FROM (
  SELECT 'no double space' AS rule, doc_id FROM t WHERE contains(text, '  ') UNION ALL SELECT 'no edge space', doc_id FROM t WHERE text <> trim(text, ' ')
  UNION ALL SELECT 'no control characters', doc_id FROM t WHERE regexp_matches(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]|\\x{80}|[\\x{81}-\\x{9F}]') UNION ALL SELECT 'no replacement mark', doc_id FROM t WHERE contains(text, chr(65533)))""")
def dq19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.text_rules(given(spark, sf_dir, FAULTY_TEXT), "doc_id", "text", owned=True)


@query("ar7_banned_keys", """SELECT k AS c_custkey, "column", found, n FROM (
  SELECT c_custkey AS k, 'meta' AS "column", 'ssn' AS found, 1 AS n FROM customer WHERE c_custkey % 11 = 2 UNION ALL SELECT c_custkey, 'meta', 'email', 1 FROM customer WHERE c_custkey % 13 = 3
  UNION ALL SELECT c_custkey, 'doc', 'phone', 2 FROM customer WHERE c_custkey % 7 = 1 UNION ALL SELECT c_custkey, 'doc', 'ssn', 1 FROM customer WHERE c_custkey % 17 = 4
  UNION ALL SELECT c_custkey, 'tree', 'email', 1 FROM customer WHERE c_custkey % 5 = 2)""")
def ar7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys planted at three depths: of a map's value, of an object in a list in an object of JSON, of a map in a list in a struct."""
    k = F.col("c_custkey")
    pick = lambda n, r, a, b: F.when(k % n == r, a).otherwise(b)
    meta = F.create_map(F.lit("name"), F.create_map(pick(11, 2, "ssn", "first"), "c_name"), pick(13, 3, "email", "note"), F.create_map(F.lit("x"), F.lit("phone")))
    each = F.concat(F.lit('{"'), pick(7, 1, "phone", "c"), F.lit('": "ssn: \\"ssn\\": y"}'))
    doc = F.concat(F.lit('{"a": {"b": ['), each, F.lit(", "), each, F.lit(']}, "'), pick(17, 4, "s\\u0073n", "d"), F.lit('" : 1}'))
    tree = F.struct(F.array(F.create_map(pick(5, 2, "email", "web"), F.lit(1))).alias("links"))
    rows = raw(spark, sf_dir, "customer").select("c_custkey", meta.alias("meta"), doc.alias("doc"), tree.alias("tree"))
    return quality.banned_within(rows, "c_custkey", ["ssn", "email", "phone"], ["doc"])


@query("dq20_tag_continuity", oracle(f"SELECT {V.format('editorial id resolves')}, CAST(id AS VARCHAR) AS key, '' AS detail FROM (SELECT DISTINCT o_custkey + 20 AS id FROM orders) WHERE id NOT IN (SELECT donor_id FROM donors UNION SELECT committee_id FROM committees)"))
def dq20(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = model(spark, sf_dir, "donors").select(F.col("donor_id").alias("id")).unionByName(model(spark, sf_dir, "committees").select(F.col("committee_id").alias("id")))
    return quality.unresolved(raw(spark, sf_dir, "orders").select((F.col("o_custkey") + 20).alias("id")), "id", known, "id", "editorial id resolves")


@query("dq21_edits_applied", oracle("SELECT 'edit is applied' AS rule, 'error' AS severity, CAST(donor_id AS VARCHAR) AS key, 'want vs ' || type AS detail FROM donors WHERE donor_id % 12 = 0 AND type <> 'want'"))
def dq21(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").select("donor_id", "type")
    return quality.applied_values(d.filter("donor_id % 12 = 0").withColumn("type", F.lit("want")), d, "donor_id", "type")


@query("dq22_person_links", oracle(" UNION ALL ".join(f"SELECT {V.format(r)}, CAST(candidate_id AS VARCHAR) AS key, '' AS detail FROM committees WHERE {w}" for r, w in (("candidacy exists", "candidate_id % 8 = 0"), ("role is the election", "candidate_id % 8 <> 0 AND candidate_id % 3 = 0"), ("evidence is known", "candidate_id % 5 = 2")))))
def dq22(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "committees").select("person_id", F.col("candidate_id").alias("candidacy_id"))
    known = c.filter("candidacy_id % 8 <> 0").select("candidacy_id", F.lit("e1").alias("election_id"))
    k = F.col("candidacy_id")
    links = c.withColumn("role", F.when(k % 3 == 0, "e2").otherwise("e1")).withColumn("evidence", F.when(k % 5 == 2, "rumour").otherwise("filing"))
    return quality.person_links(links, known, ["filing", "statement"])


@query("dq23_retired_empty", oracle("SELECT 'retired table is empty' AS rule, 'error' AS severity, CAST(committee_id AS VARCHAR) AS key, '' AS detail FROM committees WHERE race_id = 3"))
def dq23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(model(spark, sf_dir, "committees").filter("race_id = 3"), "retired table is empty", F.col("committee_id"))


@query("dq24_bridge", oracle("SELECT 'bridge is known on both sides' AS rule, 'error' AS severity, CAST(donor_id AS VARCHAR) AS key, CASE WHEN donor_id % 6 = 0 THEN 'donor only' ELSE 'committee only' END AS detail FROM donors WHERE donor_id % 6 = 0 AND donor_id % 4 <> 0 OR donor_id % 4 = 0 AND donor_id % 6 <> 0"))
def dq24(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").select("donor_id", F.col("donor_id").alias("committee_id"))
    return quality.symmetric_bridge(d.filter("donor_id % 6 = 0"), d.filter("donor_id % 4 = 0"))


@query("dq25_cycle_agrees", oracle(CYCLED + f" SELECT 'stored cycle agrees' AS rule, 'error' AS severity, CAST(source_filing AS VARCHAR) AS key, '' AS detail FROM cycled WHERE cycle = '1997' AND donor_id % 13 = 0"))
def dq25(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cycled(spark, sf_dir).withColumn("stored", F.when((F.col("cycle") == "1997") & (F.col("donor_id") % 13 == 0), "1999").otherwise(F.col("cycle")))
    return quality.row_rules(c, "source_filing", {"stored cycle agrees": F.col("stored") != F.col("cycle")})
