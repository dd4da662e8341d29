"""Queries of entity resolution (JN-13 to JN-32, JN-45 to JN-50, AG-16, AG-17, AG-62, SNK-3, SNK-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions import text
from civicspark.functions.money import total
from civicspark.operators import entities

from .model import given, model, oracle, raw
from .money import COUNTED, M, counted
from .registry import query
from .scalars import named, names


@query("jn13_family_parent", oracle(", canon AS (SELECT cluster_id, min(donor_id) AS canonical_id FROM donors WHERE cluster_id IS NOT NULL GROUP BY 1) SELECT d.donor_id, d.cluster_id, coalesce(c.canonical_id, d.donor_id) AS parent_id FROM donors d LEFT JOIN canon c ON d.cluster_id = c.cluster_id"))
def jn13(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").select("donor_id", "cluster_id")
    return entities.family_parent(d, d.filter("cluster_id IS NOT NULL").groupBy("cluster_id").agg(F.min("donor_id").alias("canonical_id")))


_KEY = "trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


@query("jn14_bridge", f"""WITH d AS (SELECT p_partkey AS donor_id, p_name || '  ' || p_type AS name, CASE WHEN p_partkey % 7 = 0 THEN p_partkey + 1 END AS filing_id FROM part), c AS (SELECT p_partkey AS committee_id, upper(p_name) || '-' || p_type AS name FROM part),
  n AS (SELECT {_KEY.format('name')} AS k, max(committee_id) AS named, count(*) > 1 AS many FROM c GROUP BY 1)
  SELECT d.donor_id, coalesce(f.committee_id, n.named) AS committee_id, CASE WHEN f.committee_id IS NOT NULL THEN 'filing id' ELSE 'name' END AS via, coalesce(f.committee_id IS NULL AND n.many, false) AS collision FROM d LEFT JOIN c f ON f.committee_id = d.filing_id LEFT JOIN n ON n.k = {_KEY.format('d.name')} WHERE coalesce(f.committee_id, n.named) IS NOT NULL""")
def jn14(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = raw(spark, sf_dir, "part")
    d = p.select(F.col("p_partkey").alias("donor_id"), F.concat("p_name", F.lit("  "), "p_type").alias("name"), F.when(F.col("p_partkey") % 7 == 0, F.col("p_partkey") + 1).alias("filing_id"))
    c = p.select(F.col("p_partkey").alias("committee_id"), F.concat(F.upper("p_name"), F.lit("-"), "p_type").alias("name"))
    return entities.bridge_committees(d, c, text.norm(F.col("name")))


CAND = "SELECT c_custkey % 50 AS committee_id, c_custkey AS candidate_id, c_nationkey AS race_id, CASE WHEN c_custkey % 4 = 0 THEN DATE '1999-04-04' WHEN c_custkey % 4 = 1 THEN DATE '2001-04-03' END AS election_date, 1000000 - c_custkey AS ord FROM customer"


def candidacies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, CAND)


@query("jn15_owning_candidacy", f"SELECT committee_id, candidate_id, race_id FROM (SELECT *, row_number() OVER (PARTITION BY committee_id ORDER BY election_date DESC NULLS LAST, ord) AS n FROM ({CAND})) WHERE n = 1")
def jn15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.owning_candidacy(candidacies(spark, sf_dir))


@query("jn16_link_committees", oracle(f", o AS (SELECT committee_id, candidate_id, race_id FROM (SELECT *, row_number() OVER (PARTITION BY committee_id ORDER BY election_date DESC NULLS LAST, ord) AS n FROM ({CAND})) WHERE n = 1) SELECT c.committee_id, c.type, CASE WHEN c.type = 'candidate' THEN o.candidate_id END AS candidate_id, CASE WHEN c.type = 'candidate' THEN o.race_id END AS race_id FROM committees c LEFT JOIN o ON c.committee_id = o.committee_id"))
def jn16(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "committees").select("committee_id", "type")
    return entities.link_committees(c, entities.owning_candidacy(candidacies(spark, sf_dir)))


@query("jn17_own_committee", oracle(f"SELECT committee_id, (donor_id + committee_id) % 5 = 0 AS stamped, count(*) AS n, {M.format('amount')} AS amount FROM contributions GROUP BY 1, 2"))
def jn17(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "contributions")
    pairs = c.filter("(donor_id + committee_id) % 5 = 0").select("committee_id", "donor_id").distinct()
    stamped = entities.stamp_pairs(c, pairs, ["committee_id", "donor_id"], "stamped")
    return stamped.groupBy("committee_id", "stamped").agg(F.count(F.lit(1)).alias("n"), total(F.col("amount")).alias("amount"))


_LET = "list_filter(string_split(regexp_replace(lower({c}), '[^a-z]+', ' ', 'g'), ' '), lambda t: length(t) > 1 AND t NOT IN ('jr', 'sr', 'ii', 'iii', 'iv', 'mr', 'mrs', 'ms', 'dr'))"
_FAM = "list_distinct(CASE WHEN {c} LIKE '%,%' THEN " + _LET.format(c="split_part({c}, ',', 1)") + " ELSE list_slice(" + _LET.format(c="{c}") + ", -1, -1) END)"
_GIV = "list_distinct(list_transform(CASE WHEN {c} LIKE '%,%' THEN " + _LET.format(c="regexp_replace({c}, '^[^,]*,', '')") + " ELSE list_slice(" + _LET.format(c="{c}") + ", 1, -2) END, lambda t: CASE t WHEN 'bob' THEN 'robert' ELSE t END))"


@query("jn18_self_funding", named(f"""SELECT id, other, len(list_intersect(df, cf)) > 0 AND len(list_intersect(dg, cg)) > 0 OR len(da) >= 2 AND (len(list_filter(da, lambda x: NOT list_contains(ca, x))) = 0 OR len(list_filter(ca, lambda x: NOT list_contains(da, x))) = 0) AS self
  FROM (SELECT *, list_distinct(list_concat(df, dg)) AS da, list_distinct(list_concat(cf, cg)) AS ca FROM (SELECT a.id, b.id AS other, {_FAM.replace('{c}', 'a.name')} AS df, {_GIV.replace('{c}', 'a.name')} AS dg, {_FAM.replace('{c}', 'b.name')} AS cf, {_GIV.replace('{c}', 'b.name')} AS cg FROM names a JOIN names b ON b.id = a.id + 21))"""))
def jn18(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = names(spark, sf_dir).withColumn("s", text.split_name(F.col("name"))).select("id", F.struct(F.col("s.family").alias("family"), text.canonical_given(F.col("s.given")).alias("given")).alias("s"))
    pairs = s.select("id", F.col("s").alias("d")).join(s.select(F.col("id").alias("other"), F.col("s").alias("c")), F.col("other") == F.col("id") + 21)
    return pairs.select("id", "other", entities.self_funding(pairs, "d", "c").alias("self"))


@query("jn19_merge_parents", oracle("""SELECT donor_id, CASE WHEN pa <> donor_id THEN pa WHEN pb <> donor_id THEN pb ELSE coalesce(pa, pb) END AS parent_id, coalesce(pa <> donor_id AND pb <> donor_id AND pa <> pb, false) AS conflict
  FROM (SELECT coalesce(a.donor_id, b.donor_id) AS donor_id, a.parent_id AS pa, b.pb FROM (SELECT donor_id, parent_id FROM donors WHERE donor_id % 9 <> 0) a FULL JOIN (SELECT c_custkey AS donor_id, CASE WHEN c_custkey % 8 = 0 THEN c_custkey - c_custkey % 40 ELSE c_custkey END AS pb FROM customer WHERE c_custkey % 7 <> 0) b ON a.donor_id = b.donor_id)"""))
def jn19(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = model(spark, sf_dir, "donors").filter("donor_id % 9 <> 0")
    k = F.col("c_custkey")
    b = raw(spark, sf_dir, "customer").filter("c_custkey % 7 <> 0").select(k.alias("donor_id"), F.when(k % 8 == 0, k - k % 40).otherwise(k).alias("parent_id"))
    return entities.merge_parents(a, b)


@query("jn20_row_parity", "SELECT a.l_orderkey, a.l_linenumber, a.q <> b.q AS quantity, a.p IS DISTINCT FROM b.p AS part FROM (SELECT l_orderkey, l_linenumber, min(l_quantity) AS q, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2) a JOIN (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE min(l_partkey) END AS p FROM lineitem GROUP BY 1, 2) b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber WHERE a.q <> b.q OR a.p IS DISTINCT FROM b.p")
def jn20(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civicspark.operators import setops

    g = raw(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    a = g.agg(F.min("l_quantity").alias("quantity"), F.min("l_partkey").alias("part"))
    b = g.agg(F.max("l_quantity").alias("quantity"), F.min("l_partkey").alias("part")).withColumn("part", F.when(F.col("l_orderkey") % 5 != 0, F.col("part")))
    return setops.row_parity(a, b, ["l_orderkey", "l_linenumber"], ["quantity", "part"])


@query("jn21_22_group_families", oracle(f""", links AS (SELECT spender_id, min(CASE WHEN spender_id % 20 = 0 THEN 0 ELSE spender_id END) AS parent_id FROM expenditures GROUP BY 1) SELECT c.committee_id, l.parent_id, count(*) AS n, {M.format('CASE WHEN c.donor_id = l.parent_id THEN amount END')} AS left_out, {M.format('CASE WHEN c.donor_id <> l.parent_id THEN amount END')} AS kept FROM contributions c JOIN links l ON c.committee_id = l.spender_id GROUP BY 1, 2"""))
def jn21(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = model(spark, sf_dir, "expenditures").select("spender_id", F.when(F.col("spender_id") % 20 == 0, 0).otherwise(F.col("spender_id")).alias("parent_id")).distinct()
    own = entities.unique_only(links, ["spender_id"]).withColumnRenamed("spender_id", "committee_id")
    j = model(spark, sf_dir, "contributions").join(own, "committee_id")
    same = F.col("donor_id") == F.col("parent_id")
    return j.groupBy("committee_id", "parent_id").agg(F.count(F.lit(1)).alias("n"), total(F.when(same, F.col("amount"))).alias("left_out"), total(F.when(~same, F.col("amount"))).alias("kept"))


@query("jn24_worklist_minus", oracle("SELECT donor_id, name FROM donors WHERE tags IN ('', 'unclassified') AND donor_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"))
def jn24(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = raw(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("donor_id"))
    return model(spark, sf_dir, "donors").filter(F.col("tags").isin("", "unclassified")).select("donor_id", "name").join(done, "donor_id", "left_anti")


@query("jn25_overrides", oracle("""SELECT d.donor_id, array_to_string(list_concat(CASE WHEN o.p IS NOT NULL THEN [o.p] ELSE b END, list_filter(coalesce(o.a, []), lambda t: NOT list_contains(CASE WHEN o.p IS NOT NULL THEN [o.p] ELSE b END, t))), ',') AS industries, coalesce(o.notes, d.employer) AS notes
  FROM (SELECT *, list_filter(string_split(tags, ','), lambda t: t <> '') AS b FROM donors) d LEFT JOIN (SELECT donor_id, CASE WHEN donor_id % 2 = 0 THEN 'labor' END AS p, CASE WHEN donor_id % 3 = 0 THEN ['civic', 'machinery'] END AS a, CASE WHEN donor_id % 5 = 0 THEN 'seen' END AS notes FROM donors WHERE donor_id % 4 = 1 OR donor_id % 6 = 0) o ON d.donor_id = o.donor_id"""))
def jn25(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors")
    k = F.col("donor_id")
    o = d.filter("donor_id % 4 = 1 OR donor_id % 6 = 0").select("donor_id", F.when(k % 2 == 0, "labor").alias("primary_industry"), F.when(k % 3 == 0, F.array(F.lit("civic"), F.lit("machinery"))).alias("additional"), F.when(k % 5 == 0, "seen").alias("notes"))
    base = d.select("donor_id", F.filter(F.split("tags", ","), lambda t: t != "").alias("industries"), F.col("employer").alias("notes"))
    return entities.apply_overrides(base, o).withColumn("industries", F.array_join("industries", ","))


@query("jn25_unknown_overrides", oracle("SELECT o_custkey + 5 AS donor_id FROM orders WHERE o_custkey + 5 NOT IN (SELECT donor_id FROM donors)"))
def jn25b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.unknown_ids(raw(spark, sf_dir, "orders").select((F.col("o_custkey") + 5).alias("donor_id")), model(spark, sf_dir, "donors"), "donor_id")


@query("jn26_reingest", oracle("""SELECT coalesce(n.donor_id, o.donor_id) AS donor_id, coalesce(n.name, o.name) AS name, CASE WHEN o.tags IS NULL OR o.tags = 'unclassified' THEN coalesce(n.tag, o.tags) ELSE o.tags END AS industries, o.employer AS notes, CASE WHEN o.donor_id IS NULL THEN 'new' WHEN n.donor_id IS NULL THEN 'kept' ELSE 'updated' END AS state
  FROM (SELECT * FROM donors WHERE donor_id % 3 <> 0 AND tags NOT LIKE '%,%' AND tags <> '') o FULL JOIN (SELECT c_custkey AS donor_id, upper(c_name) AS name, 'fresh' AS tag FROM customer WHERE c_custkey % 4 <> 0) n ON o.donor_id = n.donor_id"""))
def jn26(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = model(spark, sf_dir, "donors").filter("donor_id % 3 <> 0 AND tags NOT LIKE '%,%' AND tags <> ''").select("donor_id", "name", F.split("tags", ",").alias("industries"), F.col("employer").alias("notes"))
    new = raw(spark, sf_dir, "customer").filter("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("donor_id"), F.upper("c_name").alias("name"), F.array(F.lit("fresh")).alias("industries"))
    return entities.reingest(old, new).withColumn("industries", F.array_join("industries", ","))


@query("jn27_prune", oracle("SELECT donor_id, name FROM donors WHERE donor_id IN (SELECT donor_id FROM contributions WHERE line = 6 AND amount > 90000)"))
def jn27(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.prune_unused(model(spark, sf_dir, "donors").select("donor_id", "name"), model(spark, sf_dir, "contributions").filter("line = 6 AND amount > 90000"), "donor_id")


#: Ids in one order of words, and those known, in another and some in two.
ASKED = "SELECT DISTINCT replace(p_name, ' ', '-') || '-' || lower(p_brand) AS id FROM part"
KEPT = "SELECT DISTINCT lower(p_brand) || '-' || CASE WHEN p_size < 2 THEN replace(p_name, ' ', '-') ELSE split_part(p_name, ' ', 2) || '-' || split_part(p_name, ' ', 1) END AS id FROM part"


@query("jn28_sorted_tokens", f"""WITH a AS ({ASKED}), k AS ({KEPT}) SELECT a.id, count(*) AS hits, CASE WHEN count(*) = 1 THEN min(k.id) END AS alias FROM a JOIN k ON list_sort(string_split(a.id, '-')) = list_sort(string_split(k.id, '-')) WHERE a.id NOT IN (SELECT id FROM k) GROUP BY 1""")
def jn28(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = raw(spark, sf_dir, "part")
    return entities.sorted_token_alias(*(spark.sql(q.replace("FROM part", "FROM {part}"), part=part) for q in (ASKED, KEPT)))


@query("jn29_committee_tags", oracle("SELECT committee_id, string_agg(tag, ',' ORDER BY tag) FILTER (tag IN ('labor', 'machinery')) AS tags, count(*) FILTER (tag NOT IN ('labor', 'machinery')) AS unknown FROM (SELECT committee_id, tag FROM committees UNION ALL SELECT committee_id, CASE committee_id % 4 WHEN 0 THEN 'machinery' ELSE 'mystery' END FROM committees) GROUP BY 1"))
def jn29(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "committees").select("committee_id", F.explode(F.array("tag", F.when(F.col("committee_id") % 4 == 0, "machinery").otherwise("mystery"))).alias("tag"))
    vocabulary = spark.createDataFrame([("labor",), ("machinery",)], "tag string").withColumn("known", F.lit(True))
    j = c.join(vocabulary, "tag", "left")
    return j.groupBy("committee_id").agg(F.nullif(F.array_join(F.array_sort(F.collect_list(F.when(F.col("known"), F.col("tag")))), ","), F.lit("")).alias("tags"), F.count_if(F.col("known").isNull()).alias("unknown"))


@query("jn30_committee_names", oracle("SELECT c.committee_id, coalesce(CASE WHEN c.committee_id % 3 = 0 THEN 'Curated ' || c.committee_id END, CASE WHEN c.committee_id % 2 = 0 THEN c.name END) AS name, CASE WHEN c.committee_id % 3 = 0 THEN 'curated' WHEN c.committee_id % 2 = 0 THEN 'export' END AS name_source FROM committees c"))
def jn30(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "committees").select("committee_id", F.col("name").alias("filed"))
    curated = c.filter("committee_id % 3 = 0").select("committee_id", F.concat(F.lit("Curated "), F.col("committee_id").cast("string")).alias("n"))
    export = c.filter("committee_id % 2 = 0").select("committee_id", F.col("filed").alias("n"))
    return entities.resolve(c.select("committee_id"), "committee_id", [("curated", curated), ("export", export)], "n", "name")


@query("jn31_map_violations", oracle("SELECT 'committee_id' AS side, CAST(committee_id AS VARCHAR) AS key, count(*) AS n FROM (SELECT committee_id, race_id FROM committees) GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'race_id', CAST(race_id AS VARCHAR), count(*) FROM committees GROUP BY 2 HAVING count(*) > 1"))
def jn31(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.inverted(model(spark, sf_dir, "committees").select("committee_id", "race_id"), "committee_id", "race_id")[1]


@query("jn32_registry", oracle("""SELECT candidate_id, race_id, source, committee_id FROM (SELECT c_custkey AS candidate_id, c_nationkey AS race_id, 'stub' AS source, CAST(NULL AS BIGINT) AS committee_id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey NOT IN (SELECT race_id FROM committees WHERE office = 'alderperson')
  UNION ALL SELECT candidate_id + 1000000, race_id, 'incumbent', coalesce(CASE WHEN committee_id % 2 = 0 THEN committee_id END, ward) FROM committees WHERE office = 'alderperson')"""))
def jn32(spark: SparkSession, sf_dir: str) -> DataFrame:
    seats = model(spark, sf_dir, "committees").filter("office = 'alderperson'")
    stubs = raw(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("candidate_id"), F.col("c_nationkey").alias("race_id"), F.lit("stub").alias("source"), F.lit(None).cast("bigint").alias("committee_id"))
    kept = stubs.join(seats.select("race_id"), "race_id", "left_anti").select(stubs.columns)
    holders = seats.select((F.col("candidate_id") + 1000000).alias("candidate_id"), "race_id", F.lit("incumbent").alias("source"), F.coalesce(F.when(F.col("committee_id") % 2 == 0, F.col("committee_id")), F.col("ward").cast("bigint")).alias("committee_id"))
    return kept.unionByName(holders)


@query("jn37_ag42_second_hop", oracle(f""", spent AS (SELECT target_id AS candidate_id, spender_id, {M.format('amount')} AS spent FROM expenditures GROUP BY 1, 2), given AS (SELECT committee_id AS spender_id, donor_id, {M.format('amount')} AS given FROM contributions GROUP BY 1, 2), top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY spender_id ORDER BY given DESC, donor_id) AS rank FROM given) WHERE rank <= 3)
  SELECT s.candidate_id, s.spender_id, s.spent, t.donor_id, t.given, t.rank FROM spent s LEFT JOIN top t ON s.spender_id = t.spender_id"""))
def jn37(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = model(spark, sf_dir, "expenditures").select(F.col("target_id").alias("candidate_id"), "spender_id", "amount")
    return entities.second_hop(e, model(spark, sf_dir, "contributions").select(F.col("committee_id").alias("spender_id"), "donor_id", "amount")).withColumn("rank", F.col("rank").cast("long"))


@query("jn42_44_person_funding", oracle("SELECT p.person_id, coalesce(o.committee_id, l.committee_id) AS committee_id, CASE WHEN o.committee_id IS NOT NULL THEN 'own' WHEN l.committee_id IS NOT NULL THEN 'linked' END AS committee_id_source FROM (SELECT DISTINCT person_id FROM committees) p LEFT JOIN (SELECT person_id, min(committee_id) AS committee_id FROM committees WHERE office = 'mayor' GROUP BY 1) o ON p.person_id = o.person_id LEFT JOIN (SELECT person_id, max(committee_id) AS committee_id FROM committees WHERE office = 'alderperson' GROUP BY 1) l ON p.person_id = l.person_id"))
def jn42(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "committees")
    own = c.filter("office = 'mayor'").groupBy("person_id").agg(F.min("committee_id").alias("c"))
    linked = c.filter("office = 'alderperson'").groupBy("person_id").agg(F.max("committee_id").alias("c"))
    return entities.resolve(c.select("person_id").distinct(), "person_id", [("own", own), ("linked", linked)], "c", "committee_id")


@query("jn45_get_or_create", """WITH n AS (SELECT DISTINCT p_name || CASE WHEN p_size % 2 = 0 THEN '!' ELSE '' END AS name FROM part), k AS (SELECT p_name AS name, min(replace(p_name, ' ', '-')) AS key FROM part WHERE p_size < 5 GROUP BY 1),
  f AS (SELECT n.name, k.key FROM n LEFT JOIN k ON n.name = k.name), s AS (SELECT name, regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM f WHERE key IS NULL), i AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY name) + CASE WHEN slug IN (SELECT key FROM k) THEN 1 ELSE 0 END AS i FROM s)
  SELECT name, key, false AS is_new FROM f WHERE key IS NOT NULL UNION ALL SELECT name, CASE WHEN i = 1 THEN slug ELSE slug || '-' || i END, true FROM i""")
def jn45(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = raw(spark, sf_dir, "part")
    wanted = p.select(F.concat("p_name", F.when(F.col("p_size") % 2 == 0, "!").otherwise("")).alias("name")).distinct()
    known = p.filter("p_size < 5").select(F.col("p_name").alias("name"), F.replace("p_name", F.lit(" "), F.lit("-")).alias("key")).distinct()
    return entities.get_or_create(wanted, known, "name")


@query("jn46_funders_rows", oracle(f"SELECT committee_id, CASE WHEN donor_id % 9 = 0 THEN 'dues' ELSE 'IE Committee Receipt' END AS kind, count(*) AS n, {M.format('amount')} AS amount FROM contributions WHERE committee_id IN (SELECT spender_id FROM expenditures) AND source_filing % 10 <> 0 GROUP BY 1, 2"))
def jn46(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civicspark.functions.money import is_dues

    spenders = model(spark, sf_dir, "expenditures").select(F.col("spender_id").alias("committee_id")).distinct()
    c = model(spark, sf_dir, "contributions").filter("source_filing % 10 <> 0").join(spenders, "committee_id", "left_semi")
    payer = F.when(F.col("donor_id") % 9 == 0, "Local Dues").otherwise("Someone")
    return c.groupBy("committee_id", F.when(is_dues(payer), "dues").otherwise("IE Committee Receipt").alias("kind")).agg(F.count(F.lit(1)).alias("n"), total(F.col("amount")).alias("amount"))


@query("jn48_family_names", oracle("SELECT d.donor_id, coalesce(CASE WHEN d.nation % 2 = 0 THEN d.cluster_id END, CASE WHEN d.nation % 3 = 0 THEN lower(d.cluster_id) END, d.name) AS shown FROM donors d"))
def jn48(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").select("donor_id", "name", "cluster_id", "nation")
    second = d.filter("nation % 2 = 0 AND cluster_id IS NOT NULL").select("cluster_id", F.col("cluster_id").alias("n")).distinct()
    first = d.filter("nation % 3 = 0 AND cluster_id IS NOT NULL").select("cluster_id", F.lower("cluster_id").alias("n")).distinct()
    r = entities.resolve(d, "cluster_id", [("second", second), ("first", first)], "n", "shown")
    return r.select("donor_id", F.coalesce("shown", "name").alias("shown"))


@query("jn47_50_directory", oracle(COUNTED + f" SELECT m.committee_id, m.person_id, 'Person ' || m.person_id AS person, m.office, count(*) AS n, {M.format('c.amount')} AS amount FROM counted c JOIN committees m ON c.committee_id = m.committee_id WHERE m.type = 'candidate' GROUP BY 1, 2, 3, 4"))
def jn47(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees").filter("type = 'candidate'").select("committee_id", F.concat(F.lit("p-"), F.col("person_id").cast("string"), F.lit("-x")).alias("key"), "office")
    m = m.withColumn("person_id", F.regexp_extract("key", "^p-([0-9]+)-", 1).cast("bigint")).withColumn("person", F.concat(F.lit("Person "), F.col("person_id").cast("string")))
    return counted(spark, sf_dir).join(m, "committee_id").groupBy("committee_id", "person_id", "person", "office").agg(F.count(F.lit(1)).alias("n"), total(F.col("amount")).alias("amount"))


FAMILIES = ", sums AS (SELECT donor_id, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM contributions WHERE donor_id % 5 <> 0 GROUP BY 1), mem AS (SELECT cluster_id, donor_id, 5000 - donor_id AS ord, min(donor_id) OVER (PARTITION BY cluster_id) AS canonical_id FROM donors WHERE cluster_id IS NOT NULL)"


def families(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from pyspark.sql.window import Window

    mem = model(spark, sf_dir, "donors").filter("cluster_id IS NOT NULL").select("cluster_id", "donor_id", (5000 - F.col("donor_id")).alias("ord"), F.min("donor_id").over(Window.partitionBy("cluster_id")).alias("canonical_id"))
    return mem, model(spark, sf_dir, "contributions").filter("donor_id % 5 <> 0").groupBy("donor_id").agg(total(F.col("amount")).alias("amount"))


@query("ag16_family_rollup", oracle(FAMILIES + """, k AS (SELECT m.*, s.amount, count(*) OVER (PARTITION BY cluster_id) AS size FROM mem m JOIN sums s ON m.donor_id = s.donor_id), p AS (SELECT *, coalesce(max(CASE WHEN donor_id = canonical_id THEN donor_id END) OVER (PARTITION BY cluster_id), first_value(donor_id) OVER (PARTITION BY cluster_id ORDER BY ord, donor_id)) AS parent FROM k WHERE size >= 2)
  SELECT cluster_id, donor_id, CASE WHEN donor_id = parent THEN 'parent' ELSE 'alt-name' END AS role, amount, CAST(sum(amount) OVER (PARTITION BY cluster_id) AS DECIMAL(18,2)) AS family_total FROM p"""))
def ag16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.family_rollup(*families(spark, sf_dir))


@query("ag17_family_repair", oracle(FAMILIES + """, h AS (SELECT m.*, m.donor_id IN (SELECT donor_id FROM sums WHERE donor_id % 3 = 1) AS here FROM mem m), g AS (SELECT cluster_id, count(*) FILTER (here) AS members, arg_min(donor_id, (ord, donor_id)) FILTER (here) AS first, max(donor_id) FILTER (here AND donor_id = canonical_id) AS parent FROM h GROUP BY 1)
  SELECT cluster_id, CASE WHEN members = 0 THEN 'prune' WHEN members = 1 THEN 'dissolve' WHEN parent IS NOT NULL THEN 'keep' ELSE 're-parent' END AS action, CASE WHEN members >= 2 THEN coalesce(parent, first) END AS parent_id, members FROM g"""))
def ag17(spark: SparkSession, sf_dir: str) -> DataFrame:
    mem, sums = families(spark, sf_dir)
    return entities.repair_families(mem.withColumn("is_parent", F.col("donor_id") == F.col("canonical_id")), sums.filter("donor_id % 3 = 1"))


@query("ag62_families_of_rows", oracle(FAMILIES + " SELECT cluster_id, arg_min(upper(cluster_id) || ord % 3, ord) AS name, string_agg(CAST(donor_id AS VARCHAR), ',' ORDER BY ord, donor_id) AS members, arg_min(canonical_id + ord % 2, ord) AS canonical, count(DISTINCT canonical_id + ord % 2) > 1 AS conflict FROM mem GROUP BY 1"))
def ag62(spark: SparkSession, sf_dir: str) -> DataFrame:
    mem = families(spark, sf_dir)[0]
    rows = mem.select("cluster_id", F.concat(F.upper("cluster_id"), (F.col("ord") % 3).cast("string")).alias("cluster_name"), "donor_id", (F.col("canonical_id") + F.col("ord") % 2).alias("canonical_id"), "ord")
    return entities.families_from_members(rows)


@query("snk4_replace_partition", oracle("SELECT committee_id, donor_id, amount FROM contributions WHERE committee_id % 4 <> 1 UNION ALL SELECT committee_id, donor_id, CAST(amount * 2 AS DECIMAL(18,2)) FROM contributions WHERE committee_id % 4 = 1 AND line = 1 AND committee_id IN (SELECT committee_id FROM contributions WHERE line = 1)"))
def snk4(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "contributions").select("committee_id", "donor_id", "amount", "line")
    new = c.filter("committee_id % 4 = 1 AND line = 1").withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)"))
    return entities.replace_partition(c, new, "committee_id").drop("line")


@query("snk3_office_slice", oracle(", com AS (SELECT committee_id FROM committees WHERE office = 'mayor'), dir AS (SELECT DISTINCT donor_id FROM contributions WHERE committee_id IN (SELECT committee_id FROM com) AND line = 7), w AS (SELECT donor_id FROM dir UNION SELECT parent_id FROM donors WHERE donor_id IN (SELECT donor_id FROM dir)) SELECT donor_id, parent_id FROM donors WHERE donor_id IN (SELECT donor_id FROM w) OR cluster_id IN (SELECT cluster_id FROM donors WHERE donor_id IN (SELECT donor_id FROM w) AND cluster_id IS NOT NULL)"))
def snk3(spark: SparkSession, sf_dir: str) -> DataFrame:
    com = model(spark, sf_dir, "committees").filter("office = 'mayor'").select("committee_id")
    donors = model(spark, sf_dir, "donors").select("donor_id", "parent_id", "cluster_id")
    direct = model(spark, sf_dir, "contributions").filter("line = 7").join(com, "committee_id", "left_semi").select("donor_id").distinct()
    parents = donors.join(direct, "donor_id", "left_semi").select(F.col("parent_id").alias("donor_id"))
    reached = donors.join(direct.unionByName(parents).distinct(), "donor_id", "left_semi")
    members = donors.join(reached.filter("cluster_id IS NOT NULL").select("cluster_id").distinct(), "cluster_id", "left_semi")
    return reached.select("donor_id", "parent_id").unionByName(members.select("donor_id", "parent_id")).distinct()
