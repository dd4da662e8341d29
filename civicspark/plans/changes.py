"""Queries of keyed change plans (CH-1 to CH-6) and editor cells (SRC-15, SRC-17, SRC-18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.operators import changes
from civicspark.sources import reference

from .model import model, oracle, raw
from .registry import query


@query("ch1_classify_edits", """WITH live AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 = 0 THEN 'live' ELSE c_name END AS name, c_mktsegment AS seg FROM customer WHERE c_custkey % 5 <> 0), snap AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS seg FROM customer WHERE c_custkey % 7 <> 0),
  st AS (SELECT c_custkey AS k, 'name' AS cell, CASE WHEN c_custkey % 2 = 0 THEN 'new name' ELSE c_name END AS new FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'seg', 'BUILDING' FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 4 = 0),
  l AS (SELECT k, 'name' AS cell, name AS old FROM live UNION ALL SELECT k, 'seg', seg FROM live), s AS (SELECT k, 'name' AS cell, name AS was FROM snap UNION ALL SELECT k, 'seg', seg FROM snap)
  SELECT st.k, st.cell, CASE WHEN l.k IS NULL AND s.k IS NULL THEN 'NEW' WHEN s.k IS NULL THEN 'COLLISION' WHEN l.k IS NULL THEN 'HELD' WHEN l.old IS DISTINCT FROM s.was THEN 'CONFLICT' ELSE 'UPDATE' END AS action, l.old, st.new FROM st LEFT JOIN l ON st.k = l.k AND st.cell = l.cell LEFT JOIN s ON st.k = s.k AND st.cell = s.cell WHERE NOT (l.k IS NOT NULL AND l.old IS NOT DISTINCT FROM st.new)""")
def ch1(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = raw(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    k = F.col("k")
    live = c.filter("k % 5 <> 0").withColumn("name", F.when(k % 11 == 0, "live").otherwise(F.col("name")))
    staged = c.filter("k % 3 = 0").withColumn("name", F.when(k % 2 == 0, "new name").otherwise(F.col("name"))).withColumn("seg", F.when(k % 4 == 0, "BUILDING"))
    return changes.classify_edits(staged, live, c.filter("k % 7 <> 0"), "k", ["name", "seg"])


@query("ch2_src15_round_trip", "SELECT p_partkey AS id, p_type || '||' || p_name || '; ' || p_brand AS cell, 2 AS flags, true AS same, array_to_string([p_type, p_brand], '+') AS items FROM part")
def ch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = lambda t, u, n: F.struct(t.alias("type"), u.alias("url"), n.alias("note"))
    flags = F.array(flag(F.col("p_type"), F.lit(""), F.col("p_name")), flag(F.col("p_brand"), F.lit(""), F.lit("")))
    p = raw(spark, sf_dir, "part").withColumn("flags", flags).withColumn("cell", changes.encode_flags(F.col("flags")))
    back = changes.parse_flags(F.col("cell"))
    items = changes.parse_list(F.concat(F.lit(" "), "p_type", F.lit(" ,, "), "p_brand", F.lit(",")))
    return p.select(F.col("p_partkey").alias("id"), "cell", F.size(back).alias("flags"), (back == F.col("flags")).alias("same"), F.array_join(items, "+").alias("items"))


@query("ch3_sanitise", "SELECT page_id, translate(url || CASE WHEN page_id % 3 = 0 THEN ';|x' ELSE '' END, ';|', '  ') AS clean, CASE WHEN page_id % 3 = 0 THEN 'hold' END AS verdict FROM pages")
def ch3(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, verdict = changes.sanitise(F.concat("url", F.when(F.col("page_id") % 3 == 0, ";|x").otherwise("")), is_url=True)
    return raw(spark, sf_dir, "pages").select("page_id", clean.alias("clean"), verdict.alias("verdict"))


@query("ch4_new_families", "WITH r AS (SELECT n_nationkey AS request, min(c_custkey) AS parent_id FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), i AS (SELECT *, 'fam-' || CAST(40 + row_number() OVER (ORDER BY request) AS VARCHAR) AS cluster_id FROM r) SELECT i.cluster_id, c.c_custkey AS donor_id, CASE WHEN c.c_custkey = i.parent_id THEN 'parent' ELSE 'alt-name' END AS role FROM i JOIN customer c ON c.c_nationkey = i.request")
def ch4(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("request")).agg(F.min("c_custkey").alias("parent_id"), F.collect_list("c_custkey").alias("members"))
    existing = spark.createDataFrame([("fam-9",), ("fam-40",), ("other-99",)], "cluster_id string")
    return changes.new_families(r, existing)


FAM = "SELECT c_nationkey AS cluster_id, c_custkey AS donor_id, CASE WHEN c_custkey = min(c_custkey) OVER (PARTITION BY c_nationkey) THEN 'parent' ELSE 'alt-name' END AS role FROM customer"
#: Families of three with faults by rule: families of one, second parents, repeated members.
FAULTY = """SELECT CASE WHEN c_custkey % 30 = 5 THEN 1000000000 + c_custkey ELSE CAST(floor(c_custkey / 3) AS BIGINT) END AS cluster_id, c_custkey AS donor_id, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 21 = 1 THEN 'parent' ELSE 'alt-name' END AS role FROM customer
  UNION ALL SELECT CAST(floor(c_custkey / 3) AS BIGINT), c_custkey, 'alt-name' FROM customer WHERE c_custkey % 50 = 1"""


def fam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FAM.replace("FROM customer", "FROM {customer}"), customer=raw(spark, sf_dir, "customer"))


@query("ch5_edit_families", f"""WITH m AS ({FAM}), k AS (SELECT * FROM m WHERE cluster_id % 10 <> 9 AND NOT (cluster_id % 4 = 1 AND donor_id % 5 = 0)), a AS (SELECT * FROM k UNION ALL SELECT DISTINCT cluster_id, 900000000 + cluster_id, 'alt-name' FROM m WHERE cluster_id % 4 = 2 AND cluster_id % 10 <> 9), u AS (SELECT cluster_id, max(donor_id) AS up FROM m WHERE cluster_id % 4 = 3 GROUP BY 1)
  SELECT a.cluster_id, a.donor_id, CASE WHEN u.up IS NULL THEN a.role WHEN u.up = a.donor_id THEN 'parent' ELSE 'alt-name' END AS role FROM a LEFT JOIN u ON a.cluster_id = u.cluster_id""")
def ch5(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fam(spark, sf_dir)
    k = F.col("cluster_id")
    r = m.filter("cluster_id % 10 = 9").select("cluster_id", F.lit("delete").alias("op"), F.lit(None).cast("bigint").alias("donor_id"))
    r = r.unionByName(m.filter("cluster_id % 4 = 1 AND donor_id % 5 = 0").select("cluster_id", F.lit("remove").alias("op"), "donor_id"))
    r = r.unionByName(m.filter("cluster_id % 4 = 2").select("cluster_id", F.lit("add").alias("op"), (k + 900000000).cast("bigint").alias("donor_id")))
    r = r.unionByName(m.filter("cluster_id % 4 = 3").groupBy("cluster_id").agg(F.max("donor_id").alias("donor_id")).select("cluster_id", F.lit("promote").alias("op"), "donor_id"))
    return changes.edit_families(m, r)


@query("ch5_dq1_family_checks", f"WITH m AS ({FAULTY}) SELECT cluster_id, 'too few members' AS violation FROM m GROUP BY 1 HAVING count(*) < 2 UNION ALL SELECT cluster_id, 'not one parent' FROM m GROUP BY 1 HAVING count(*) FILTER (role = 'parent') <> 1 UNION ALL SELECT cluster_id, 'repeated member' FROM m GROUP BY 1 HAVING count(DISTINCT donor_id) < count(*)")
def ch5b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.check_families(spark.sql(FAULTY.replace("FROM customer", "FROM {customer}"), customer=raw(spark, sf_dir, "customer")))


@query("ch6_merge_families", f"WITH m AS ({FAM}), j AS (SELECT CASE WHEN cluster_id % 5 = 1 THEN cluster_id - 1 ELSE cluster_id END AS cluster_id, donor_id, CASE WHEN cluster_id % 5 = 1 THEN 'alt-name' ELSE role END AS role FROM m) SELECT cluster_id, donor_id, max(role) AS role FROM j GROUP BY 1, 2")
def ch6(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fam(spark, sf_dir)
    merges = m.filter("cluster_id % 5 = 1").select((F.col("cluster_id") - 1).alias("keep"), F.col("cluster_id").alias("drop")).distinct()
    return changes.merge_families(m, merges)


@query("src17_overrides", oracle("SELECT donor_id, CASE WHEN donor_id % 2 = 0 THEN employer END AS primary_industry, CAST(NULL AS VARCHAR) AS entity_type FROM donors WHERE donor_id % 5 <> 0"))
def src17(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").select(F.when(F.col("donor_id") % 5 == 0, " ").otherwise(F.col("donor_id").cast("string")).alias("donor_id"), F.when(F.col("donor_id") % 2 == 0, F.col("employer")).otherwise("  ").alias("primary_industry"))
    return reference.read_overrides(d, "donor_id", ["primary_industry", "entity_type"]).withColumn("donor_id", F.col("donor_id").cast("bigint"))


@query("src18_vocabulary", "SELECT coalesce(b.k, t.k) AS key, CASE WHEN coalesce(b.k, t.k) = 'NATION_1' THEN 'Starter' ELSE coalesce(t.label, b.label) END AS label FROM (SELECT n_name AS k, lower(n_name) AS label FROM nation WHERE n_nationkey < 15) b FULL JOIN (SELECT n_name AS k, CASE WHEN n_nationkey % 2 = 0 THEN 'Tab ' || n_name END AS label FROM nation WHERE n_nationkey > 5) t ON b.k = t.k")
def src18(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = raw(spark, sf_dir, "nation")
    base = n.filter("n_nationkey < 15").select(F.col("n_name").alias("key"), F.lower("n_name").alias("label"))
    tab = n.filter("n_nationkey > 5").select(F.col("n_name").alias("key"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("Tab "), "n_name")).alias("label"))
    return reference.merge_vocab(base, tab, {"NATION_1": "Starter"})


@query("src19_roster", "SELECT n_nationkey AS seat, nullif(trim(CASE WHEN n_nationkey % 3 = 0 THEN '  ' ELSE n_name END), '') AS name FROM nation WHERE n_nationkey % 7 <> 0")
def src19(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = raw(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") % 7 == 0, "at large").otherwise(F.col("n_nationkey").cast("string")).alias("seat"), F.when(F.col("n_nationkey") % 3 == 0, "  ").otherwise(F.col("n_name")).alias("name"))
    return reference.read_roster(n, "seat")
