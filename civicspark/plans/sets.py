"""Queries of set operations (SE-1 to SE-6) and fingerprints (SNK-6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.operators import setops
from civicspark.sources import sinks

from .model import model, oracle, raw
from .registry import query

TWO = ", a AS (SELECT donor_id, committee_id, amount FROM contributions WHERE line <> 3), b AS (SELECT donor_id, committee_id, amount FROM contributions WHERE line <> 5 UNION ALL SELECT donor_id, committee_id, amount FROM contributions WHERE line = 1)"
_K = ["donor_id", "committee_id", "amount"]


def two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = model(spark, sf_dir, "contributions")
    b = c.filter("line <> 5").select(*_K).unionByName(c.filter("line = 1").select(*_K))
    return c.filter("line <> 3").select(*_K), b


@query("se1_multiset_union", oracle(TWO + ", n AS (SELECT donor_id, committee_id, amount, max(x) AS x, max(y) AS y FROM (SELECT donor_id, committee_id, amount, count(*) AS x, 0 AS y FROM a GROUP BY 1, 2, 3 UNION ALL SELECT donor_id, committee_id, amount, 0, count(*) FROM b GROUP BY 1, 2, 3) GROUP BY 1, 2, 3) SELECT donor_id, committee_id, amount, CAST(x AS BIGINT) AS from_a, CAST(greatest(y - x, 0) AS BIGINT) AS from_b FROM n"))
def se1(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = setops.multiset_union(*two(spark, sf_dir), _K)
    return u.groupBy(*_K).agg(F.count_if(F.col("source") == "a").alias("from_a"), F.count_if(F.col("source") == "b").alias("from_b"))


DIFF = TWO + ", d AS (SELECT donor_id, committee_id, amount, CAST(sum(x) AS BIGINT) AS in_a, CAST(sum(y) AS BIGINT) AS in_b FROM (SELECT donor_id, committee_id, amount, count(*) AS x, 0 AS y FROM a GROUP BY 1, 2, 3 UNION ALL SELECT donor_id, committee_id, amount, 0, count(*) FROM b GROUP BY 1, 2, 3) GROUP BY 1, 2, 3 HAVING sum(x) <> sum(y))"


@query("se2_multiset_difference", oracle(DIFF + ", m AS (SELECT donor_id, committee_id, bool_or(in_a > in_b) AND bool_or(in_a < in_b) AS moved FROM d GROUP BY 1, 2) SELECT d.*, CASE WHEN moved THEN 'moved' WHEN in_a > in_b THEN 'extra' ELSE 'missing' END AS class FROM d JOIN m ON d.donor_id = m.donor_id AND d.committee_id = m.committee_id"))
def se2(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = setops.multiset_difference(*two(spark, sf_dir), _K)
    return setops.explain_differences(d, _K, ["donor_id", "committee_id"]).select(*_K, "in_a", "in_b", "class")


@query("se3_symmetric_difference", oracle("SELECT coalesce(a.donor_id, b.donor_id) AS donor_id, CASE WHEN a.donor_id IS NOT NULL THEN 'a' ELSE 'b' END AS only_in FROM (SELECT DISTINCT donor_id FROM contributions WHERE line = 1) a FULL JOIN (SELECT DISTINCT donor_id FROM contributions WHERE line = 2) b ON a.donor_id = b.donor_id WHERE a.donor_id IS NULL OR b.donor_id IS NULL"))
def se3(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "contributions")
    return setops.symmetric_difference(c.filter("line = 1"), c.filter("line = 2"), ["donor_id"])


@query("se4_ar6_snapshot_diff", "WITH o AS (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS seg FROM customer WHERE c_custkey % 7 <> 0), n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS name, c_mktsegment AS seg FROM customer WHERE c_custkey % 8 <> 0), x AS (SELECT k || '.name' AS path, name AS v FROM o UNION ALL SELECT k || '.seg', seg FROM o), y AS (SELECT k || '.name' AS path, name AS v FROM n UNION ALL SELECT k || '.seg', seg FROM n) SELECT * FROM (SELECT coalesce(x.path, y.path) AS path, x.v AS old, y.v AS new, CASE WHEN x.v IS NULL THEN 'added' WHEN y.v IS NULL THEN 'removed' WHEN x.v <> y.v THEN 'changed' END AS change FROM (SELECT * FROM x WHERE v IS NOT NULL) x FULL JOIN (SELECT * FROM y WHERE v IS NOT NULL) y ON x.path = y.path) WHERE change IS NOT NULL")
def se4(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = raw(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    old = c.filter("k % 7 <> 0").withColumn("seg", F.when(F.col("k") % 5 != 0, F.col("seg")))
    new = c.filter("k % 8 <> 0").withColumn("name", F.when(F.col("k") % 3 == 0, F.upper("name")).otherwise(F.col("name")))
    return setops.snapshot_diff(old, new, "k", ["name", "seg"])


@query("se5_shrink_only", oracle("SELECT * FROM (SELECT coalesce(f.donor_id, k.donor_id) AS donor_id, CASE WHEN k.most IS NULL THEN 'new failure' WHEN f.n IS NULL THEN 'stale entry' WHEN f.n > k.most THEN 'grew' END AS verdict FROM (SELECT donor_id, count(*) AS n FROM contributions WHERE amount > 95000 GROUP BY 1) f FULL JOIN (SELECT donor_id, 1 + donor_id % 3 AS most FROM donors WHERE donor_id % 2 = 0) k ON f.donor_id = k.donor_id) WHERE verdict IS NOT NULL"))
def se5(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = model(spark, sf_dir, "contributions").filter("amount > 95000").groupBy("donor_id").agg(F.count(F.lit(1)).alias("n"))
    known = model(spark, sf_dir, "donors").filter("donor_id % 2 = 0").select("donor_id", (F.col("donor_id") % 3 + 1).alias("most"))
    return setops.shrink_only(failures, known, "donor_id")


@query("se6_occurrences", oracle("SELECT 'contributions' AS \"table\", CAST(donor_id AS VARCHAR) AS key, count(*) AS n FROM contributions WHERE donor_id % 10 = 3 GROUP BY 2 UNION ALL SELECT 'donors', CAST(donor_id AS VARCHAR), count(*) FROM donors WHERE donor_id % 10 = 3 GROUP BY 2"))
def se6(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, c = model(spark, sf_dir, "donors"), model(spark, sf_dir, "contributions")
    return setops.occurrences({"contributions": c, "donors": d}, "donor_id", d.filter("donor_id % 10 = 3"), d.filter("donor_id = 1"))


_TOLD = {"double": "CAST({} AS DECIMAL(38,4))", "time": "strftime({}, '%Y-%m-%d %H:%M:%S.%f')", "": "{}"}
_STAMPED = {
    "customer": {"c_acctbal": "double", "c_custkey": "", "c_mktsegment": "", "c_name": "", "c_nationkey": ""},
    "documents": {"doc_id": "", "lang": "", "n_chars": "", "source": "", "text": ""},
    "lineitem": {"l_discount": "double", "l_extendedprice": "double", "l_linenumber": "", "l_linestatus": "", "l_orderkey": "", "l_partkey": "", "l_quantity": "double", "l_returnflag": "", "l_shipdate": "time", "l_suppkey": "", "l_tax": "double"},
    "orders": {"o_custkey": "", "o_orderdate": "time", "o_orderkey": "", "o_orderpriority": "", "o_orderstatus": "", "o_totalprice": "double"},
}


def _stamp_sql(name: str, columns: dict[str, str]) -> str:
    told = [f"CAST({_TOLD[kind].format(c)} AS VARCHAR)" for c, kind in columns.items()]
    row = " || ".join(f"CASE WHEN {t} IS NULL THEN 'n' ELSE CAST(length({t}) AS VARCHAR) || ':' || {t} END" for t in told)
    words = ", ".join(f"CAST(coalesce(sum(CAST('0x' || substring(h, {8 * i + 1}, 8) AS BIGINT)), 0) AS DECIMAL(38,0)) AS w{i + 1}" for i in range(4))
    return f"SELECT '{name}' AS \"table\", count(*) AS rows, {words} FROM (SELECT md5({row}) AS h FROM {name})"


@query("snk6_fingerprint", " UNION ALL ".join(_stamp_sql(*x) for x in _STAMPED.items()))
def snk6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of the parts by a column, merged to those of the tables."""
    parts = {"customer": "c_nationkey", "documents": "source", "lineitem": "l_linenumber", "orders": "o_orderpriority"}
    stamped = [sinks.fingerprint(raw(spark, sf_dir, t), [by]).select(F.lit(t).alias("table"), "rows", "w1", "w2", "w3", "w4") for t, by in parts.items()]
    return sinks.merged_fingerprints(reduce(DataFrame.unionAll, stamped), ["table"])
