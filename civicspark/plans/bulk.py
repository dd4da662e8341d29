"""Queries of bulk sources over lines that Spark derives from the given tables (SRC-3 to SRC-5, SRC-11, SRC-12, SRC-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.sources import bulk, reference

from .model import model, oracle, raw
from .registry import query

#: Physical lines of an export: each document is a file of two blocks, lines that begin with a capital start records.
LINES = "SELECT doc_id AS file, i, t[i] AS value FROM (SELECT doc_id, string_split(text, chr(10)) AS t, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)"
RECORDS = f"WITH l AS ({LINES}), r AS (SELECT *, sum(CASE WHEN regexp_matches(value, '^[A-Z]') THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY i) AS record FROM l), g AS (SELECT file, CAST(record AS BIGINT) AS record, count(*) AS lines, string_agg(value, chr(10) ORDER BY i) AS text FROM r GROUP BY 1, 2)"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = raw(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("pos", "value"))
    return spread.withColumn("block", F.floor(F.col("pos") / 5) * 4096)


@query("src3_reassemble", RECORDS + " SELECT * FROM g")
def src3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bulk.reassemble(lines(spark, sf_dir), "^[A-Z]")


@query("src4_admitted", RECORDS + ", c AS (SELECT *, string_split(regexp_replace(text, '[ ,.]+', chr(9), 'g'), chr(9)) AS f FROM g) SELECT file, record, lines, CAST(len(f) AS INT) AS size, array_to_string(f, '|') || repeat('|', greatest(40 - len(f), 0)) AS fields FROM c WHERE len(f) <= 40")
def src4(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = bulk.reassemble(lines(spark, sf_dir), "^[A-Z]").withColumn("text", F.regexp_replace("text", "[ ,.]+", "\t"))
    return bulk.split_admit_quarantine(r, 40)[0].withColumn("fields", F.array_join("fields", "|"))


@query("src4_5_quarantined", RECORDS + ", c AS (SELECT *, string_split(regexp_replace(text, '[ ,.]+', chr(9), 'g'), chr(9)) AS f FROM g) SELECT count(*) AS records, CAST(sum(lines) AS BIGINT) AS lines, CAST(max(len(f)) AS INT) AS longest FROM c WHERE len(f) > 40")
def src45(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = bulk.reassemble(lines(spark, sf_dir), "^[A-Z]").withColumn("text", F.regexp_replace("text", "[ ,.]+", "\t"))
    return bulk.split_admit_quarantine(r, 40)[1].agg(F.count(F.lit(1)).alias("records"), F.sum("lines").alias("lines"), F.max("size").alias("longest"))


@query("src11_json_maps", "SELECT CAST(c_custkey AS VARCHAR) AS donor, c_name AS name, c_mktsegment AS seg FROM customer")
def src11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document holds a hundred customers at most."""
    doc = raw(spark, sf_dir, "customer").groupBy("c_nationkey", F.floor(F.col("c_custkey") / 100)).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("c_custkey").cast("string"), F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg")))))).alias("doc"))
    return reference.explode_map(doc, "doc", "struct<name:string,seg:string>", "donor")


@query("src12_selection", oracle("SELECT committee_id, CASE WHEN committee_id % 3 = 0 THEN CAST(committee_id % 50 AS INT) END AS ward FROM committees WHERE committee_id % 10 <> 0"))
def src12(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("committee_id")
    scope = F.when(k % 3 == 0, F.concat(F.lit("ward-"), (k % 50).cast("string"))).otherwise("citywide")
    rows = model(spark, sf_dir, "committees").select(F.when(k % 10 == 0, " ").otherwise(k.cast("string")).alias("committee_id"), scope.alias("office_scope"))
    return reference.read_selection(rows).select(F.col("committee_id").cast("bigint"), "ward")


@query("src6_8_14_headers", "SELECT o_orderkey AS vote_id, o_orderstatus AS result FROM orders")
def src6(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = raw(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    reference.require_header(o, ["o_orderkey", "o_orderstatus"])
    reference.require_wide_header(o, ["o_orderkey"], ["o_orderstatus"], [])
    return reference.resolve_columns(o, {"vote_id": ["id", "O_ORDERKEY"], "result": ["result", "o_orderstatus"]})


@query("src16_races", oracle("SELECT 'ward-' || CAST(unnest(generate_series(1, 50)) AS VARCHAR) AS race_id, CAST(unnest(generate_series(1, 50)) AS VARCHAR) AS district, (SELECT count(*) FROM committees) AS committees"))
def src16(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = model(spark, sf_dir, "committees").agg(F.count(F.lit(1)).alias("committees"))
    return reference.races_from_features(spark, None, "ward-", 50).join(F.broadcast(n), F.lit(True))
