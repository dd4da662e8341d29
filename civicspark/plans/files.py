"""Queries of sources and sinks on files that Spark writes from the given tables (SRC-1, 2, 7, 13, 16, SNK-1, 2, 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.sources import bulk, ocd, reference, sinks, work

from .model import given, model, oracle, raw
from .registry import query


@query("src1_unmapped_bytes", "SELECT c_nationkey AS nation, count(*) * 2 AS n FROM customer WHERE c_custkey % 7 = 3 GROUP BY 1")
def src1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work.folder(spark, "bytes")
    odd = F.when(F.col("c_custkey") % 7 == 3, F.concat(F.lit("\x81 "), "c_name", F.lit(" \x9d"))).otherwise(F.col("c_name"))
    raw(spark, sf_dir, "customer").select("c_nationkey", odd.alias("v")).write.partitionBy("c_nationkey").option("encoding", "ISO-8859-1").text(path)
    nation = F.regexp_extract("file", "c_nationkey=([0-9]+)", 1).cast("int")
    return bulk.scan_unmapped(spark, path).groupBy(nation.alias("nation")).agg(F.sum("n").alias("n"))


@query("src2_7_bulk_table", "SELECT c_custkey AS committee, 'O’' || c_name || ' €' AS name, CAST(c_acctbal AS DECIMAL(18,2)) AS amount, true AS several_committees FROM customer WHERE c_custkey % 9 <> 4")
def src2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work.folder(spark, "bulk")
    k = F.col("c_custkey")
    filed = lambda c: F.when(k % 9 != 4, c)
    rows = raw(spark, sf_dir, "customer").select(filed(k).alias("committee"), filed(F.concat(F.lit("O’"), "c_name", F.lit(" €"))).alias("name"), filed(F.col("c_acctbal").cast("decimal(18,2)")).alias("amount"))
    rows.withColumn("name", bulk.to_latin(F.col("name"))).write.option("sep", "\t").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return bulk.read_receipts(bulk.read_bulk_tsv(spark, path, "committee long, name string, amount decimal(18,2)"), ["committee", "name"], "committee")


@query("src13_14_relations", oracle("SELECT vote_id, voter_id, option, 'name ' || voter_id AS voter_name FROM person_votes"))
def src13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work.folder(spark, "relations")
    v = model(spark, sf_dir, "person_votes").withColumn("name", F.concat(F.lit("name "), F.col("voter_id").cast("string")))
    v.select(F.col("vote_id").alias("VoteEvent_ID"), F.col("voter_id").alias("person_id"), F.col("name").alias("Name"), F.col("option").alias("vote"), "event_id").write.parquet(f"{path}/personvote")
    return ocd.read_ocd(spark, path, "personvote")


@query("src16_boundary_races", "SELECT 'sb-d' || (n_nationkey + 1) AS race_id, CAST(n_nationkey + 1 AS VARCHAR) AS district FROM nation")
def src16_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work.folder(spark, "boundary")
    district = F.struct(F.struct((F.col("n_nationkey") + 1).cast("string").alias("district")).alias("properties"))
    raw(spark, sf_dir, "nation").agg(F.collect_list(district["properties"]).alias("p")).select(F.transform("p", lambda p: F.struct(p.alias("properties"))).alias("features")).write.json(path)
    return reference.races_from_features(spark, path, "sb-d", 0)


@query("snk1_file_per_committee", oracle("SELECT CAST(committee_id AS INT) AS committee, count(*) AS n, CAST(sum(amount) AS DECIMAL(18,2)) AS amount FROM contributions GROUP BY 1"))
def snk1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work.folder(spark, "per-key")
    sinks.write_per_key(model(spark, sf_dir, "contributions"), path, "committee_id", ["donor_id", "amount", "date"])
    back = spark.read.option("header", True).schema("donor_id long, amount decimal(18,2), date date, by_committee_id int").csv(path)
    return back.groupBy(F.col("by_committee_id").alias("committee")).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount"))


@query("snk2_5_published_shards", oracle("SELECT donor_id, name, type FROM donors"))
def snk5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work.folder(spark, "published")
    d = model(spark, sf_dir, "donors")
    sinks.write_shards({"slim": (d, ["donor_id", "name", "type"]), "money": (model(spark, sf_dir, "contributions"), ["donor_id", "amount"])}, path)

    def complete(tables: dict[str, DataFrame]) -> None:
        if tables["slim"].count() != d.count():
            raise ValueError("donors are missing")

    sinks.publish(spark, {"slim": spark.read.parquet(f"{path}/slim"), "money": spark.read.parquet(f"{path}/money")}, path, "v1", complete)
    return sinks.current(spark, path, "slim")


#: Lines of reference tables, a file a nation: a comment, the header, then rows with faults by rule.
REFERENCE = """SELECT nation, ord, copy, id, text, kind, cells FROM (
    SELECT c_nationkey AS nation, CAST(c_custkey AS BIGINT) AS ord, copy, c_custkey AS id, CASE WHEN c_custkey % 19 = 3 THEN 'bad' ELSE lower(c_mktsegment) END AS kind, CASE WHEN c_custkey % 23 = 5 THEN 2 ELSE 3 END AS cells,
      CAST(c_custkey AS VARCHAR(20)) || chr(9) || CASE WHEN c_custkey % 19 = 3 THEN 'bad' ELSE lower(c_mktsegment) END || CASE WHEN c_custkey % 23 = 5 THEN '' ELSE chr(9) || CASE WHEN c_custkey % 29 = 7 THEN ' ' ELSE '' END || c_name END AS text
    FROM customer JOIN (SELECT 0 AS copy UNION ALL SELECT 1 AS copy) t ON copy = 0 OR c_custkey % 31 = 9)"""
_NUMBERED = f"WITH r AS (SELECT *, 2 + row_number() OVER (PARTITION BY nation ORDER BY ord, copy) AS line FROM ({REFERENCE}))"
SEGMENTS = ["automobile", "building", "furniture", "household", "machinery"]


@query("src10_reference_lines", _NUMBERED + """ SELECT nation, line, '2 cells, not 3' AS violation FROM r WHERE cells = 2 UNION ALL SELECT nation, line, 'name has edge spaces' FROM r WHERE cells = 3 AND id % 29 = 7
  UNION ALL SELECT nation, line, 'kind is not in its vocabulary' FROM r WHERE cells = 3 AND kind = 'bad' UNION ALL SELECT nation, line, 'id is unknown' FROM r WHERE cells = 3 AND id % 37 = 11
  UNION ALL SELECT nation, line, 'the key appears twice' FROM r WHERE cells = 3 AND copy = 1""")
def src10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work.folder(spark, "reference")
    nations = raw(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).distinct()
    heads = nations.select("nation", F.explode(F.array(F.struct(F.lit(-2).cast("long").alias("ord"), F.lit("# kept by editors").alias("text")), F.struct(F.lit(-1).cast("long").alias("ord"), F.lit("id\tkind\tname").alias("text")))).alias("x"))
    rows = heads.select("nation", "x.ord", F.lit(0).alias("copy"), "x.text").unionByName(given(spark, sf_dir, REFERENCE).select("nation", "ord", "copy", "text"))
    rows.repartition("nation").sortWithinPartitions("nation", "ord", "copy").select("nation", "text").write.partitionBy("nation").text(path)
    known = raw(spark, sf_dir, "customer").filter("c_custkey % 37 <> 11").select("c_custkey")
    bad = reference.load_reference(spark, path, ["id", "kind", "name"], ["id"], {"kind": SEGMENTS}, {"id": known})[1]
    return bad.select(F.regexp_extract("file", "nation=([0-9]+)", 1).cast("int").alias("nation"), F.col("line").cast("long").alias("line"), "violation")


#: A header for each nation's file: as it should be, with a wrong name, short, in another order, with a column twice.
HEADERS = """SELECT nation, CASE nation % 6 WHEN 1 THEN 'id,label,seat-1,seat-2,note' WHEN 2 THEN 'id,name,seat-1' WHEN 3 THEN 'name,id,seat-2,seat-1,note' WHEN 4 THEN 'id,name,seat-2,seat-1,note' WHEN 5 THEN 'id,name,seat-1,seat-1,note'
    ELSE 'id,name,seat-1,seat-2,note' END AS header FROM (SELECT DISTINCT c_nationkey AS nation FROM customer) n"""


@query("src6_8_file_headers", f"WITH h AS ({HEADERS}) " + " UNION ALL ".join(f"SELECT nation, '{check}' AS rule, '{fault}' AS fault FROM h WHERE nation % 6 = {k}" for check, k, fault in (
    ("exact", 1, "missing name"), ("exact", 1, "unknown label"), ("exact", 2, "missing note,seat-2"), ("exact", 3, "another order"), ("exact", 4, "another order"), ("exact", 5, "missing seat-2"), ("exact", 5, "twice seat-1"),
    ("wide", 1, "fixed columns"), ("wide", 2, "trailing columns"), ("wide", 2, "seat missing seat-1,seat-2"), ("wide", 3, "fixed columns"), ("wide", 5, "seat missing seat-2"))))
def src6_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work.folder(spark, "headers")
    rows = given(spark, sf_dir, HEADERS).select("nation", F.lit(0).cast("long").alias("ord"), F.col("header").alias("text"))
    rows = rows.unionByName(raw(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey") + 1, F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name")).toDF("nation", "ord", "text"))
    rows.repartition("nation").sortWithinPartitions("nation", "ord").select("nation", "text").write.partitionBy("nation").text(path)
    found = reference.file_headers(spark, path, ",")
    seats = spark.createDataFrame([("seat-1",), ("seat-2",)], "key string")
    exact = reference.header_faults(found, ["id", "name", "seat-1", "seat-2", "note"]).withColumn("rule", F.lit("exact"))
    wide = reference.wide_header_faults(found, ["id", "name"], seats, ["note"]).withColumn("rule", F.lit("wide"))
    return exact.unionByName(wide).select(F.regexp_extract("file", "nation=([0-9]+)", 1).cast("int").alias("nation"), "rule", "fault")
