"""Queries of votes (SRC-9, SRC-13, FLT-9, FLT-14, JN-7, JN-8, JN-38 to JN-41, JN-43, JN-49, AG-18 to AG-20, AG-52, AG-53, AG-59, SO-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions.text import tally_text
from civicspark.operators import calendar, entities, votes

from .model import model, oracle, raw, values_sql
from .registry import query
from civicspark.functions.money import POSITION, RECORD

SEATED = """, st AS (SELECT *, count(*) OVER (PARTITION BY person_id) AS k FROM memberships), ranked AS (SELECT v.*, s.seat, s.k, s.person_id IS NOT NULL AND s.start_date <= v.date AND (s.end_date IS NULL OR s.end_date >= v.date) AS act, s.start_date AS sd, s.end_date AS ed FROM person_votes v LEFT JOIN st s ON v.voter_id = s.person_id)
  , seated AS (SELECT vote_id, date, voter_id, option, event_id, seat, k > 1 AND NOT act AS fallback FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY act DESC, sd DESC, seat DESC, ed DESC NULLS LAST) AS rn FROM ranked) WHERE rn = 1)"""


def seated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.seat_at(model(spark, sf_dir, "person_votes"), model(spark, sf_dir, "memberships"))


@query("jn7_seat_at_date", oracle(SEATED + " SELECT event_id, seat, coalesce(fallback, false) AS fallback FROM seated"))
def jn7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seated(spark, sf_dir).select("event_id", "seat", "fallback")


@query("jn8_voter_by_name", oracle("SELECT v.event_id, coalesce(v.vid, u.person_id) AS voter_id FROM (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN voter_id END AS vid, 'Member ' || CASE WHEN voter_id < 20 THEN 0 ELSE voter_id END AS vname FROM person_votes) v LEFT JOIN (SELECT 'Member ' || CASE WHEN voter_id < 20 THEN 0 ELSE voter_id END AS name, min(voter_id) AS person_id FROM (SELECT DISTINCT voter_id FROM person_votes) GROUP BY 1 HAVING count(*) = 1) u ON u.name = v.vname"))
def jn8(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("Member "), F.when(F.col("voter_id") < 20, 0).otherwise(F.col("voter_id")).cast("string"))
    v = model(spark, sf_dir, "person_votes").withColumn("voter_name", name)
    people = v.select(F.col("voter_id").alias("person_id"), F.col("voter_name").alias("name")).distinct()
    v = v.withColumn("voter_id", F.when(F.col("event_id") % 3 != 0, F.col("voter_id")))
    return votes.fill_voter_ids(v, people).select("event_id", "voter_id")


@query("flt9_divided", oracle("SELECT DISTINCT vote_id FROM person_votes WHERE option IN ('no', 'abstain')"))
def flt9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.divided_votes(model(spark, sf_dir, "person_votes"))


@query("flt14_active", oracle("SELECT person_id, seat FROM memberships WHERE start_date <= DATE '2024-01-14' AND (end_date IS NULL OR end_date >= DATE '2024-01-09')"))
def flt14(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda d: F.lit(d).cast("date")
    return model(spark, sf_dir, "memberships").filter(calendar.active_in(F.col("start_date"), F.col("end_date"), day("2024-01-09"), day("2024-01-14"))).select("person_id", "seat")


@query("ag18_tallies", oracle(SEATED + f""", t AS (SELECT vote_id, string_agg(option || ' ' || n, ', ' ORDER BY option) AS tally FROM (SELECT vote_id, option, count(*) AS n FROM seated GROUP BY ALL) GROUP BY 1)
  , p AS (SELECT vote_id, string_agg(seat || '=' || {values_sql('option', RECORD)}, ',' ORDER BY CAST(seat AS VARCHAR)) AS positions FROM (SELECT vote_id, seat, arg_max(option, event_id) AS option FROM seated WHERE seat IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
  SELECT t.vote_id, tally, positions, (SELECT count(*) FROM seated s WHERE s.vote_id = t.vote_id AND s.seat IS NULL) AS unresolved FROM t LEFT JOIN p ON t.vote_id = p.vote_id"""))
def ag18(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = votes.tallies(seated(spark, sf_dir))
    positions = F.array_join(F.transform(F.array_sort(F.map_entries("positions")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return t.select("vote_id", tally_text(F.col("tally")).alias("tally"), positions.alias("positions"), "unresolved")


@query("ag19_semantic_positions", oracle(f"SELECT vote_id, {values_sql('option', POSITION)} AS position, count(*) AS n FROM person_votes WHERE vote_id LIKE '%-12' GROUP BY 1, 2"))
def ag19(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = model(spark, sf_dir, "person_votes")
    return votes.semantic_positions(v, v.filter("vote_id LIKE '%-12'").select("vote_id").distinct())


@query("ag20_memberships", oracle("SELECT seat, string_agg(CAST(person_id AS VARCHAR), ',' ORDER BY start_date, person_id) AS people, count(*) AS n FROM memberships GROUP BY 1"))
def ag20(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start_date", "person_id"))), lambda x: x["person_id"].cast("string")), ",")
    return model(spark, sf_dir, "memberships").groupBy("seat").agg(people.alias("people"), F.count(F.lit(1)).alias("n"))


@query("ag52_vote_profile", oracle("SELECT month, count(*) AS events, count(*) FILTER (d) AS divided, count(*) FILTER (n < 10) AS few, count(*) FILTER (n BETWEEN 10 AND 24) AS some, count(*) FILTER (n >= 25) AS many FROM (SELECT strftime(date, '%Y-%m') AS month, vote_id, count(*) AS n, bool_or(option IN ('no', 'abstain')) AS d FROM person_votes GROUP BY 1, 2) GROUP BY 1"))
def ag52(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.vote_profile(model(spark, sf_dir, "person_votes"))


@query("ag53_membership_profile", oracle("SELECT seat, count(DISTINCT person_id) AS holders, count(*) - 1 AS successions, count(*) FILTER (end_date IS NULL) AS open FROM memberships GROUP BY 1"))
def ag53(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.membership_profile(model(spark, sf_dir, "memberships"))


@query("ag59_vote_counts", oracle("SELECT vote_id, count(*) FILTER (option = 'yes') AS yes, count(*) FILTER (option = 'no') AS no FROM person_votes GROUP BY 1"))
def ag59(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model(spark, sf_dir, "person_votes").groupBy("vote_id").agg(F.count_if(F.col("option") == "yes").alias("yes"), F.count_if(F.col("option") == "no").alias("no"))


@query("jn38_unresolved_voters", oracle("SELECT DISTINCT voter_id FROM person_votes WHERE voter_id NOT IN (SELECT person_id FROM memberships WHERE seat < 25)"))
def jn38(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.unresolved_voters(model(spark, sf_dir, "person_votes"), model(spark, sf_dir, "memberships").filter("seat < 25"))


@query("jn39_41_pruned_positions", oracle("SELECT vote_id, voter_id, count(*) AS n FROM person_votes WHERE vote_id NOT IN (SELECT vote_id FROM person_votes WHERE option = 'no') GROUP BY 1, 2"))
def jn39(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = model(spark, sf_dir, "person_votes")
    return votes.prune_positions(v, v.filter("option = 'no'"))[1].groupBy("vote_id", "voter_id").agg(F.count(F.lit(1)).alias("n"))


@query("jn39_first_by_code", oracle("SELECT vote_id, min(event_id) AS event_id FROM person_votes GROUP BY 1"))
def jn39b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.first_by_code(model(spark, sf_dir, "person_votes"), "vote_id", "event_id").select("vote_id", "event_id")


@query("jn40_49_editor_values", oracle("SELECT v.vote_id, coalesce(CASE WHEN v.vote_id LIKE '%-1%' THEN 'edited' END, CASE WHEN v.vote_id LIKE '%-0%' THEN 'seed' END) AS title, CASE WHEN v.vote_id LIKE '%-1%' THEN 'row' WHEN v.vote_id LIKE '%-0%' THEN 'seed' END AS title_source, CASE WHEN v.vote_id LIKE '%3' THEN 'housing' END AS tag FROM (SELECT DISTINCT vote_id FROM person_votes) v"))
def jn40(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = model(spark, sf_dir, "person_votes").select("vote_id").distinct()
    rows, seed = v.filter("vote_id LIKE '%-1%'").withColumn("t", F.lit("edited")), v.filter("vote_id LIKE '%-0%'").withColumn("t", F.lit("seed"))
    out = entities.resolve(v.withColumn("tag", F.lit("old")), "vote_id", [("row", rows), ("seed", seed)], "t", "title")
    return out.drop("tag").join(v.filter("vote_id LIKE '%3'").withColumn("tag", F.lit("housing")), "vote_id", "left")


@query("src9_unpivot", oracle("SELECT vote_id, seat, CASE WHEN n = 0 THEN '-' WHEN n > 3 THEN 'No' ELSE 'Yes' END AS position FROM (SELECT vote_id, seat, n FROM (SELECT vote_id, count(*) FILTER (voter_id % 3 = 0) AS s0, count(*) FILTER (voter_id % 3 = 1) AS s1, count(*) FILTER (voter_id % 3 = 2) AS s2 FROM person_votes GROUP BY 1) UNPIVOT (n FOR seat IN (s0, s1, s2)))"))
def src9(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = model(spark, sf_dir, "person_votes")
    cell = lambda i: F.count_if(F.col("voter_id") % 3 == i)
    grid = v.groupBy("vote_id").agg(*[F.when(cell(i) == 0, "  ").when(cell(i) > 3, "No").otherwise("Yes").alias(f"s{i}") for i in range(3)])
    return votes.unpivot_votes(grid, ["vote_id"], ["Yes", "No"])[0]


@query("jn43_cast_by", oracle("""SELECT DISTINCT vote_id, voter_id % 10 AS seat, unnest(list_filter([CASE WHEN vote_id NOT IN (SELECT vote_id FROM person_votes WHERE option = 'yes') THEN 'unknown vote' END, CASE WHEN vote_id IN (SELECT vote_id FROM person_votes WHERE option = 'yes') AND voter_id % 10 > 7 THEN 'unknown seat' END, CASE WHEN voter_id % 10 = 5 THEN 'blank position' END, CASE WHEN voter_id % 10 = 3 THEN 'blank name' END], lambda x: x IS NOT NULL)) AS violation FROM person_votes"""))
def jn43(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = model(spark, sf_dir, "person_votes").withColumn("seat", F.col("voter_id") % 10)
    cast = v.select("vote_id", "seat", F.when(F.col("seat") == 3, " ").otherwise("name").alias("cast_by_name")).distinct()
    seats = v.filter("seat <= 7").select("vote_id", "seat", F.when(F.col("seat") == 5, "-").otherwise("Yes").alias("position")).distinct()
    return votes.cast_by_violations(cast, v.filter("option = 'yes'"), seats)


@query("so1_feed", oracle("SELECT * FROM (SELECT vote_id, date, 'council' AS body FROM (SELECT DISTINCT vote_id, date FROM person_votes WHERE option = 'no') UNION ALL SELECT CAST(conv_id AS VARCHAR), DATE '2024-01-30', 'board' FROM (SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) > 4)) ORDER BY date DESC, body DESC, vote_id DESC LIMIT 10"))
def so1(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = model(spark, sf_dir, "person_votes").filter("option = 'no'").select("vote_id", "date", F.lit("council").alias("body")).distinct()
    c = raw(spark, sf_dir, "conversations").groupBy("conv_id").count().filter("count > 4").select(F.col("conv_id").cast("string").alias("vote_id"), F.lit("2024-01-30").cast("date").alias("date"), F.lit("board").alias("body"))
    return v.unionByName(c).orderBy(F.desc("date"), F.desc("body"), F.desc("vote_id")).limit(10)
