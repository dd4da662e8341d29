"""Queries of the money predicates (FLT), calendars (JN-3, JN-4), and roll-ups (AG-1 to AG-7, AG-21 to AG-31)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions import classify, money
from civicspark.functions.money import total
from civicspark.operators import calendar, rollups

from .model import model, oracle, raw
from .registry import query

M = "CAST(coalesce(sum({}), 0) AS DECIMAL(18,2))"
#: The counted base in SQL: contributions with donor and cycle, excluded money left out.
CYCLED = """, cycled AS (SELECT c.*, CASE WHEN c.date IS NULL THEN 'undated' WHEN y.code IS NOT NULL THEN y.code WHEN c.date < DATE '1995-06-01' THEN 'pre-2011' ELSE '2001' END AS cycle
    FROM contributions c LEFT JOIN cycles y ON c.date BETWEEN y.start_date AND y.end_date)"""
COUNTED = CYCLED + """, counted AS (SELECT c.*, d.parent_id, d.type AS donor_type, d.tags, d.name AS donor_name FROM cycled c JOIN donors d ON c.donor_id = d.donor_id
    WHERE NOT c.is_aggregate AND c.cycle NOT IN ('pre-2011', 'undated') AND c.contribution_type <> 'IE Committee Dues Transfer'
      AND (c.contribution_type <> 'Other Receipt' OR c.is_own_committee) AND d.type <> 'Aggregate')"""


def cycled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.with_cycle(model(spark, sf_dir, "contributions"), model(spark, sf_dir, "cycles"), after="last", gap="last")


def joined(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """Contributions (or facts, made of them by cycled()) with their donors."""
    donors = model(spark, sf_dir, "donors").select("donor_id", "parent_id", F.col("type").alias("donor_type"), "tags", F.col("name").alias("donor_name"))
    facts = cycled(spark, sf_dir) if facts is None else facts
    return facts.join(donors, "donor_id", "left")


def counted(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    rule = money.counted(F.col("contribution_type"), F.col("cycle"), F.col("is_aggregate"), F.col("is_own_committee"), F.col("donor_type"))
    return joined(spark, sf_dir, facts).filter(rule)


def tag_list(c: str = "tags"):
    return F.filter(F.split(c, ","), lambda t: t != "")


@query("ag1_by_parent", oracle(COUNTED + f""", m AS (SELECT parent_id, count(*) AS members FROM donors WHERE type <> 'Aggregate' GROUP BY 1)
  SELECT g.*, coalesce(m.members, 1) AS members FROM (SELECT parent_id, coalesce(cycle, 'all') AS cycle, {M.format("CASE WHEN committee_id % 5 <> 0 THEN amount END")} AS direct, {M.format("CASE WHEN committee_id % 5 = 0 THEN amount END")} AS independent,
    {M.format('amount')} AS total, count(*) AS n, count(DISTINCT committee_id) AS committees FROM counted GROUP BY GROUPING SETS ((parent_id), (parent_id, cycle))) g LEFT JOIN m ON g.parent_id = m.parent_id"""))
def ag1(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = model(spark, sf_dir, "donors").filter("type <> 'Aggregate'").groupBy("parent_id").agg(F.count(F.lit(1)).alias("members"))
    return rollups.by_parent(counted(spark, sf_dir), members, F.col("committee_id") % 5 == 0)


@query("ag2_by_industry", oracle(COUNTED + f""", facts AS (SELECT string_split(tags, ',') AS tags, cycle, amount, 'direct' AS stream FROM counted
    UNION ALL SELECT [c.tag], CASE WHEN y.code IS NOT NULL THEN y.code WHEN e.date < DATE '1995-06-01' THEN 'pre-2011' ELSE '2001' END, e.amount, 'independent' FROM expenditures e JOIN committees c ON e.spender_id = c.committee_id LEFT JOIN cycles y ON e.date BETWEEN y.start_date AND y.end_date)
  SELECT tag, coalesce(cycle, 'all') AS cycle, {M.format("CASE WHEN stream = 'direct' THEN amount END")} AS direct, {M.format("CASE WHEN stream = 'independent' THEN amount END")} AS independent
  FROM (SELECT unnest(tags) AS tag, cycle, amount, stream FROM facts WHERE cycle <> 'pre-2011') WHERE tag <> '' GROUP BY GROUPING SETS ((tag), (tag, cycle))"""))
def ag2(spark: SparkSession, sf_dir: str) -> DataFrame:
    direct = counted(spark, sf_dir).select(tag_list().alias("tags"), "cycle", "amount", F.lit("direct").alias("stream"))
    spent = calendar.with_cycle(model(spark, sf_dir, "expenditures"), model(spark, sf_dir, "cycles"), after="last", gap="last").filter("cycle NOT IN ('pre-2011', 'undated')")
    tags = model(spark, sf_dir, "committees").select(F.col("committee_id").alias("spender_id"), F.array("tag").alias("tags"))
    return rollups.by_tag(direct.unionByName(spent.join(tags, "spender_id").select("tags", "cycle", "amount", F.lit("independent").alias("stream"))))


STREAMS = COUNTED + """, facts AS (SELECT m.ward, m.candidate_id, m.race_id, c.cycle, c.amount, 'direct' AS stream FROM counted c JOIN committees m ON c.committee_id = m.committee_id WHERE m.type = 'candidate'
    UNION ALL SELECT m.ward, m.candidate_id, m.race_id, CASE WHEN y.code IS NOT NULL THEN y.code WHEN e.date < DATE '1995-06-01' THEN 'pre-2011' ELSE '2001' END, e.amount, 'ie_' || e.stance
      FROM expenditures e JOIN committees m ON e.target_id = m.committee_id LEFT JOIN cycles y ON e.date BETWEEN y.start_date AND y.end_date WHERE m.type = 'candidate')"""
STREAM_SUMS = ", ".join(M.format(f"CASE WHEN stream = '{s}' THEN amount END") + f" AS {s}" for s in ("direct", "ie_support", "ie_oppose"))


def stream_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees").filter("type = 'candidate'").select("committee_id", "ward", "candidate_id", "race_id", "office_type", "person_id")
    direct = counted(spark, sf_dir).join(m, "committee_id").select("ward", "candidate_id", "race_id", "cycle", "amount", F.lit("direct").alias("stream"))
    spent = calendar.with_cycle(model(spark, sf_dir, "expenditures"), model(spark, sf_dir, "cycles"), after="last", gap="last")
    spent = spent.join(m.withColumnRenamed("committee_id", "target_id"), "target_id").select("ward", "candidate_id", "race_id", "cycle", "amount", F.concat(F.lit("ie_"), "stance").alias("stream"))
    return direct.unionByName(spent)


@query("ag3_by_ward", oracle(STREAMS + f" SELECT ward, cycle, {STREAM_SUMS} FROM facts WHERE ward IS NOT NULL AND cycle <> 'pre-2011' GROUP BY 1, 2"))
def ag3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_key_streams(stream_facts(spark, sf_dir).filter("ward IS NOT NULL AND cycle <> 'pre-2011'"), ["ward", "cycle"], ["direct", "ie_support", "ie_oppose"])


@query("ag4_by_candidate_race", oracle(STREAMS + f""" SELECT 'candidate_id' AS kind, CAST(candidate_id AS VARCHAR) AS key, {STREAM_SUMS} FROM facts WHERE cycle <> 'pre-2011' GROUP BY candidate_id
  UNION ALL SELECT 'race_id', CAST(race_id AS VARCHAR), {STREAM_SUMS} FROM facts WHERE cycle <> 'pre-2011' GROUP BY race_id"""))
def ag4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_keys_grouped(stream_facts(spark, sf_dir).filter("cycle <> 'pre-2011'"), ["candidate_id", "race_id"], ["direct", "ie_support", "ie_oppose"])


WINDOWED = COUNTED + """, placed AS (SELECT c.*, m.candidate_id, m.person_id, m.office_type, m.race_id, (SELECT min_by(w.window_id, w.ord) FROM windows w WHERE w.office_type = m.office_type AND (w.start_date IS NULL OR c.date >= w.start_date) AND (w.end_date IS NULL OR c.date <= w.end_date)) AS window_id
    FROM counted c JOIN committees m ON c.committee_id = m.committee_id WHERE m.type = 'candidate')
  , ie AS (SELECT e.*, m.candidate_id, m.office_type, (SELECT min_by(w.window_id, w.ord) FROM windows w WHERE w.office_type = m.office_type AND (w.start_date IS NULL OR e.date >= w.start_date) AND (w.end_date IS NULL OR e.date <= w.end_date)) AS window_id
    FROM expenditures e JOIN committees m ON e.target_id = m.committee_id WHERE m.type = 'candidate')"""


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted money to candidates with the election window of its date."""
    m = model(spark, sf_dir, "committees").filter("type = 'candidate'").select("committee_id", "candidate_id", "person_id", "office_type", "race_id")
    return calendar.with_window(counted(spark, sf_dir).join(m, "committee_id"), model(spark, sf_dir, "windows"))


def placed_spending(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees").filter("type = 'candidate'").select(F.col("committee_id").alias("target_id"), "candidate_id", "office_type")
    return calendar.with_window(model(spark, sf_dir, "expenditures").join(m, "target_id"), model(spark, sf_dir, "windows"))


FOUR = ["contributions", "self_funding", "ie_support", "ie_oppose"]


@query("ag5_by_candidate_election", oracle(WINDOWED + """, f AS (SELECT candidate_id, window_id, amount, CASE WHEN donor_id % 100 = candidate_id % 100 THEN 'self_funding' ELSE 'contributions' END AS stream FROM placed UNION ALL SELECT candidate_id, window_id, amount, 'ie_' || stance FROM ie)
  SELECT candidate_id, window_id, """ + ", ".join(M.format(f"CASE WHEN stream = '{s}' THEN amount END") + f" AS {s}, count(*) FILTER (stream = '{s}') AS {s}_n" for s in FOUR) + " FROM f WHERE window_id IS NOT NULL GROUP BY 1, 2"))
def ag5(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.when(F.col("donor_id") % 100 == F.col("candidate_id") % 100, "self_funding").otherwise("contributions")
    facts = placed(spark, sf_dir).select("candidate_id", "window_id", "amount", own.alias("stream")).unionByName(placed_spending(spark, sf_dir).select("candidate_id", "window_id", "amount", F.concat(F.lit("ie_"), "stance").alias("stream")))
    return rollups.by_key_streams(facts.filter("window_id IS NOT NULL"), ["candidate_id", "window_id"], FOUR, counts=True)


@query("ag6_by_person", oracle(WINDOWED + f""", f AS (SELECT person_id, window_id, CAST(extract(year FROM date) AS INT) AS year, donor_id, amount FROM placed)
  SELECT person_id, 'all' AS level, CAST(NULL AS VARCHAR) AS part, {M.format('amount')} AS amount, count(*) AS n FROM f GROUP BY 1 UNION ALL SELECT person_id, 'window', window_id, {M.format('amount')}, count(*) FROM f GROUP BY person_id, window_id
  UNION ALL SELECT person_id, 'year', CAST(year AS VARCHAR), {M.format('amount')}, count(*) FROM f GROUP BY person_id, year UNION ALL SELECT person_id, 'donor', CAST(donor_id AS VARCHAR), {M.format('amount')}, count(*) FROM f GROUP BY person_id, donor_id"""))
def ag6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.person_totals(placed(spark, sf_dir).select("person_id", "window_id", F.year("date").alias("year"), "donor_id", "amount"))


@query("ag7_excluded", oracle(CYCLED + f""" SELECT r.reason, coalesce(x.amount, CAST(0 AS DECIMAL(18,2))) AS amount, coalesce(x.n, 0) AS n FROM (VALUES ('dues'), ('other'), ('never')) r(reason) LEFT JOIN (
  SELECT CASE WHEN contribution_type = 'IE Committee Dues Transfer' THEN 'dues' WHEN contribution_type = 'Other Receipt' AND NOT is_own_committee THEN 'other' END AS reason, {M.format('amount')} AS amount, count(*) AS n FROM cycled WHERE NOT is_aggregate AND cycle NOT IN ('pre-2011', 'undated') GROUP BY 1) x ON r.reason = x.reason"""))
def ag7(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = cycled(spark, sf_dir).filter("NOT is_aggregate AND cycle NOT IN ('pre-2011', 'undated')")
    kind = F.col("contribution_type")
    return rollups.excluded_magnitude(facts, {"dues": kind == money.DUES_TYPE, "other": money.is_excluded_other(kind, F.col("is_own_committee")), "never": F.lit(False)})


@query("jn3_cycle_of_date", oracle("""SELECT CASE WHEN date IS NULL THEN 'none' WHEN code IS NOT NULL THEN code WHEN date < DATE '1995-06-01' THEN 'early' WHEN date > DATE '2001-05-31' THEN 'late' ELSE 'between' END AS cycle, date, count(*) AS n
  FROM contributions LEFT JOIN cycles ON date BETWEEN start_date AND end_date GROUP BY ALL"""))
def jn3(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calendar.with_cycle(model(spark, sf_dir, "contributions"), model(spark, sf_dir, "cycles"), before="early", after="late", gap="between", null="none")
    return c.groupBy("cycle", "date").agg(F.count(F.lit(1)).alias("n"))


@query("jn4_window_of_date", oracle(WINDOWED + " SELECT office_type, window_id, count(*) AS n, min(date) AS first, max(date) AS last FROM placed GROUP BY 1, 2"))
def jn4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(spark, sf_dir).groupBy("office_type", "window_id").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last"))


@query("flt1_2_live_rows", oracle("SELECT committee_id, count(*) FILTER (source_filing % 10 <> 0) AS live, count(*) FILTER (source_filing % 10 <> 0 AND NOT source_filing % 7 < 6) AS live_only, count(*) FILTER (NOT source_filing % 10 <> 0 AND source_filing % 7 < 6) AS registry_only FROM contributions GROUP BY 1"))
def flt1(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "contributions").withColumn("archived", F.when(F.col("source_filing") % 10 == 0, "True").otherwise("False"))
    live, registered = F.col("archived") == "False", F.col("source_filing") % 7 < 6
    return c.groupBy("committee_id").agg(F.count_if(live).alias("live"), F.count_if(live & ~registered).alias("live_only"), F.count_if(~live & registered).alias("registry_only"))


@query("flt3_receipt_floor", oracle(f"SELECT committee_id, count(*) FILTER (date >= floor) AS kept, count(*) FILTER (date < floor) AS withheld, {M.format('CASE WHEN date < floor THEN amount END')} AS withheld_amount FROM contributions JOIN (SELECT committee_id, CASE WHEN committee_id % 3 = 0 THEN DATE '1997-01-01' END AS floor FROM committees) f USING (committee_id) WHERE floor IS NOT NULL GROUP BY 1"))
def flt3(spark: SparkSession, sf_dir: str) -> DataFrame:
    floors = model(spark, sf_dir, "committees").filter("committee_id % 3 = 0").select("committee_id", F.lit("1997-01-01").cast("date").alias("floor"))
    c = model(spark, sf_dir, "contributions").join(floors, "committee_id")
    below = F.col("date") < F.col("floor")
    return c.groupBy("committee_id").agg(F.count_if(F.col("date") >= F.col("floor")).alias("kept"), F.count_if(below).alias("withheld"), total(F.when(below, F.col("amount"))).alias("withheld_amount"))


@query("flt4_admission", "SELECT CASE WHEN c_acctbal > 0 AND c_custkey % 13 <> 0 THEN 'admitted' WHEN c_custkey % 13 = 0 THEN 'blank payer' ELSE 'no amount' END AS outcome, count(*) AS n FROM customer GROUP BY 1")
def flt4(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = raw(spark, sf_dir, "customer").select(F.col("c_acctbal").cast("string").alias("amount"), F.when(F.col("c_custkey") % 13 == 0, "  ").otherwise(F.col("c_name")).alias("payer"))
    positive = F.coalesce(F.col("amount").try_cast("decimal(18,2)") > 0, F.lit(False))
    outcome = F.when(F.trim("payer") == "", "blank payer").when(positive, "admitted").otherwise("no amount")
    return c.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("flt5_counted", oracle(COUNTED + f" SELECT contribution_type, cycle, count(*) AS n, {M.format('amount')} AS amount FROM counted GROUP BY 1, 2"))
def flt5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(spark, sf_dir).groupBy("contribution_type", "cycle").agg(F.count(F.lit(1)).alias("n"), total(F.col("amount")).alias("amount"))


@query("flt6_7_independent", oracle(f"SELECT e.spender_id, e.stance, count(*) AS n, {M.format('e.amount')} AS amount FROM expenditures e WHERE e.stance IN ('support', 'oppose') AND NOT EXISTS (SELECT 1 FROM committees c WHERE c.committee_id = e.spender_id AND (c.type = 'candidate' OR c.committee_id % 10 = 5)) GROUP BY 1, 2"))
def flt6(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = model(spark, sf_dir, "committees").filter("type = 'candidate' OR committee_id % 10 = 5").select(F.col("committee_id").alias("spender_id"))
    return model(spark, sf_dir, "expenditures").filter(F.col("stance").isin("support", "oppose")).join(own, "spender_id", "left_anti").groupBy("spender_id", "stance").agg(F.count(F.lit(1)).alias("n"), total(F.col("amount")).alias("amount"))


@query("flt8_16_window_algebra", oracle("SELECT office_type, CASE WHEN count(start_date) = count(*) THEN min(start_date) END AS start_date, CASE WHEN count(end_date) = count(*) THEN max(end_date) END AS end_date FROM windows GROUP BY 1"))
def flt16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.window_union(model(spark, sf_dir, "windows"))


@query("flt8_16_seat_spans", oracle("SELECT seat, CASE WHEN count(start_date) = count(*) THEN min(start_date) END AS start_date, CASE WHEN count(end_date) = count(*) THEN max(end_date) END AS end_date FROM memberships GROUP BY 1"))
def flt16_seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.window_union(model(spark, sf_dir, "memberships"), "seat")


@query("flt10_scope", oracle(f"SELECT office_type, count(*) AS n, {M.format('amount')} AS amount FROM (SELECT e.*, CASE e.part_id % 3 WHEN 0 THEN 'school_board' WHEN 1 THEN 'municipal' END AS office_type FROM expenditures e) x WHERE office_type IS NOT NULL AND EXISTS (SELECT 1 FROM windows w WHERE w.office_type = x.office_type AND (w.start_date IS NULL OR x.date >= w.start_date) AND (w.end_date IS NULL OR x.date <= w.end_date)) AND spender_id % 10 <> 5 GROUP BY 1"))
def flt10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civicspark.functions.text import office_kind

    office = F.when(F.col("part_id") % 3 == 0, "School Board").when(F.col("part_id") % 3 == 1, "Alderperson").otherwise("Sheriff")
    e = model(spark, sf_dir, "expenditures").withColumn("office_type", office_kind(office)).filter("office_type IS NOT NULL AND spender_id % 10 <> 5")
    return calendar.with_window(e, model(spark, sf_dir, "windows")).filter("window_id IS NOT NULL").groupBy("office_type").agg(F.count(F.lit(1)).alias("n"), total(F.col("amount")).alias("amount"))


@query("flt15_thresholds", oracle(COUNTED + f" SELECT donor_id, {M.format('amount')} AS amount FROM counted GROUP BY 1 HAVING sum(amount) >= 500000"))
def flt15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(spark, sf_dir).groupBy("donor_id").agg(total(F.col("amount")).alias("amount")).filter("amount >= 500000")


@query("ag12_data_through", "SELECT coalesce(o_orderpriority, 'all') AS kind, CAST(max(o_orderdate) AS DATE) AS through FROM orders GROUP BY GROUPING SETS ((o_orderpriority), ())")
def ag12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "orders").rollup("o_orderpriority").agg(F.max("o_orderdate").cast("date").alias("through")).select(F.coalesce("o_orderpriority", F.lit("all")).alias("kind"), "through")


VECTOR = {"council": "office_type = 'municipal' AND office = 'alderperson'", "board": "office_type = 'school_board'", "mayor": "office = 'mayor'"}


@query("ag21_donor_vector", oracle(COUNTED + ", j AS (SELECT c.*, m.office, m.office_type, m.type AS ctype FROM counted c JOIN committees m ON c.committee_id = m.committee_id) SELECT parent_id, cycle, " + ", ".join(M.format(f"CASE WHEN ctype = 'candidate' AND {w} THEN amount END") + f" AS {k}" for k, w in VECTOR.items()) + f", {M.format(chr(67) + 'ASE WHEN ctype <> ' + repr('candidate') + ' THEN amount END')} AS groups, {M.format('CASE WHEN contribution_type = ' + repr('Loan Received') + ' THEN amount END')} AS loans, {M.format('CASE WHEN is_own_committee THEN amount END')} AS own FROM j GROUP BY 1, 2"))
def ag21(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees").select("committee_id", "office", "office_type", F.col("type").alias("ctype"))
    j = counted(spark, sf_dir).join(m, "committee_id")
    parts = [total(F.when((F.col("ctype") == "candidate") & F.expr(w), F.col("amount"))).alias(k) for k, w in VECTOR.items()]
    parts += [total(F.when(F.col("ctype") != "candidate", F.col("amount"))).alias("groups"), total(F.when(money.is_loan(F.col("contribution_type")), F.col("amount"))).alias("loans"), total(F.when(F.col("is_own_committee"), F.col("amount"))).alias("own")]
    return j.groupBy("parent_id", "cycle").agg(*parts)


@query("ag22_ledger", oracle(CYCLED + f""" SELECT r.reason, coalesce(x.amount, CAST(0 AS DECIMAL(18,2))) AS amount, coalesce(x.n, 0) AS n FROM (VALUES ('before floor'), ('not counted'), ('own group')) r(reason) LEFT JOIN (SELECT CASE WHEN date < DATE '1995-06-01' THEN 'before floor' WHEN contribution_type IN ('Other Receipt', 'IE Committee Dues Transfer') THEN 'not counted' WHEN is_own_committee THEN 'own group' END AS reason, {M.format('amount')} AS amount, count(*) AS n FROM cycled GROUP BY 1) x ON r.reason = x.reason"""))
def ag22(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.excluded_magnitude(cycled(spark, sf_dir), {"before floor": F.col("date") < F.lit("1995-06-01").cast("date"), "not counted": F.col("contribution_type").isin(money.OTHER_TYPE, money.DUES_TYPE), "own group": F.col("is_own_committee")})


@query("ag23_group_spend", oracle(f"SELECT spender_id, CASE WHEN code IS NOT NULL THEN code WHEN date < DATE '1995-06-01' THEN 'pre-2011' ELSE '2001' END AS cycle, stance, {M.format('amount')} AS amount, count(*) AS n FROM expenditures LEFT JOIN cycles ON date BETWEEN start_date AND end_date GROUP BY 1, 2, 3"))
def ag23(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = calendar.with_cycle(model(spark, sf_dir, "expenditures"), model(spark, sf_dir, "cycles"), after="last", gap="last")
    return e.groupBy("spender_id", "cycle", "stance").agg(total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("n"))


@query("ag27_member_streams", oracle(WINDOWED + f""", f AS (SELECT person_id, window_id, candidate_id, amount FROM placed) SELECT person_id, window_id, count(DISTINCT candidate_id) AS candidacies, {M.format('amount')} AS contributions, CASE WHEN window_id IS NULL THEN 'not on the ballot' ELSE window_id END AS label FROM f GROUP BY 1, 2"""))
def ag27(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = placed(spark, sf_dir).groupBy("person_id", "window_id").agg(F.countDistinct("candidate_id").alias("candidacies"), total(F.col("amount")).alias("contributions"))
    return f.withColumn("label", F.coalesce("window_id", F.lit("not on the ballot")))


DONOR_ROWS = WINDOWED + f""", own AS (SELECT DISTINCT donor_id, window_id, candidate_id FROM placed WHERE donor_id % 100 = candidate_id % 100)
  , rows_ AS (SELECT p.candidate_id, p.window_id, p.donor_id, p.tags, {M.format('p.amount')} AS amount, count(*) AS n FROM placed p WHERE p.window_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM own o WHERE o.donor_id = p.donor_id AND o.window_id = p.window_id AND o.candidate_id = p.candidate_id) GROUP BY 1, 2, 3, 4)"""


def donor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Donors of a candidate in a window; who funds the own campaign is left out whole."""
    p = placed(spark, sf_dir).filter("window_id IS NOT NULL").withColumn("own", F.expr("donor_id % 100 = candidate_id % 100"))
    g = p.groupBy("candidate_id", "window_id", "donor_id", "tags").agg(total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("n"), F.bool_or("own").alias("own"))
    return g.filter("NOT own").drop("own")


@query("ag28_donor_rows", oracle(DONOR_ROWS + " SELECT candidate_id, window_id, donor_id, amount, n FROM rows_"))
def ag28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return donor_rows(spark, sf_dir).select("candidate_id", "window_id", "donor_id", "amount", "n")


APPORTION = """, e AS (SELECT *, CAST(CASE WHEN t <> 0 THEN CAST(dollars AS DECIMAL(20,2)) * 1000000 / CAST(t AS DECIMAL(20,2)) ELSE 0 END AS DOUBLE) AS x FROM l)
  , f AS (SELECT *, CAST(floor(x) AS BIGINT) AS fl FROM e), r AS (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY x - fl DESC, class) AS rn, sum(fl) OVER (PARTITION BY {k}) AS s FROM f)
  , u AS (SELECT *, fl + CASE WHEN t <> 0 AND rn <= 1000000 - s THEN 1 ELSE 0 END AS units FROM r)"""


@query("ag29_wn6_coverage", oracle(DONOR_ROWS + f""", k AS (SELECT *, CASE WHEN len(p) = 0 THEN 'unclassified' WHEN len(list_filter(p, lambda t: t <> 'individual')) = 0 THEN 'individual_only' ELSE 'substantive' END AS class FROM (SELECT *, list_filter(string_split(tags, ','), lambda t: t NOT IN ('unclassified', '')) AS p FROM rows_))
  , g AS (SELECT window_id, {', '.join(M.format(f"CASE WHEN class = '{c}' THEN amount END") + f' AS {c}' for c in ('individual_only', 'substantive', 'unclassified'))}, {M.format('amount')} AS donor_total, count(*) AS donor_count FROM k GROUP BY 1)
  , l AS (SELECT window_id, donor_total AS t, unnest(['individual_only', 'substantive', 'unclassified']) AS class, unnest([individual_only, substantive, unclassified]) AS dollars FROM g)""" + APPORTION.format(k="window_id") + """
  SELECT g.*, a.units AS individual_only_units, b.units AS substantive_units, c.units AS unclassified_units, b.units >= 500000 AS meets FROM g JOIN u a ON a.window_id = g.window_id AND a.class = 'individual_only' JOIN u b ON b.window_id = g.window_id AND b.class = 'substantive' JOIN u c ON c.window_id = g.window_id AND c.class = 'unclassified'"""))
def ag29(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = donor_rows(spark, sf_dir).withColumn("industry_class", classify.industry_class(tag_list()))
    return rollups.coverage(rows, ["window_id"])


@query("ag30_spending_slice", oracle(WINDOWED + f" SELECT window_id, spender_id, candidate_id, {M.format('CASE WHEN stance = ' + repr('support') + ' THEN amount END')} AS support, {M.format('CASE WHEN stance = ' + repr('oppose') + ' THEN amount END')} AS oppose, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS docs FROM ie WHERE window_id IS NOT NULL GROUP BY 1, 2, 3"))
def ag30(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = placed_spending(spark, sf_dir).filter("window_id IS NOT NULL")
    docs = F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",")
    return e.groupBy("window_id", "spender_id", "candidate_id").agg(total(F.when(F.col("stance") == "support", F.col("amount"))).alias("support"), total(F.when(F.col("stance") == "oppose", F.col("amount"))).alias("oppose"), docs.alias("docs"))


@query("ag31_universe", oracle(DONOR_ROWS + " SELECT d.donor_id, d.parent_id, d.cluster_id FROM donors d WHERE d.donor_id IN (SELECT donor_id FROM rows_) OR d.cluster_id IN (SELECT x.cluster_id FROM donors x WHERE x.donor_id IN (SELECT donor_id FROM rows_) AND x.cluster_id IS NOT NULL)"))
def ag31(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = donor_rows(spark, sf_dir).select("donor_id").distinct()
    donors = model(spark, sf_dir, "donors").select("donor_id", "parent_id", "cluster_id")
    direct = donors.join(seen, "donor_id", "left_semi")
    families = direct.filter("cluster_id IS NOT NULL").select("cluster_id").distinct()
    return direct.unionByName(donors.join(families, "cluster_id", "left_semi").select("donor_id", "parent_id", "cluster_id")).distinct()


@query("ag56_57_cycle_labels", oracle("SELECT w.office_type, w.window_id, w.window_id || ' (' || coalesce(CAST(w.start_date AS VARCHAR), '...') || ')' AS label, (SELECT max_by(code, election_date) FROM cycles) AS current FROM windows w"))
def ag56(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = model(spark, sf_dir, "cycles").agg(F.max_by("code", "election_date").alias("current")).first()["current"]
    label = F.concat("window_id", F.lit(" ("), F.coalesce(F.col("start_date").cast("string"), F.lit("...")), F.lit(")"))
    return model(spark, sf_dir, "windows").select("office_type", "window_id", label.alias("label"), F.lit(current).alias("current"))


@query("ag56_57_stint_labels", oracle("""SELECT m.seat, m.person_id AS code, m.start_date, m.end_date, m.person_id || ' (' || m.start_date || ' to ' || coalesce(CAST(m.end_date AS VARCHAR), '...') || ')' AS label, l.current
  FROM memberships m JOIN (SELECT seat, arg_max(person_id, (start_date, person_id)) AS current FROM memberships GROUP BY 1) l ON m.seat = l.seat"""))
def ag56_stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    stints = model(spark, sf_dir, "memberships").select("seat", F.col("person_id").alias("code"), "start_date", "end_date")
    return calendar.interval_labels(stints, "seat")


@query("dq26_overlapping_windows", oracle("SELECT previous, window_id AS code, previous_end, start_date FROM (SELECT *, lag(window_id) OVER (ORDER BY start_date, window_id) AS previous, lag(end_date) OVER (ORDER BY start_date, window_id) AS previous_end FROM windows WHERE office_type = 'municipal') WHERE start_date <= previous_end"))
def dq26(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.overlapping_intervals(model(spark, sf_dir, "windows").filter("office_type = 'municipal'").withColumnRenamed("window_id", "code"))


@query("dq26_overlapping_stints", oracle("SELECT seat, previous, person_id AS code, previous_end, start_date FROM (SELECT *, lag(person_id) OVER w AS previous, lag(end_date) OVER w AS previous_end FROM memberships WINDOW w AS (PARTITION BY seat ORDER BY start_date, person_id)) WHERE start_date <= previous_end"))
def dq26_stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    stints = model(spark, sf_dir, "memberships").withColumnRenamed("person_id", "code")
    return calendar.overlapping_intervals(stints, ["seat"])
