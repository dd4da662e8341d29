"""Queries of filings and reconciliation (JN-1, JN-5, JN-6, JN-23, JN-36, AG-8 to AG-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions.money import total
from civicspark.operators import calendar, filings
from civicspark.sources.work import folder

from .model import model, oracle, raw
from .money import M
from .registry import query

TYPES = ["Individual Contribution", "Transfer In", "Loan Received", "Other Receipt"]
IN_KIND = "In-kind Contribution"
_T = "('" + "', '".join(TYPES) + "')"
LATEST = """, latest AS (SELECT committee_id, beg, fin, arg_max(doc_id, (received, doc_id)) AS doc_id, max(received) AS received, count(*) - 1 AS superseded FROM own GROUP BY 1, 2, 3)
  , gone AS (SELECT a.committee_id, a.doc_id, arg_max(b.doc_id, (b.received, b.doc_id)) AS by_doc, max(b.received) AS by_received FROM latest a JOIN latest b ON a.committee_id = b.committee_id AND b.received > a.received AND a.beg <= b.fin AND b.beg <= a.fin GROUP BY 1, 2)
  , finals AS (SELECT * FROM latest WHERE doc_id NOT IN (SELECT doc_id FROM gone))"""
#: Every seventh filing covers a longer period, so that periods overlap.
OWN = ", own AS (SELECT doc_id, committee_id, CASE WHEN doc_id % 7 = 0 THEN CAST(beg - INTERVAL '45' DAY AS DATE) ELSE beg END AS beg, fin, received, kind FROM filings)"
PERIODS = OWN + LATEST + """, sworn_finals AS (SELECT f.*, coalesce(individual + transfers + loans + other, 0) AS itemised, coalesce(in_kind, 0) AS in_kind, individual IS NULL AS missing FROM finals f LEFT JOIN sworn s ON f.doc_id = s.doc_id)"""
#: Contributions here belong to the filer of their order.
FACTS = f""", facts AS (SELECT donor_id AS committee_id, date, amount, contribution_type, is_aggregate FROM contributions)
  , hit AS (SELECT f.*, (SELECT min((p.beg, p.fin)) FROM finals p WHERE p.committee_id = f.committee_id AND f.date BETWEEN p.beg AND p.fin) AS p FROM facts f WHERE date IS NOT NULL AND contribution_type IN {_T[:-1]}, '{IN_KIND}'))
  , ours AS (SELECT committee_id, p, CAST(coalesce(sum(CASE WHEN contribution_type IN {_T} THEN amount END), 0) AS DECIMAL(18,2)) AS oi, CAST(coalesce(sum(CASE WHEN contribution_type = '{IN_KIND}' THEN amount END), 0) AS DECIMAL(18,2)) AS ok FROM hit WHERE p IS NOT NULL GROUP BY 1, 2)
  , per AS (SELECT s.committee_id, s.beg, s.fin, CAST(s.itemised AS DECIMAL(18,2)) AS itemised, coalesce(oi, CAST(0 AS DECIMAL(18,2))) AS ours_itemised, CAST(coalesce(oi, 0) - s.itemised AS DECIMAL(18,2)) AS residual, CAST(s.in_kind AS DECIMAL(18,2)) AS in_kind, coalesce(ok, CAST(0 AS DECIMAL(18,2))) AS ours_in_kind, coalesce(oi, 0) = 0 AND s.itemised > 0 AS coverage_miss
      FROM sworn_finals s LEFT JOIN ours o ON o.committee_id = s.committee_id AND o.p = (s.beg, s.fin))"""
COMMITTEES = f""", agg AS (SELECT committee_id, count(*) AS periods, {M.format('itemised')} AS sworn_itemised, {M.format('ours_itemised')} AS ours_itemised, {M.format('in_kind')} AS sworn_in_kind, {M.format('ours_in_kind')} AS ours_in_kind, bool_or(ours_itemised + ours_in_kind <> itemised + in_kind) AS differs, bool_or(coverage_miss) AS miss, max(fin) AS last_end FROM per GROUP BY 1)
  , pend AS (SELECT f.committee_id, {M.format(f'CASE WHEN contribution_type IN {_T} AND NOT is_aggregate AND date > last_end THEN amount END')} AS pending, {M.format('CASE WHEN is_aggregate THEN amount END')} AS aggregate FROM facts f JOIN agg a ON a.committee_id = f.committee_id GROUP BY 1)
  , com AS (SELECT a.committee_id, periods, CASE WHEN differs THEN 'RESIDUAL' ELSE 'RECONCILED' END AS state, concat_ws(',', CASE WHEN pending > 0 THEN 'PENDING' END, CASE WHEN abs(ours_itemised - sworn_itemised) > 100000 THEN 'OVER-THRESHOLD' END, CASE WHEN miss THEN 'COVERAGE-MISS' END) AS flags,
      sworn_itemised, ours_itemised, CAST(ours_itemised - sworn_itemised AS DECIMAL(18,2)) AS residual, sworn_in_kind, ours_in_kind, coalesce(pending, CAST(0 AS DECIMAL(18,2))) AS pending, coalesce(aggregate, CAST(0 AS DECIMAL(18,2))) AS aggregate, last_end FROM agg a LEFT JOIN pend p ON a.committee_id = p.committee_id
      UNION ALL SELECT id, 0, 'TOO-NEW', '', CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)), NULL FROM (SELECT donor_id AS id FROM donors UNION ALL SELECT -1 - committee_id FROM committees) WHERE id NOT IN (SELECT committee_id FROM agg))"""


def own_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = model(spark, sf_dir, "filings")
    return f.withColumn("beg", F.when(F.col("doc_id") % 7 == 0, F.date_sub("beg", 45)).otherwise(F.col("beg")))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model(spark, sf_dir, "contributions").select(F.col("donor_id").alias("committee_id"), "date", "amount", "contribution_type", "is_aggregate")


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.sworn_amounts(filings.final_filings(own_filings(spark, sf_dir)), model(spark, sf_dir, "sworn"))


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """df, written once: what several grains read."""
    path = folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def matched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The sworn periods, and the facts summed by them; each given table is read once."""
    latest = stored(spark, filings.latest_versions(own_filings(spark, sf_dir)), "latest")
    p = stored(spark, filings.sworn_amounts(filings.unsuperseded(latest), model(spark, sf_dir, "sworn")), "periods")
    return p, stored(spark, filings.matched_facts(p, facts(spark, sf_dir), TYPES, IN_KIND, F.col("is_aggregate")), "matched")


def by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.reconcile_periods(*matched(spark, sf_dir))


def by_committee(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The registry holds those who file here and committees of another kind that have filed nothing yet.
    registry = raw(spark, sf_dir, "customer").select(F.col("c_custkey").alias("committee_id")).unionByName(raw(spark, sf_dir, "supplier").select((-1 - F.col("s_suppkey")).alias("committee_id")))
    return filings.reconcile_committees(*matched(spark, sf_dir), 100000, registry)


@query("ag8_latest_versions", oracle(OWN + LATEST + " SELECT * FROM latest"))
def ag8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.latest_versions(own_filings(spark, sf_dir))


@query("jn6_overlap_supersede", oracle(OWN + LATEST + " SELECT * FROM gone"))
def jn6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.overlap_superseders(filings.latest_versions(own_filings(spark, sf_dir)))


@query("ag9_sworn_totals", oracle(PERIODS + " SELECT doc_id, committee_id, beg, fin, received, superseded, CAST(itemised AS DECIMAL(18,2)) AS itemised, CAST(in_kind AS DECIMAL(18,2)) AS in_kind, missing FROM sworn_finals"))
def ag9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods(spark, sf_dir)


@query("ag9_orphan_totals", oracle("SELECT doc_id FROM sworn WHERE doc_id NOT IN (SELECT doc_id FROM filings WHERE doc_id % 5 <> 0)"))
def ag9b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.orphan_totals(model(spark, sf_dir, "sworn"), model(spark, sf_dir, "filings").filter("doc_id % 5 <> 0"))


@query("ag10_jn5_reconcile_periods", oracle(PERIODS + FACTS + " SELECT * FROM per"))
def ag10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_period(spark, sf_dir)


@query("ag10_reconcile_committees", oracle(PERIODS + FACTS + COMMITTEES + " SELECT * FROM com"))
def ag10b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_committee(spark, sf_dir)


@query("ag11_headline", oracle(PERIODS + FACTS + COMMITTEES + f" SELECT count(*) AS committees, count(*) FILTER (state = 'TOO-NEW') AS too_new, count(*) FILTER (state = 'RECONCILED') AS reconciled, count(*) FILTER (state = 'RESIDUAL') AS with_residual, {M.format('sworn_itemised')} AS sworn, {M.format('ours_itemised')} AS ours, round(100.0 * count(*) FILTER (state = 'RECONCILED') / count(*) FILTER (state <> 'TOO-NEW'), 1) AS match_percent FROM com"))
def ag11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.headline(by_committee(spark, sf_dir))


GAPS = ", gaps AS (SELECT committee_id, beg, fin, CASE WHEN committee_id % 3 = 0 THEN CAST(residual + 1 AS DECIMAL(18,2)) ELSE residual END AS amount, 'reason ' || committee_id % 5 AS reason FROM per WHERE committee_id % 4 = 0)"


def gaps(by: DataFrame) -> DataFrame:
    p = by.filter("committee_id % 4 = 0")
    return p.select("committee_id", "beg", "fin", F.when(F.col("committee_id") % 3 == 0, F.col("residual") + 1).otherwise(F.col("residual")).cast("decimal(18,2)").alias("amount"), F.concat(F.lit("reason "), (F.col("committee_id") % 5).cast("string")).alias("reason"))


@query("jn36_known_gaps", oracle(PERIODS + FACTS + GAPS + " SELECT p.committee_id, p.beg, p.fin, p.residual, g.reason FROM per p JOIN gaps g ON p.committee_id = g.committee_id AND p.beg = g.beg AND p.fin = g.fin AND p.residual = g.amount"))
def jn36(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = by_period(spark, sf_dir)
    return filings.apply_known_gaps(by, gaps(by))[0]


@query("jn36_stale_gaps", oracle(PERIODS + FACTS + GAPS + " SELECT * FROM gaps g WHERE NOT EXISTS (SELECT 1 FROM per p WHERE p.committee_id = g.committee_id AND p.beg = g.beg AND p.fin = g.fin AND p.residual = g.amount)"))
def jn36b(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = by_period(spark, sf_dir)
    return filings.apply_known_gaps(by, gaps(by))[1]


@query("ag13_latest_cash", oracle(OWN + LATEST + """, last AS (SELECT committee_id, arg_max(doc_id, (fin, beg, doc_id)) AS doc_id, max(fin) AS as_of FROM finals GROUP BY 1)
  SELECT c.c_custkey AS committee_id, l.doc_id, l.as_of, s.cash, l.doc_id IS NOT NULL AND s.cash IS NULL AS lacks_totals FROM customer c LEFT JOIN last l ON l.committee_id = c.c_custkey LEFT JOIN sworn s ON s.doc_id = l.doc_id"""))
def ag13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings.latest_cash(model(spark, sf_dir, "donors").select(F.col("donor_id").alias("committee_id")), filings.final_filings(own_filings(spark, sf_dir)), model(spark, sf_dir, "sworn"))


GIFTS = OWN + LATEST + ", g AS (SELECT f.committee_id, f.beg, f.fin, s.small_gifts AS amount, f.doc_id FROM finals f JOIN sworn s ON f.doc_id = s.doc_id WHERE s.small_gifts <> 0)"


@query("ag14_small_gifts", oracle(GIFTS + " SELECT committee_id, string_agg(CAST(beg AS VARCHAR) || ' ' || CAST(fin AS VARCHAR) || ' ' || CAST(amount AS VARCHAR), ';' ORDER BY beg, fin, amount, doc_id) AS periods, CAST(sum(amount) AS DECIMAL(18,2)) AS small_total FROM g GROUP BY 1"))
def ag14(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = filings.small_gifts(filings.final_filings(own_filings(spark, sf_dir)), model(spark, sf_dir, "sworn"))
    return g.select("committee_id", F.array_join(F.transform("periods", lambda p: F.concat_ws(" ", p["beg"].cast("string"), p["fin"].cast("string"), p["amount"].cast("string"))), ";").alias("periods"), "small_total")


@query("ag15_small_gifts_by_window", oracle(GIFTS + f" SELECT w.window_id, count(*) AS reports, {M.format('g.amount')} AS small, count(DISTINCT g.committee_id) AS committees FROM g JOIN windows w ON w.office_type = 'municipal' AND w.ord = (SELECT min(v.ord) FROM windows v WHERE v.office_type = 'municipal' AND g.fin BETWEEN v.start_date AND v.end_date) GROUP BY 1"))
def ag15(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = filings.small_gifts(filings.final_filings(own_filings(spark, sf_dir)), model(spark, sf_dir, "sworn"))
    spread = g.select("committee_id", F.lit("municipal").alias("office_type"), F.inline("periods"))
    placed = calendar.with_window(spread, model(spark, sf_dir, "windows"), date="fin").filter("window_id IS NOT NULL")
    return placed.groupBy("window_id").agg(F.count(F.lit(1)).alias("reports"), total(F.col("amount")).alias("small"), F.countDistinct("committee_id").alias("committees"))


@query("jn1_2_receipts_with_filings", oracle("SELECT m.name, f.kind, f.beg, count(*) AS n, max(f.received) AS received FROM contributions c LEFT JOIN (SELECT * FROM filings WHERE doc_id % 6 <> 0) f ON c.source_filing = f.doc_id LEFT JOIN committees m ON m.committee_id = c.committee_id GROUP BY 1, 2, 3"))
def jn1(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = filings.tabulated_filings(model(spark, sf_dir, "contributions"), model(spark, sf_dir, "filings").filter("doc_id % 6 <> 0"))
    return c.join(model(spark, sf_dir, "committees").select("committee_id", "name"), "committee_id", "left").groupBy("name", "kind", "beg").agg(F.count(F.lit(1)).alias("n"), F.max("received").alias("received"))


@query("jn23_review_queue", oracle("SELECT m.committee_id, m.name, max(c.date) AS last_active FROM committees m JOIN contributions c ON c.committee_id = m.committee_id WHERE m.committee_id % 3 <> 0 GROUP BY 1, 2 HAVING max(c.date) >= DATE '2001-10-15'"))
def jn23(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees")
    return filings.review_queue(m.select("committee_id", "name"), model(spark, sf_dir, "contributions"), m.filter("committee_id % 3 = 0"), "2001-10-15")
