"""Queries of the read models (AG-32 to AG-51, AG-54, AG-55, AG-58, AG-60, FLT-11 to FLT-13, SO-2 to SO-6, WN-1 to WN-11, AR-1 to AR-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.functions import money, text
from civicspark.functions.money import total
from civicspark.operators import calendar, entities, numbering, rollups, views

from .model import model, oracle, raw
from .money import COUNTED, CYCLED, M, WINDOWED, counted, cycled, placed, placed_spending, tag_list
from .registry import query

SELF = "donor_id % 100 = candidate_id % 100"


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(spark, sf_dir).filter("window_id IS NOT NULL").withColumn("is_self", F.expr(SELF)).withColumn("is_own", F.col("is_own_committee") & ~F.col("is_self")).withColumn("in_kind", money.is_in_kind(F.col("contribution_type")))


MARKED = WINDOWED + f", marked AS (SELECT *, {SELF} AS is_self, is_own_committee AND NOT ({SELF}) AS is_own, contribution_type = 'In-kind Contribution' AS in_kind FROM placed WHERE window_id IS NOT NULL)"


@query("ag37_candidate_figures", oracle(MARKED + f""", a AS (SELECT candidate_id, window_id, {M.format('amount')} AS total, {M.format('CASE WHEN is_self THEN amount END')} AS self_money, {M.format('CASE WHEN is_own THEN amount END')} AS own_committee, {M.format('CASE WHEN NOT is_self AND NOT is_own THEN amount END')} AS third_party, count(*) AS gifts FROM marked GROUP BY 1, 2)
  , b AS (SELECT candidate_id, window_id, {M.format("CASE WHEN stance = 'support' THEN amount END")} AS ie_support, {M.format("CASE WHEN stance = 'oppose' THEN amount END")} AS ie_oppose FROM ie WHERE window_id IS NOT NULL GROUP BY 1, 2)
  SELECT coalesce(a.candidate_id, b.candidate_id) AS candidate_id, coalesce(a.window_id, b.window_id) AS window_id, """ + ", ".join(f"coalesce({c}, 0::DECIMAL(18,2)) AS {c}" for c in ("total", "self_money", "own_committee", "third_party")) + ", coalesce(gifts, 0) AS gifts, coalesce(ie_support, 0::DECIMAL(18,2)) AS ie_support, coalesce(ie_oppose, 0::DECIMAL(18,2)) AS ie_oppose FROM a FULL JOIN b ON a.candidate_id = b.candidate_id AND a.window_id = b.window_id"))
def ag37(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.candidate_figures(marked(spark, sf_dir), placed_spending(spark, sf_dir).filter("window_id IS NOT NULL"), ["candidate_id", "window_id"])


@query("ag38_contributor_lines", oracle(MARKED + f" SELECT *, round(CASE WHEN amount <> 0 THEN CAST(in_kind AS DOUBLE) / CAST(amount AS DOUBLE) ELSE 0.0 END, 4) AS in_kind_share FROM (SELECT candidate_id, window_id, parent_id, {M.format('amount')} AS amount, count(*) AS gifts, bool_or(is_self) AS is_self, bool_or(is_own) AS is_own, {M.format('CASE WHEN in_kind THEN amount END')} AS in_kind FROM marked GROUP BY 1, 2, 3)"))
def ag38(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.contributor_lines(marked(spark, sf_dir), ["candidate_id", "window_id"])


@query("ag39_funder_lines", oracle(COUNTED + f" SELECT committee_id, parent_id, {M.format('amount')} AS amount, count(*) AS n FROM counted WHERE committee_id % 5 = 0 GROUP BY 1, 2"))
def ag39(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(spark, sf_dir).filter("committee_id % 5 = 0").groupBy("committee_id", "parent_id").agg(total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("n"))


@query("ag40_footprint", oracle(COUNTED + f", f AS (SELECT c.donor_id, c.amount, CAST(c.committee_id AS VARCHAR) AS committee_id, CAST(extract(year FROM c.date) AS VARCHAR) AS year, c.cycle, m.office FROM counted c JOIN committees m ON c.committee_id = m.committee_id) " + " UNION ALL ".join(f"SELECT donor_id, '{k}' AS level, {k} AS part, {M.format('amount')} AS amount, count(*) AS n FROM f GROUP BY donor_id, {k}" for k in ("committee_id", "year", "cycle", "office"))))
def ag40(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees").select("committee_id", "office")
    facts = cycled(spark, sf_dir).join(m, "committee_id").withColumn("year", F.year("date"))
    return views.donor_footprint(counted(spark, sf_dir, views.by_donor(facts, raw(spark, sf_dir, "lineitem").count())))


@query("ag41_committee_profile", oracle(WINDOWED + f" SELECT spender_id, window_id, count(DISTINCT target_id) AS targets, {M.format(chr(67) + 'ASE WHEN stance = ' + repr('support') + ' THEN amount END')} AS support, {M.format('CASE WHEN stance = ' + repr('oppose') + ' THEN amount END')} AS oppose, string_agg(DISTINCT flag, ',' ORDER BY flag) AS methods FROM ie GROUP BY 1, 2"))
def ag41(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.committee_profile(placed_spending(spark, sf_dir).withColumnRenamed("flag", "method"))


INDUSTRY = COUNTED + """, f AS (SELECT c.committee_id AS k, list_filter(string_split(c.tags, ','), lambda t: t <> '') AS tags, 'direct' AS stream, c.amount FROM counted c JOIN committees m ON c.committee_id = m.committee_id WHERE m.type = 'candidate'
  UNION ALL SELECT e.target_id, [m.tag], e.stance, e.amount FROM expenditures e JOIN committees m ON e.spender_id = m.committee_id)
  , x AS (SELECT k, unnest(CASE WHEN len(tags) > 0 THEN tags ELSE ['uncategorized'] END) AS tag, stream, amount FROM f)"""
THREE = ", ".join(M.format(f"CASE WHEN stream = '{s}' THEN amount END") + f" AS {s}" for s in ("direct", "support", "oppose"))


def industry_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees")
    direct = counted(spark, sf_dir).join(m.filter("type = 'candidate'").select("committee_id"), "committee_id").select(F.col("committee_id").alias("k"), tag_list().alias("tags"), F.lit("direct").alias("stream"), "amount")
    spent = model(spark, sf_dir, "expenditures").join(m.select(F.col("committee_id").alias("spender_id"), "tag"), "spender_id")
    return direct.unionByName(spent.select(F.col("target_id").alias("k"), F.array("tag").alias("tags"), F.col("stance").alias("stream"), "amount"))


@query("ag43_candidate_industries", oracle(INDUSTRY + f" SELECT k, tag, {THREE} FROM x GROUP BY 1, 2"))
def ag43(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.industries_of(industry_facts(spark, sf_dir), "k")


@query("ag44_ar1_office_industries", oracle(INDUSTRY + f" SELECT m.office, x.tag, {THREE} FROM x JOIN committees m ON x.k = m.committee_id GROUP BY 1, 2"))
def ag44(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees").select(F.col("committee_id").alias("k"), "office")
    return views.industries_of(industry_facts(spark, sf_dir).join(m, "k"), "office")


@query("ag44_stream_totals", oracle(INDUSTRY + f" SELECT stream, {M.format('amount')} AS amount, count(*) AS n FROM f GROUP BY 1"))
def ag44b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return industry_facts(spark, sf_dir).groupBy("stream").agg(total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("n"))


@query("ag45_browse_donors", oracle(COUNTED + f" SELECT parent_id, {M.format('amount')} AS amount, {M.format('CASE WHEN committee_id % 5 <> 0 THEN amount END')} AS direct, {M.format('CASE WHEN committee_id % 5 = 0 THEN amount END')} AS via_groups, count(DISTINCT committee_id) AS recipients, count(*) AS gifts, round(CASE WHEN sum(amount) <> 0 THEN CAST({M.format('CASE WHEN is_own_committee THEN amount END')} AS DOUBLE) / CAST({M.format('amount')} AS DOUBLE) ELSE 0.0 END, 4) AS self_share FROM counted GROUP BY 1"))
def ag45(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.browse_donors(counted(spark, sf_dir).withColumn("to_group", F.col("committee_id") % 5 == 0).withColumn("is_self", F.col("is_own_committee")))


@query("ag46_facets", oracle("SELECT 'type' AS facet, type AS value, count(*) AS n FROM donors GROUP BY 2 UNION ALL SELECT 'tag', tag, count(*) FROM (SELECT unnest(CASE WHEN tags = '' THEN ['uncategorized'] ELSE string_split(tags, ',') END) AS tag FROM donors) GROUP BY 2"))
def ag46(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.facets(model(spark, sf_dir, "donors").withColumn("tags", tag_list()))


@query("ag47_framed_races", oracle(f"SELECT r.race_id, r.in_frame, s.spent IS NOT NULL AS has_money, coalesce(s.spent, 0::DECIMAL(18,2)) AS spent FROM (SELECT n_nationkey AS race_id, n_nationkey % 3 = 0 AS in_frame FROM nation) r LEFT JOIN (SELECT m.race_id, {M.format('e.amount')} AS spent FROM expenditures e JOIN committees m ON e.target_id = m.committee_id GROUP BY 1) s ON r.race_id = s.race_id WHERE r.in_frame OR s.spent IS NOT NULL"))
def ag47(spark: SparkSession, sf_dir: str) -> DataFrame:
    races = raw(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("race_id"), (F.col("n_nationkey") % 3 == 0).alias("in_frame"))
    m = model(spark, sf_dir, "committees").select(F.col("committee_id").alias("target_id"), "race_id")
    return views.framed_races(races, model(spark, sf_dir, "expenditures").join(m, "target_id"))


@query("ag50_before_windows", oracle(WINDOWED + f" SELECT candidate_id, {M.format('amount')} AS amount, count(*) AS n, max(date) AS last FROM placed WHERE office_type = 'municipal' AND date < DATE '1995-09-01' GROUP BY 1"))
def ag50(spark: SparkSession, sf_dir: str) -> DataFrame:
    earliest = calendar.window_union(model(spark, sf_dir, "windows")).filter("start_date IS NOT NULL").withColumn("start_date", F.add_months("start_date", 6))
    return views.before_windows(placed(spark, sf_dir), earliest)


@query("ag51_small_gifts_in_race", oracle("SELECT race_id, person_id, CAST(sum(balance) AS DECIMAL(18,2)) AS small, count(*) AS records FROM committees WHERE type = 'candidate' GROUP BY 1, 2"))
def ag51(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model(spark, sf_dir, "committees").filter("type = 'candidate'").groupBy("race_id", "person_id").agg(total(F.col("balance")).alias("small"), F.count(F.lit(1)).alias("records"))


WORK = COUNTED + f", g AS (SELECT c.donor_id, d.name, {M.format('c.amount')} AS amount, count(*) AS gifts, string_agg(DISTINCT m.name, '; ' ORDER BY m.name) AS recipients FROM counted c JOIN donors d ON c.donor_id = d.donor_id JOIN committees m ON m.committee_id = c.committee_id WHERE d.tags IN ('', 'unclassified') GROUP BY 1, 2 HAVING sum(c.amount) >= 1000)"


@query("ag32_so2_worklist", oracle(WORK + " SELECT * FROM g"))
def ag32(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_ = model(spark, sf_dir, "donors").filter(F.col("tags").isin("", "unclassified")).select("donor_id", "name")
    m = model(spark, sf_dir, "committees").select("committee_id", F.col("name").alias("recipient"))
    return views.worklist(counted(spark, sf_dir).join(m, "committee_id"), open_, F.col("recipient"), 1000)


@query("ag33_untagged_committees", oracle(f"SELECT m.committee_id, m.name, {M.format('c.amount')} AS received FROM committees m LEFT JOIN contributions c ON c.committee_id = m.committee_id WHERE m.tag = 'civic' GROUP BY 1, 2"))
def ag33(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees").filter("tag = 'civic'").select("committee_id", "name")
    got = model(spark, sf_dir, "contributions").groupBy("committee_id").agg(total(F.col("amount")).alias("received"))
    return m.join(got, "committee_id", "left").withColumn("received", F.coalesce("received", F.lit(0)).cast("decimal(18,2)"))


LISTS = COUNTED + f", lists AS (SELECT donor_id, 'direct' AS tool, {M.format('amount')} AS amount, CAST(NULL AS VARCHAR) AS note FROM counted WHERE committee_id % 2 = 0 GROUP BY 1 UNION ALL SELECT donor_id, 'groups', {M.format('amount')}, 'g' || max(line) FROM counted WHERE committee_id % 3 = 0 GROUP BY 1)"


@query("ag34_unified_worklists", oracle(LISTS + " SELECT donor_id, max(amount) AS amount, arg_max(tool, (amount, tool)) AS tool, max(note) AS note, count(*) AS tools, string_agg(tool, ',' ORDER BY tool) AS seen_in FROM lists GROUP BY 1"))
def ag34(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = counted(spark, sf_dir)
    a = c.filter("committee_id % 2 = 0").groupBy("donor_id").agg(total(F.col("amount")).alias("amount")).select("donor_id", F.lit("direct").alias("tool"), "amount", F.lit(None).cast("string").alias("note"))
    b = c.filter("committee_id % 3 = 0").groupBy("donor_id").agg(total(F.col("amount")).alias("amount"), F.concat(F.lit("g"), F.max("line").cast("string")).alias("note")).select("donor_id", F.lit("groups").alias("tool"), "amount", "note")
    return rollups.unified_worklists(a.unionByName(b), "donor_id", "tool", "amount", ["note"])


@query("ag35_family_preview", oracle(f"SELECT d.cluster_id, count(*) AS listed, count(c.donor_id) AS present, {M.format('c.amount')} AS amount, count(c.donor_id) >= 2 AS forms, min(CASE WHEN c.donor_id IS NOT NULL THEN d.donor_id END) AS parent_id FROM donors d LEFT JOIN (SELECT donor_id, sum(amount) AS amount FROM contributions WHERE line = 2 GROUP BY 1) c ON c.donor_id = d.donor_id WHERE d.cluster_id IS NOT NULL GROUP BY 1"))
def ag35(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = model(spark, sf_dir, "contributions").filter("line = 2").groupBy("donor_id").agg(F.sum("amount").alias("amount")).withColumn("here", F.lit(True))
    d = model(spark, sf_dir, "donors").filter("cluster_id IS NOT NULL").join(sums, "donor_id", "left")
    return d.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("listed"), F.count("here").alias("present"), total(F.col("amount")).alias("amount"), (F.count("here") >= 2).alias("forms"), F.min(F.when(F.col("here"), F.col("donor_id"))).alias("parent_id"))


@query("ag36_editorial_coverage", oracle(f"SELECT count(*) AS donors, {M.format('amount')} AS amount FROM (SELECT d.donor_id, sum(c.amount) AS amount FROM donors d LEFT JOIN contributions c ON c.donor_id = d.donor_id WHERE d.donor_id NOT IN (SELECT donor_id FROM donors WHERE donor_id % 6 = 0) GROUP BY 1)"))
def ag36(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").select("donor_id")
    without = d.join(d.filter("donor_id % 6 = 0"), "donor_id", "left_anti")
    sums = model(spark, sf_dir, "contributions").groupBy("donor_id").agg(F.sum("amount").alias("amount"))
    return without.join(sums, "donor_id", "left").agg(F.count(F.lit(1)).alias("donors"), total(F.col("amount")).alias("amount"))


@query("ag54_summary", oracle("SELECT (SELECT count(*) FROM donors) AS donors, (SELECT count(DISTINCT cluster_id) FROM donors) AS clusters, (SELECT count(*) FROM contributions) AS rows"))
def ag54(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").agg(F.count(F.lit(1)).alias("donors"), F.countDistinct("cluster_id").alias("clusters"))
    return d.join(model(spark, sf_dir, "contributions").agg(F.count(F.lit(1)).alias("rows")), F.lit(True))


@query("ag58_cycles_seen", oracle(CYCLED + " SELECT m.race_id, string_agg(DISTINCT c.cycle, ',' ORDER BY c.cycle) AS cycles, count(c.cycle) > 0 AS has_finance FROM committees m LEFT JOIN cycled c ON m.committee_id = c.committee_id GROUP BY 1"))
def ag58(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees").select("committee_id", "race_id")
    return m.join(cycled(spark, sf_dir).select("committee_id", "cycle"), "committee_id", "left").groupBy("race_id").agg(F.nullif(F.array_join(F.array_sort(F.collect_set("cycle")), ","), F.lit("")).alias("cycles"), (F.count("cycle") > 0).alias("has_finance"))


@query("ag60_period_vector", oracle(COUNTED + f" SELECT parent_id, {M.format('amount')} AS amount, {M.format('CASE WHEN contribution_type = ' + repr('Loan Received') + ' AND is_own_committee THEN amount END')} AS own_loans FROM counted WHERE cycle = '1999' GROUP BY 1"))
def ag60(spark: SparkSession, sf_dir: str) -> DataFrame:
    own_loan = money.is_loan(F.col("contribution_type")) & F.col("is_own_committee")
    return counted(spark, sf_dir).filter("cycle = '1999'").groupBy("parent_id").agg(total(F.col("amount")).alias("amount"), total(F.when(own_loan, F.col("amount"))).alias("own_loans"))


@query("flt11_donor_filter", oracle("SELECT donor_id FROM donors WHERE type = 'PAC' AND list_contains(string_split(tags, ','), 'machinery') AND (contains(lower(name), '7') OR contains(lower(coalesce(cluster_id, '')), '7'))"))
def flt11(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").withColumn("tags", tag_list()).withColumn("names", F.array_compact(F.array("name", "cluster_id")))
    return views.donor_filter(d, "PAC", "machinery", "7").select("donor_id")


@query("flt12_so3_search", oracle("SELECT donor_id, pinned FROM (SELECT donor_id, balance, CAST(donor_id AS VARCHAR) = '12' AS pinned FROM donors WHERE CAST(donor_id AS VARCHAR) = '12' OR contains(lower(name || ' ' || type || ' ' || tags), '12')) ORDER BY pinned DESC, balance DESC, donor_id LIMIT 100"))
def flt12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.pinned_search(model(spark, sf_dir, "donors"), "donor_id", ["name", "type", "tags"], "balance", "12").select("donor_id", "pinned")


@query("flt13_office_scope", oracle("SELECT source_filing, line, committee_id FROM contributions WHERE committee_id IN (SELECT committee_id FROM committees WHERE office_type = 'school_board')"))
def flt13(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = model(spark, sf_dir, "committees").filter("office_type = 'school_board'").select("committee_id")
    return model(spark, sf_dir, "contributions").join(scope, "committee_id", "left_semi").select("source_filing", "line", "committee_id")


@query("wn7_group_scale", oracle("SELECT committee_id, race_id, max(balance) OVER (PARTITION BY race_id) AS scale, round(CASE WHEN max(balance) OVER (PARTITION BY race_id) <> 0 THEN CAST(balance AS DOUBLE) / CAST(max(balance) OVER (PARTITION BY race_id) AS DOUBLE) ELSE 0.0 END, 6) AS share FROM committees"))
def wn7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.group_scale(model(spark, sf_dir, "committees").select("committee_id", "race_id", "balance"), "race_id", "balance").drop("balance")


@query("wn8_page_cap", oracle(COUNTED + f", g AS (SELECT parent_id, {M.format('amount')} AS amount FROM counted GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY amount DESC, parent_id) AS rank FROM g) SELECT * FROM r WHERE rank <= greatest((SELECT count(*) FROM g WHERE amount >= 1500000), 25)"))
def wn8(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = counted(spark, sf_dir).groupBy("parent_id").agg(total(F.col("amount")).alias("amount"))
    return views.page_cap(g, "amount", "parent_id", 1500000, 25)


@query("wn9_top_funders", oracle(COUNTED + f" SELECT committee_id, parent_id, amount, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY committee_id ORDER BY amount DESC, parent_id) AS INT) AS rank FROM (SELECT committee_id, parent_id, {M.format('amount')} AS amount FROM counted GROUP BY 1, 2)) WHERE rank <= 3"))
def wn9(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = counted(spark, sf_dir).groupBy("committee_id", "parent_id").agg(total(F.col("amount")).alias("amount"))
    return rollups.top_per_key(g, ["committee_id"], [F.col("amount").desc(), F.col("parent_id")], 3)


@query("wn2_proposed_canonical", oracle("SELECT cluster_id, arg_max(donor_id, (balance, -donor_id)) AS canonical_id FROM donors WHERE cluster_id IS NOT NULL GROUP BY 1"))
def wn2(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model(spark, sf_dir, "donors").filter("cluster_id IS NOT NULL")
    return entities.first_per(d, ["cluster_id"], [F.col("balance").desc(), F.col("donor_id")]).select("cluster_id", F.col("donor_id").alias("canonical_id"))


@query("wn3_ordinal_ids", oracle("SELECT 'c-' || committee_id || '-' || CAST(row_number() OVER (PARTITION BY committee_id ORDER BY source_filing, line, amount, donor_id, date) AS VARCHAR) AS id, amount FROM contributions"))
def wn3(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("committee_id").orderBy("source_filing", "line", "amount", "donor_id", F.col("date").asc_nulls_last()))
    return model(spark, sf_dir, "contributions").select(F.concat_ws("-", F.lit("c"), F.col("committee_id").cast("string"), n.cast("string")).alias("id"), "amount")


@query("wn5_prior_candidacy", oracle("SELECT person_id, first_value(candidate_id) OVER w AS first, last_value(candidate_id) OVER w AS current, candidate_id FROM committees WINDOW w AS (PARTITION BY person_id ORDER BY balance, candidate_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"))
def wn5(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("person_id").orderBy("balance", "candidate_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return model(spark, sf_dir, "committees").select("person_id", F.first("candidate_id").over(w).alias("first"), F.last("candidate_id").over(w).alias("current"), "candidate_id")


@query("wn10_next_ids", oracle("SELECT committee_id, 'f-' || CAST((SELECT max(donor_id) FROM donors) + row_number() OVER (ORDER BY committee_id) AS VARCHAR) AS id FROM committees"))
def wn10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from civicspark.operators import changes

    taken = model(spark, sf_dir, "donors").select(F.concat(F.lit("f-"), F.col("donor_id").cast("string")).alias("id"))
    return changes.mint_ids(model(spark, sf_dir, "committees").select("committee_id"), taken, "id", "f-", "committee_id")


@query("so5_items_in_donor", oracle("SELECT donor_id, row_number() OVER (PARTITION BY donor_id ORDER BY date NULLS FIRST, committee_id, amount DESC) AS place, date, committee_id, amount FROM contributions"))
def so5(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("donor_id").orderBy(F.col("date").asc_nulls_first(), "committee_id", F.col("amount").desc())
    return model(spark, sf_dir, "contributions").select("donor_id", F.row_number().over(order).cast("long").alias("place"), "date", "committee_id", "amount")


@query("so4_neutral_order", oracle("SELECT committee_id, row_number() OVER (ORDER BY lower(list_extract(string_split(name, '#'), -1)), name) AS place FROM committees"))
def so4(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = model(spark, sf_dir, "committees").select("committee_id", F.replace("name", F.lit("#"), F.lit(" ")).alias("name"))
    keyed = m.withColumn("surname", text.surname_key(F.col("name")))
    return numbering.numbered(keyed, "place", ["surname", "name", "committee_id"]).select("committee_id", "place")


@query("ar2_4_arrays", oracle("SELECT cluster_id, array_to_string(list_concat([mn], list_filter(l, lambda x: x <> mn)), ',') AS members FROM (SELECT cluster_id, min(donor_id) AS mn, list(donor_id ORDER BY donor_id DESC) AS l FROM donors WHERE cluster_id IS NOT NULL GROUP BY 1)"))
def ar2(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = model(spark, sf_dir, "donors").filter("cluster_id IS NOT NULL").groupBy("cluster_id").agg(F.min("donor_id").alias("p"), F.sort_array(F.collect_list("donor_id"), asc=False).alias("m"))
    return g.select("cluster_id", F.array_join(F.transform(entities.parent_first(F.col("m"), F.col("p")), lambda x: x.cast("string")), ",").alias("members"))


@query("ar5_flag_sums", oracle(f"SELECT flag, count(*) AS n, {M.format('balance')} AS amount FROM (SELECT balance, unnest(list_filter([CASE WHEN donor_id % 2 = 0 THEN 'even' END, CASE WHEN donor_id % 3 = 0 THEN 'third' END], lambda x: x IS NOT NULL)) AS flag FROM donors) GROUP BY 1"))
def ar5(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.array_compact(F.array(F.when(F.col("donor_id") % 2 == 0, F.struct(F.lit("even").alias("type"))), F.when(F.col("donor_id") % 3 == 0, F.struct(F.lit("third").alias("type")))))
    d = model(spark, sf_dir, "donors").withColumn("flags", flags)
    return d.select("balance", F.explode("flags.type").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"), total(F.col("balance")).alias("amount"))
