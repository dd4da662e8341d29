"""Queries of the scalar functions (FN) and of text sources and sinks that are projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions import classify, money, text

from .model import given, in_sql, model, oracle, raw, rules_sql, values_sql
from .registry import query

#: Names as filed: last and first name from a part's two words, some with suffixes, honorifics and organisations.
NAMES_SQL = """SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1)
  WHEN 1 THEN split_part(p_name, ' ', 1) || ' B. ' || split_part(p_name, ' ', 2) || ' Jr.' WHEN 2 THEN 'Friends of ' || p_name || ' PAC'
  WHEN 3 THEN 'Dr. Bob ' || p_name WHEN 4 THEN 'Citizens for ' || p_brand || ' Union, Inc.' ELSE p_type || ' District ' || p_size || 'A Ward ' || p_size END AS name,
  p_brand AS brand, p_type AS kind, p_size AS n FROM part"""
TOKENS_SQL = "list_filter(string_split(trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')), ' '), lambda t: length(t) > 1 AND t NOT IN {drop})"
WORDS_SQL = "list_filter(string_split(trim(regexp_replace(regexp_replace(lower({c}), '[.,/&''\"()-]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda t: length(t) > 1 AND t NOT IN {drop})"


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, NAMES_SQL)


def named(body: str) -> str:
    return f"WITH names AS ({NAMES_SQL}) {body}"


@query("fn1_slug", "SELECT doc_id, substring(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80) AS slug, length(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS whole FROM documents")
def fn1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "documents").select("doc_id", text.slug(F.col("text")).alias("slug"), F.length(text.kebab(F.col("text"))).cast("long").alias("whole"))


@query("fn2_norm", "SELECT conv_id, turn, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS norm FROM conversations")
def fn2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "conversations").select("conv_id", "turn", text.norm(F.col("text")).alias("norm"))


@query("fn3_fold", "SELECT text, regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g') AS folded FROM (SELECT DISTINCT text FROM documents)")
def fn3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "documents").select("text").distinct().select("text", text.fold(F.col("text")).alias("folded"))


@query("fn4_name_tokens", named(f"SELECT id, array_to_string({TOKENS_SQL.format(drop=in_sql(text.SUFFIXES))}, ' ') AS tokens FROM names"))
def fn4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("id", F.array_join(text.name_tokens(F.col("name")), " ").alias("tokens"))


_LETTERS = "list_filter(string_split(regexp_replace(lower({c}), '[^a-z]+', ' ', 'g'), ' '), lambda t: length(t) > 1 AND t NOT IN " + in_sql(text.NAME_DROP) + ")"


@query("fn5_split_name", named(f"""SELECT id, array_to_string(list_sort(list_distinct(CASE WHEN name LIKE '%,%' THEN {_LETTERS.format(c="split_part(name, ',', 1)")} ELSE list_slice({_LETTERS.format(c='name')}, -1, -1) END)), ' ') AS family,
  array_to_string(list_sort(list_distinct(CASE WHEN name LIKE '%,%' THEN {_LETTERS.format(c="regexp_replace(name, '^[^,]*,', '')")} ELSE list_slice({_LETTERS.format(c='name')}, 1, -2) END)), ' ') AS given FROM names"""))
def fn5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).withColumn("s", text.split_name(F.col("name"))).select("id", F.array_join("s.family", " ").alias("family"), F.array_join("s.given", " ").alias("given"))


_CANON = {s: g[0] for g in text.GIVEN_NAMES for s in g}


@query("fn6_canonical_given", named(f"SELECT id, array_to_string(list_sort(list_distinct(list_transform({TOKENS_SQL.format(drop=in_sql(text.NAME_DROP))}, lambda t: {values_sql('t', _CANON, 't')}))), ' ') AS given FROM names"))
def fn6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("id", F.array_join(text.canonical_given(text.name_tokens(F.col("name"), text.NAME_DROP)), " ").alias("given"))


@query("fn7_payer_name", "SELECT p_partkey AS id, concat_ws(', ', nullif(trim(split_part(p_name, ' ', 2)), ''), nullif(trim(CASE WHEN p_size % 2 = 0 THEN split_part(p_name, ' ', 1) ELSE ' ' END), '')) AS payer FROM part")
def fn7(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.when(F.col("p_size") % 2 == 0, F.split_part("p_name", F.lit(" "), F.lit(1))).otherwise(" ")
    return raw(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), text.payer_name(F.split_part("p_name", F.lit(" "), F.lit(2)), first).alias("payer"))


@query("fn8_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed, CAST(extract(month FROM o_orderdate) AS VARCHAR) || '/' || CAST(extract(day FROM o_orderdate) AS VARCHAR) || '/' || CAST(extract(year FROM o_orderdate) AS VARCHAR) AS short, CAST(NULL AS DATE) AS bad FROM orders")
def fn8(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = raw(spark, sf_dir, "orders").select("o_orderkey", money.short_date(F.col("o_orderdate")).alias("short"), "o_orderpriority")
    return o.select("o_orderkey", money.parse_date(F.col("short")).alias("parsed"), "short", money.parse_date(F.col("o_orderpriority")).alias("bad"))


@query("fn9_zip", "SELECT page_id, nullif(substring(regexp_replace(coalesce(url, ''), '[^0-9]', '', 'g'), 1, 5), '') AS zip FROM pages")
def fn9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "pages").select("page_id", text.zip5(F.col("url")).alias("zip"))


@query("fn10_truthy", f"SELECT event_id, lower(trim(x)) IN {in_sql(text.TRUTHY)} AS truthy FROM (SELECT event_id, CASE event_type WHEN 'view' THEN ' TRUE ' WHEN 'click' THEN 'no' WHEN 'error' THEN '1' WHEN 'signup' THEN 'Y' ELSE event_type END AS x FROM events)")
def fn10(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = text.lookup({"view": " TRUE ", "click": "no", "error": "1", "signup": "Y"}, F.col("event_type"), F.col("event_type"))
    return raw(spark, sf_dir, "events").select("event_id", text.truthy(x).alias("truthy"))


@query("fn11_ward_district", named("""SELECT id, CAST(coalesce(nullif(regexp_extract(name, '(?i)([0-9]{1,2})(?:st|nd|rd|th)?\\s*ward', 1), ''), nullif(regexp_extract(name, '(?i)ward\\s*([0-9]{1,2})', 1), '')) AS INT) AS ward,
  coalesce(nullif(regexp_extract(name, '(?i)district\\s*([0-9]{1,2})\\s*([ab])?', 1) || lower(regexp_extract(name, '(?i)district\\s*([0-9]{1,2})\\s*([ab])?', 2)), ''), nullif(regexp_extract(name, '(?i)\\b([0-9]{1,2})([ab])\\b', 1) || lower(regexp_extract(name, '(?i)\\b([0-9]{1,2})([ab])\\b', 2)), '')) AS district FROM names"""))
def fn11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("id", text.ward_number(F.col("name")).alias("ward"), text.district_token(F.col("name")).alias("district"))


@query("fn12_individual", named("SELECT id, name LIKE '%,%' AND NOT (" + " OR ".join(f"contains(lower(name), '{t}')" for t in text.ORGANISATION_TOKENS) + ") AS individual FROM names"))
def fn12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("id", text.is_individual_name(F.col("name")).alias("individual"))


@query("fn13_industry", named(f"SELECT id, {rules_sql('name', classify.INDUSTRY_RULES, repr('unclassified'))} AS industry FROM names WHERE id % 6 <> 0 UNION ALL SELECT id, 'individual' FROM names WHERE id % 6 = 0"))
def fn13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("id", classify.industry(F.col("name"), text.is_individual_name(F.col("name"))).alias("industry"))


@query("fn14_suggestion", named(f"""SELECT id, coalesce(e, o, n, CASE WHEN name LIKE '%,%' THEN 'individual' END) AS industry,
  CASE WHEN e IS NOT NULL THEN 'employer: "' || substring(lower(kind), 1, 50) || '"' WHEN o IS NOT NULL THEN 'occupation: "' || substring(lower(brand), 1, 40) || '"' WHEN n IS NOT NULL THEN 'name pattern' WHEN name LIKE '%,%' THEN 'name format (Last, First)' END AS reason
  FROM (SELECT *, {rules_sql("kind", classify.EMPLOYER_RULES, 'NULL')} AS e, {rules_sql("brand", classify.OCCUPATION_RULES, 'NULL')} AS o, CASE WHEN name NOT LIKE '%,%' THEN {rules_sql('name', classify.EMPLOYER_RULES, 'NULL')} END AS n
    FROM (SELECT id, name, CASE WHEN id % 7 = 0 THEN 'First Bank of ' || kind ELSE kind END AS kind, CASE WHEN id % 5 = 0 THEN 'Software ' || brand ELSE brand END AS brand FROM names))"""))
def fn14(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = names(spark, sf_dir).withColumn("kind", F.when(F.col("id") % 7 == 0, F.concat(F.lit("First Bank of "), "kind")).otherwise(F.col("kind"))).withColumn("brand", F.when(F.col("id") % 5 == 0, F.concat(F.lit("Software "), "brand")).otherwise(F.col("brand")))
    s = classify.suggestion(F.col("kind"), F.col("brand"), F.col("name"), classify.EMPLOYER_RULES, classify.OCCUPATION_RULES)
    return n.withColumn("s", s).select("id", "s.industry", "s.reason")


@query("fn15_17_types", oracle("""SELECT c.contribution_type, d.type, c.is_own_committee, CASE WHEN c.is_own_committee THEN 'Self' WHEN d.type = 'Individual' THEN 'Individual' WHEN c.contribution_type = 'Transfer In' THEN 'PAC' ELSE 'Other' END AS shown,
  c.contribution_type = 'Loan Received' AS loan, c.contribution_type = 'In-kind Contribution' AS in_kind, count(*) AS n FROM contributions c JOIN donors d ON c.donor_id = d.donor_id GROUP BY ALL"""))
def fn15(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = model(spark, sf_dir, "contributions").join(model(spark, sf_dir, "donors"), "donor_id")
    kind = F.col("contribution_type")
    return joined.groupBy("contribution_type", "type", "is_own_committee", money.donor_type(kind, F.col("is_own_committee"), F.col("type") == "Individual").alias("shown"), money.is_loan(kind).alias("loan"), money.is_in_kind(kind).alias("in_kind")).agg(F.count(F.lit(1)).alias("n"))


_PAD = "' ' || trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) || ' '"


@query("fn16_self_text", f"""SELECT a.p_partkey AS id, length(split_part(a.p_name, ' ', 2)) >= 3 AND contains({_PAD.format("'Friends of ' || b.p_name")}, {_PAD.format("split_part(a.p_name, ' ', 2)")}) AS self FROM part a JOIN part b ON b.p_partkey = a.p_partkey - a.p_partkey % 10""")
def fn16(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = raw(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name")
    c = p.select(F.col("id").alias("of"), F.concat(F.lit("Friends of "), "p_name").alias("committee"))
    return p.join(c, F.col("of") == F.col("id") - F.col("id") % 10).select("id", text.names_the_committee(F.split_part("p_name", F.lit(" "), F.lit(2)), F.col("committee")).alias("self"))


@query("fn18_filing_codes", f"SELECT l_linenumber || l_returnflag AS code, {values_sql('l_linenumber || l_returnflag', money.FILING_CODES)} AS name, count(*) AS n FROM lineitem WHERE {values_sql('l_linenumber || l_returnflag', money.FILING_CODES)} IS NOT NULL GROUP BY ALL")
def fn18(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = raw(spark, sf_dir, "lineitem").select(F.concat(F.col("l_linenumber").cast("string"), "l_returnflag").alias("code"))
    return coded.withColumn("name", money.filing_type(F.col("code"))).filter("name IS NOT NULL").groupBy("code", "name").agg(F.count(F.lit(1)).alias("n"))


@query("fn19_dues", "SELECT id, regexp_matches(x, '(?i)\\b(dues|membership|member\\s+contributions?)\\b') AS dues FROM (SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN p_name || ' Dues' WHEN p_size % 3 = 1 THEN 'Member  Contribution ' || p_name ELSE p_name || ' duesday' END AS x FROM part)")
def fn19(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.when(F.col("p_size") % 3 == 0, F.concat("p_name", F.lit(" Dues"))).when(F.col("p_size") % 3 == 1, F.concat(F.lit("Member  Contribution "), "p_name")).otherwise(F.concat("p_name", F.lit(" duesday")))
    return raw(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), money.is_dues(x).alias("dues"))


@query("fn20_cents", "SELECT o_orderkey, CAST(round(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '5' AS DECIMAL(20,6)), 2) AS DECIMAL(18,2)) AS amount, CAST(NULL AS DECIMAL(18,2)) AS bad FROM orders")
def fn20(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelled = F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("5"))
    return raw(spark, sf_dir, "orders").select("o_orderkey", money.cents(spelled).alias("amount"), money.cents(F.col("o_orderpriority")).alias("bad"))


@query("fn21_bill_type", f"SELECT o_orderkey, o_custkey, coalesce(CASE WHEN o_custkey % 5 = 0 THEN 'appointment' END, {values_sql("CASE o_orderstatus WHEN 'P' THEN 'SR' ELSE o_orderstatus END", money.BILL_PREFIXES, repr('other'))}) AS t FROM orders")
def fn21(spark: SparkSession, sf_dir: str) -> DataFrame:
    identifier = F.concat(F.when(F.col("o_orderstatus") == "P", "sr").otherwise(F.col("o_orderstatus")), F.col("o_orderkey").cast("string"))
    return raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", money.bill_type(identifier, F.when(F.col("o_custkey") % 5 == 0, "appointment").otherwise("")).alias("t"))


@query("fn22_vote_options", oracle(f"SELECT option, {values_sql('option', money.RECORD)} AS record, {values_sql('option', money.POSITION)} AS position, count(*) AS n FROM person_votes GROUP BY ALL"))
def fn22(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model(spark, sf_dir, "person_votes").groupBy("option", money.vote_record(F.col("option")).alias("record"), money.vote_position(F.col("option")).alias("position")).agg(F.count(F.lit(1)).alias("n"))


_SLUG_WORDS = r"""list_filter(list_transform(regexp_split_to_array(regexp_replace(strip_accents(coalesce(name, '')), '["“”‘’''].*?["“”‘’'']', ' ', 'g'), '\s+'), lambda x: lower(regexp_replace(x, '[^\p{L}\p{N}_-]', '', 'g'))),
  lambda x: x <> '' AND x NOT IN """ + in_sql(text.HONORIFICS) + " AND (length(x) > 1 OR x IN " + in_sql([*text.SUFFIXES, "v"]) + "))"


@query("fn23_person_slug", named(f"SELECT name, trim(regexp_replace(array_to_string({_SLUG_WORDS}, '-'), '-{{2,}}', '-', 'g'), '-') AS slug FROM (SELECT DISTINCT name FROM names)"))
def fn23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir).select("name").distinct().select("name", text.person_slug(F.col("name")).alias("slug"))


_CORE = WORDS_SQL.format(c="name", drop=in_sql(text.ORG_STOP))
_ACRO = WORDS_SQL.format(c="name", drop=in_sql(text.ACRONYM_STOP))


@query("fn24_org_names", named(f"SELECT id, array_to_string({_CORE}, ' ') AS core, array_to_string(list_transform({_ACRO}, lambda t: substring(t, 1, 1)), '') AS acronym, array_to_string({_ACRO}, '') AS compact, list_extract(string_split(trim(regexp_replace(regexp_replace(lower(name), '[.,/&''\"()-]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), -1) AS surname FROM names"))
def fn24(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("name")
    return names(spark, sf_dir).select("id", F.array_join(text.core_tokens(n), " ").alias("core"), text.acronym(n).alias("acronym"), text.compact(n).alias("compact"), text.surname(n).alias("surname"))


@query("fn25_similarity", named(f"""SELECT a.id, b.id AS other, CASE WHEN len(a.t) = 0 OR len(b.t) = 0 THEN 0.0 ELSE CAST(len(list_intersect(a.t, b.t)) AS DOUBLE) / len(list_distinct(list_concat(a.t, b.t))) END AS jaccard, len(list_filter(list_distinct(a.t), lambda x: NOT list_contains(b.t, x))) = 0 AS subset
  FROM (SELECT id, list_distinct({_CORE}) AS t FROM names) a JOIN (SELECT id, list_distinct({_CORE}) AS t FROM names) b ON b.id = a.id + 12"""))
def fn25(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = names(spark, sf_dir).select("id", text.core_tokens(F.col("name")).alias("t"))
    return n.join(n.select(F.col("id").alias("other"), F.col("t").alias("u")), F.col("other") == F.col("id") + 12).select("id", "other", text.jaccard(F.col("t"), F.col("u")).alias("jaccard"), text.is_subset(F.col("t"), F.col("u")).alias("subset"))


@query("fn26_office_kind", "SELECT id, CASE WHEN regexp_matches(x, '(?i)SCHOOL|EDUCATION|\\bBOE\\b|\\bCPS\\b') THEN 'school_board' WHEN regexp_matches(x, '(?i)ALDER|\\bWARDS?\\b|CITY COUNCIL|\\bMAYOR') THEN 'municipal' END AS kind FROM (SELECT p_partkey AS id, CASE p_size % 5 WHEN 0 THEN 'School Board' WHEN 1 THEN 'Alderperson' WHEN 2 THEN 'Howard ' || p_name WHEN 3 THEN 'Mayor of ' || p_brand ELSE p_name END AS x FROM part)")
def fn26(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size") % 5
    x = F.when(k == 0, "School Board").when(k == 1, "Alderperson").when(k == 2, F.concat(F.lit("Howard "), "p_name")).when(k == 3, F.concat(F.lit("Mayor of "), "p_brand")).otherwise(F.col("p_name"))
    return raw(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), text.office_kind(x).alias("kind"))


@query("fn28_race_addresses", oracle(f"""SELECT committee_id, CASE WHEN committee_id % 3 = 0 THEN '1999-' ELSE '' END || CASE WHEN district IS NOT NULL THEN regexp_replace(lower(district), '[^a-z0-9]+', '-', 'g') WHEN ward IS NOT NULL THEN 'ward-' || ward ELSE regexp_replace({values_sql('office', text.OFFICE_SLUGS, 'office')}, '[^a-z0-9]+', '-', 'g') END AS slug,
  CASE WHEN district IS NOT NULL THEN regexp_replace(district, '(?i)^District\\s+', '') WHEN ward IS NOT NULL THEN 'Ward ' || ward ELSE {values_sql('office', text.OFFICE_CODES, 'name')} END AS code, {values_sql('office', text.OFFICE_LABELS, 'office')} AS label
  FROM (SELECT *, CASE WHEN office = 'school_board_member' THEN 'District ' || race_id || 'A' END AS district FROM committees)"""))
def fn28(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "committees").withColumn("district", F.when(F.col("office") == "school_board_member", F.concat(F.lit("District "), F.col("race_id").cast("string"), F.lit("A"))))
    election = F.when(F.col("committee_id") % 3 == 0, "1999-board").otherwise("2027-municipal")
    o, d, w = F.col("office"), F.col("district"), F.col("ward")
    return c.select("committee_id", text.race_slug(o, d, w, election).alias("slug"), text.race_code(o, d, w, F.col("name")).alias("code"), text.office_label(o).alias("label"))


@query("fn29_reference_kind", "SELECT event_id, CASE event_type WHEN 'view' THEN 'person' WHEN 'click' THEN 'none' WHEN 'error' THEN 'vacancy' ELSE 'candidate' END AS kind FROM events")
def fn29(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = text.lookup({"view": "person:1", "click": " ", "error": "Vacancy"}, F.col("event_type"), F.col("event_type"))
    return raw(spark, sf_dir, "events").select("event_id", text.reference_kind(x).alias("kind"))


@query("fn30_31_industry_class", oracle("""SELECT donor_id, CASE WHEN len(p) = 0 THEN 'unclassified' WHEN len(list_filter(p, lambda t: t <> 'household')) = 0 THEN 'individual_only' ELSE 'substantive' END AS class, len(p) = 0 AS open
  FROM (SELECT donor_id, list_filter(string_split(tags, ','), lambda t: t <> 'unclassified' AND t <> '') AS p FROM donors)"""))
def fn30(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.transform(F.filter(F.split("tags", ","), lambda t: t != ""), lambda t: F.when(t == "household", "individual").otherwise(t))
    return model(spark, sf_dir, "donors").select("donor_id", classify.industry_class(tags).alias("class"), classify.is_unclassified(tags).alias("open"))


@query("fn32_sort_keys", named(f"""SELECT id, lower(list_extract(regexp_split_to_array(trim(regexp_replace(name, '(?i),?\\s*(jr|sr|ii|iii|iv)\\.?$', '')), '\\s+'), -1)) AS surname,
  CASE WHEN id % 7 = 0 THEN -4 WHEN id % 7 = 1 THEN -1 ELSE n END AS race, CASE WHEN id % 5 = 0 THEN 2010.5 WHEN id % 5 = 1 THEN 1000000000.0 ELSE CAST(2000 + n AS DOUBLE) END AS cycle FROM names"""))
def fn32(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("n").cast("string")
    race = F.when(F.col("id") % 7 == 0, "mayor").when(F.col("id") % 7 == 1, "sb-president").otherwise(F.concat(F.lit("ward-"), number))
    cycle = F.when(F.col("id") % 5 == 0, "pre-2011").when(F.col("id") % 5 == 1, "undated").otherwise((F.col("n") + 2000).cast("string"))
    return names(spark, sf_dir).select("id", text.surname_key(F.col("name")).alias("surname"), text.race_order(race, F.lit("x")).cast("int").alias("race"), text.cycle_key(cycle).alias("cycle"))


@query("fn32_row_year", oracle("SELECT coalesce(CAST(extract(year FROM date) AS INT), 1900 + line) AS y, count(*) AS n FROM contributions GROUP BY 1"))
def fn32b(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "contributions")
    return c.groupBy(text.row_year(F.col("date"), F.concat(F.lit("c"), (F.col("line") + 1900).cast("string"))).alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query("fn33_recipient_label", oracle("SELECT committee_id, CASE WHEN ward IS NOT NULL AND committee_id % 2 = 1 AND committee_id % 3 = 0 THEN 'Ward ' || ward || ' — ' || name WHEN ward IS NOT NULL THEN 'Ward ' || ward ELSE name END AS label FROM committees"))
def fn33(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = model(spark, sf_dir, "committees")
    return c.select("committee_id", text.recipient_label(F.col("ward"), F.when((F.col("committee_id") % 2 == 1) & (F.col("committee_id") % 3 == 0), F.col("name")), F.col("name")).alias("label"))


@query("fn34_tally_text", oracle("SELECT vote_id, string_agg(option || ' ' || n, ', ' ORDER BY option) AS tally FROM (SELECT vote_id, option, count(*) AS n FROM person_votes GROUP BY ALL) GROUP BY vote_id"))
def fn34(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = model(spark, sf_dir, "person_votes").groupBy("vote_id", "option").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("vote_id").agg(text.tally_text(F.map_from_entries(F.collect_list(F.struct("option", "n")))).alias("tally"))


@query("fn35_claimed_election", named("""SELECT id, CASE id % 4 WHEN 0 THEN '2024-school-board' WHEN 1 THEN '2026-school-board' WHEN 2 THEN '2027-municipal' END AS of_race, CASE id % 5 WHEN 0 THEN '2027-municipal' WHEN 1 THEN '2026-school-board' WHEN 2 THEN '2024-school-board' WHEN 3 THEN '2027-municipal' END AS of_candidate FROM names"""))
def fn35(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n").cast("string")
    race = F.element_at(F.array(F.concat(F.lit("sb-2024-d"), n), F.concat(F.lit("sb-d"), n), F.concat(F.lit("ward-"), n), F.lit("other")), (F.col("id") % 4 + 1).cast("int"))
    cand = F.element_at(F.array(F.concat(F.lit("inc-ward-"), n), F.concat(F.lit("ann-sb-d"), n), F.concat(F.lit("bo-sb-2024-d"), n), F.concat(F.lit("cy-ward-"), n), F.lit("x")), (F.col("id") % 5 + 1).cast("int"))
    return names(spark, sf_dir).select("id", text.election_of_race(race).alias("of_race"), text.election_of_candidate(cand).alias("of_candidate"))


TITLE_SQL = "list_distinct(list_filter(string_split(regexp_replace(lower(text), '[^a-z]+', ' ', 'g'), ' '), lambda t: length(t) >= 5 AND t NOT IN " + in_sql(text.TITLE_STOP) + "))"


@query("fn36_title_keywords", f"SELECT item_id, array_to_string(list_transform(list_slice(list_sort(list_transform({TITLE_SQL}, lambda t: struct_pack(n := -length(t), t := t))), 1, 3), lambda e: e.t), ' ') AS keywords FROM benchmark")
def fn36(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "benchmark").select("item_id", F.array_join(text.title_keywords(F.col("text")), " ").alias("keywords"))


@query("fn36_title_pairs", f"""WITH w AS (SELECT p_partkey AS id, string_split(trim(regexp_replace(lower(p_name || ' of the ' || p_type), '[^a-z]+', ' ', 'g')), ' ') AS w FROM part)
  SELECT DISTINCT id, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT id, w, unnest(generate_series(1, len(w) - 1)) AS i FROM w) WHERE length(w[i] || ' ' || w[i + 1]) >= 7 AND NOT (w[i] IN {in_sql(text.TITLE_STOP)} AND w[i + 1] IN {in_sql(text.TITLE_STOP)})""")
def fn36b(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat("p_name", F.lit(" of the "), "p_type")
    return raw(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.explode(text.title_pairs(title)).alias("pair"))


@query("fn37_vocabulary", oracle("""SELECT tag, coalesce(v.label, tag) AS label, v.label IS NULL AS unlabelled, count(*) AS n FROM (SELECT unnest(string_split(tags, ',')) AS tag FROM donors) t LEFT JOIN (SELECT lower(r_name) AS k, r_name AS label FROM region) v ON v.k = tag WHERE tag <> '' GROUP BY ALL"""))
def fn37(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = model(spark, sf_dir, "donors").select(F.explode(F.split("tags", ",")).alias("tag")).filter("tag <> ''")
    vocabulary = raw(spark, sf_dir, "region").select(F.lower("r_name").alias("tag"), F.col("r_name").alias("known"))
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).join(vocabulary, "tag", "left").select("tag", F.coalesce("known", "tag").alias("label"), F.col("known").isNull().alias("unlabelled"), "n")


@query("fn38_committee_url", oracle("SELECT committee_id, CASE WHEN committee_id % 3 = 0 THEN 'https://own.example/' || committee_id WHEN committee_id % 3 = 1 THEN 'https://filings.example/?id=' || committee_id END AS url FROM committees"))
def fn38(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("committee_id")
    stored = F.when(k % 3 == 0, F.concat(F.lit("https://own.example/"), k.cast("string"))).otherwise(" ")
    return model(spark, sf_dir, "committees").select("committee_id", text.committee_url(stored, F.when(k % 3 != 2, k), "https://filings.example/?id=").alias("url"))


@query("snk7_tsv_safe", "SELECT doc_id, substring(trim(regexp_replace(text, '[\\t\\r\\n]+', ' ', 'g')), 1, 300) AS line FROM documents")
def snk7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "documents").select("doc_id", text.tsv_safe(F.col("text")).alias("line"))
