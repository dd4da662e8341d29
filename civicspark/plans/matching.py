"""Queries of matching (JN-7 to JN-12, JN-33 to JN-35, FN-27, AG-24 to AG-26, AG-61)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.functions import text
from civicspark.functions.money import total
from civicspark.operators import matching

from .model import given, in_sql, model, oracle, raw
from .money import M
from .registry import query
from .scalars import TITLE_SQL, WORDS_SQL

#: Targets as filed, one for each distinct name, office and window, and the registry of candidates. Names are
#: filed as they are, with an accent, with a name between, by the surname alone, or two at once.
TARGETS = """SELECT DISTINCT p_name || '|' || p_brand || '|' || CAST(p_size AS VARCHAR(9)) AS target_id,
  CASE p_size % 7 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, 'e', 'é') WHEN 2 THEN p_name || ' x' WHEN 3 THEN replace(p_name, ' ', ' quinn ')
    WHEN 4 THEN 'q ' || split_part(p_name, ' ', 2) WHEN 5 THEN replace(p_name, ' ', ' gear and ') ELSE p_name END AS name,
  CASE p_brand WHEN 'Brand#1' THEN 1 WHEN 'Brand#2' THEN 2 WHEN 'Brand#3' THEN 3 END AS ward, CASE p_brand WHEN 'Brand#4' THEN 'a' END AS district,
  CASE p_size % 3 WHEN 0 THEN 'w1' WHEN 1 THEN 'w2' ELSE '' END AS window, p_size % 4 = 0 AS mayor,
  CASE WHEN p_brand = 'Brand#5' THEN p_name || '/alias' END AS alias, CASE WHEN p_brand = 'Brand#6' THEN p_size END AS filed_id FROM part"""
REGISTRY = """SELECT p_partkey AS candidate_id, p_name AS name, CAST(p_size % 4 AS INT) AS ward, CASE WHEN p_size % 3 = 0 THEN 'a' END AS district, p_partkey AS ord,
  CASE p_brand WHEN 'Brand#1' THEN 'w1' WHEN 'Brand#2' THEN 'w2' WHEN 'Brand#3' THEN 'w1' END AS window, p_brand = 'Brand#7' AS mayor,
  CASE WHEN p_size = 1 THEN p_name || '/alias' END AS alias, CASE WHEN p_brand = 'Brand#8' THEN p_size END AS filed_id FROM part"""
_NORM = "trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


def _views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = raw(spark, sf_dir, "part")
    return tuple(spark.sql(q.replace("VARCHAR(9)", "STRING").replace("FROM part", "FROM {part}"), part=part) for q in (TARGETS, REGISTRY))


def _rung_sql(i: int, name: str, kind: str, on: str) -> str:
    if kind == "resolve":
        return f"""SELECT target_id, {i} AS rung, CASE WHEN n = 1 OR nw = 1 OR nd = 1 THEN '{name}' ELSE 'name_fallback' END AS method, CASE WHEN n = 1 THEN first WHEN nw = 1 THEN bw WHEN nd = 1 THEN bd ELSE first END AS candidate_id, n > 1 AS needs_review FROM (
      SELECT target_id, count(DISTINCT candidate_id) AS n, count(DISTINCT candidate_id) FILTER (rward = ward) AS nw, count(DISTINCT candidate_id) FILTER (rdistrict = district) AS nd,
        arg_min(candidate_id, (ord, candidate_id)) AS first, max(candidate_id) FILTER (rward = ward) AS bw, max(candidate_id) FILTER (rdistrict = district) AS bd FROM e WHERE {on} GROUP BY 1)"""
    return f"SELECT target_id, {i} AS rung, '{name}' AS method, max(candidate_id) AS candidate_id, {kind == 'review'} AS needs_review FROM e WHERE {on} GROUP BY 1 HAVING count(DISTINCT candidate_id) = 1"


LADDER = f"""WITH t AS (SELECT *, {_NORM.format('name')} AS nn, {_NORM.format('strip_accents(name)')} AS nf FROM ({TARGETS})), r AS (SELECT *, {_NORM.format('name')} AS nn, {_NORM.format('strip_accents(name)')} AS nf FROM ({REGISTRY})),
  e AS (SELECT t.*, r.candidate_id, r.ord, r.ward AS rward, r.district AS rdistrict, r.nn AS rn, r.nf AS rf, r.alias AS ralias, r.filed_id AS rid, r.window IS NOT NULL AS board, string_split(t.nf, ' ') AS tt, string_split(r.nf, ' ') AS rt FROM t JOIN r ON (r.window IS NULL OR r.window = t.window) AND (t.mayor OR NOT r.mayor)),
  hits AS ({_rung_sql(0, 'alias', 'one', 'alias = ralias')} UNION ALL {_rung_sql(1, 'id', 'one', 'filed_id = rid')} UNION ALL {_rung_sql(2, 'exact', 'resolve', 'nn = rn')} UNION ALL {_rung_sql(3, 'accent_fold_exact', 'resolve', 'board AND nf = rf')}
    UNION ALL SELECT target_id, 4, 'several_names', NULL, false FROM e WHERE board AND list_contains(tt, rt[-1]) GROUP BY 1 HAVING count(DISTINCT rt[-1]) > 1
    UNION ALL {_rung_sql(5, 'surname_plus_given', 'review', 'board AND tt[-1] = rt[-1] AND len(list_intersect(tt[:-2], rt[:-2])) > 0')} UNION ALL {_rung_sql(6, 'surname_plus_office', 'review', 'board AND tt[-1] = rt[-1] AND ward = rward')})
  , best AS (SELECT target_id, arg_min(candidate_id, rung) FILTER (rung = low) AS candidate_id, arg_min(method, rung) AS method, arg_min(needs_review, rung) AS needs_review FROM (SELECT *, min(rung) OVER (PARTITION BY target_id) AS low FROM hits) GROUP BY 1)
  , matched AS (SELECT t.target_id, b.candidate_id, coalesce(b.method, 'unmatched') AS method, coalesce(b.needs_review, false) AS needs_review FROM t LEFT JOIN best b ON t.target_id = b.target_id)"""


def ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, folded = F.col("name"), F.col("folded")
    t, r = (df.withColumn("folded", text.norm(text.fold(name))) for df in _views(spark, sf_dir))
    tokens = F.split(folded, " ")
    surname, given = F.element_at(tokens, -1), F.slice(tokens, F.lit(1), F.size(tokens) - 1)
    # What is spelled otherwise is looked for among candidacies that have a window only.
    every, board = (lambda key: matching.scoped(r.withColumn("key", key), ["w1", "w2"])), (lambda key: matching.scoped(r.filter("window IS NOT NULL").withColumn("key", key), ["w1", "w2"]))
    each = lambda parts: F.transform(parts, lambda g: F.concat_ws(" ", g, surname))
    at_ward = F.concat_ws(" ", F.col("ward").cast("string"), surname)
    rungs = [
        ("alias", "one", F.array("alias"), every(F.col("alias"))), ("id", "one", F.array("filed_id"), every(F.col("filed_id"))),
        ("exact", "resolve", F.array(text.norm(name)), every(text.norm(name))), ("accent_fold_exact", "resolve", F.array(folded), board(folded)),
        ("several_names", "guard", tokens, board(surname)), ("surname_plus_given", "review", each(given), board(F.explode(each(given)))),
        ("surname_plus_office", "review", F.array(F.when(F.col("ward").isNotNull(), at_ward)), board(F.when(F.col("ward").isNotNull(), at_ward))),
    ]
    return matching.ladder(t, rungs)


@query("jn9_10_ladder", LADDER + " SELECT * FROM matched")
def jn9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ladder(spark, sf_dir)


@query("jn12_confirmed", LADDER + " SELECT target_id, candidate_id, method, needs_review AND candidate_id % 2 = 0 AS needs_review FROM matched WHERE candidate_id IS NOT NULL")
def jn12(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ladder(spark, sf_dir).filter("candidate_id IS NOT NULL")
    return matching.confirm_reviews(m, m.filter("candidate_id % 2 <> 0"), ["target_id", "candidate_id"])


@query("ag26_match_counters", LADDER + " SELECT method, count(*) AS n, count(*) FILTER (needs_review) AS to_review FROM matched GROUP BY 1")
def ag26(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ladder(spark, sf_dir).groupBy("method").agg(F.count(F.lit(1)).alias("n"), F.count_if("needs_review").alias("to_review"))


@query("jn11_office_holders", f"""WITH t AS (SELECT target_id, string_split({_NORM.format('name')}, ' ') AS tokens, ward FROM ({TARGETS})), h AS (SELECT min(candidate_id) AS holder_id, split_part(name, ' ', 2) AS surname, split_part(name, ' ', 1) AS first, max(ward) AS ward FROM ({REGISTRY}) GROUP BY name),
  s AS (SELECT t.target_id, h.holder_id, coalesce(h.ward = t.ward, false) AS o FROM t JOIN h ON list_contains(tokens, h.surname) WHERE coalesce(h.ward = t.ward, false) OR list_contains(tokens, h.first))
  SELECT * FROM (SELECT target_id, CASE WHEN count(DISTINCT holder_id) FILTER (o) = 1 THEN max(holder_id) FILTER (o) WHEN count(DISTINCT holder_id) = 1 THEN max(holder_id) END AS holder_id FROM s GROUP BY 1) WHERE holder_id IS NOT NULL""")
def jn11(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, r = _views(spark, sf_dir)
    holders = r.groupBy("name").agg(F.min("candidate_id").alias("holder_id"), F.max("ward").alias("ward")).select("holder_id", F.split_part("name", F.lit(" "), F.lit(2)).alias("surname"), F.split_part("name", F.lit(" "), F.lit(1)).alias("first"), "ward")
    return matching.office_holders(t.select("target_id", "ward", F.split(text.norm(F.col("name")), " ").alias("tokens")), holders)


#: Names of people: given names as filed or in full, surnames with letters changed, left out or doubled.
_GIVEN = "CASE p_size % 6 WHEN 0 THEN 'bob' WHEN 1 THEN 'robert' WHEN 2 THEN 'kate' WHEN 3 THEN 'katherine' WHEN 4 THEN 'jon' ELSE split_part(p_name, ' ', 1) END"
FILED = f"SELECT DISTINCT p_name || '|' || CAST(p_size AS VARCHAR(9)) AS filed_id, {_GIVEN} || ' ' || CASE p_size % 5 WHEN 0 THEN replace(split_part(p_name, ' ', 2), 'e', '') || 'ton' WHEN 1 THEN split_part(p_name, ' ', 2) || ' mac' || split_part(p_name, ' ', 1) WHEN 2 THEN 'mac' || split_part(p_name, ' ', 1) ELSE split_part(p_name, ' ', 2) END AS name FROM part"
KNOWN = f"SELECT p_partkey AS candidate_id, {_GIVEN.replace('p_size % 6', 'p_partkey % 6')} || ' ' || CASE p_partkey % 4 WHEN 0 THEN split_part(p_name, ' ', 2) || 'ton' WHEN 1 THEN split_part(p_name, ' ', 2) WHEN 2 THEN 'mc' || split_part(p_name, ' ', 1) ELSE 'mac' || split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2) END AS name FROM part"
_NICK = "(" + " UNION ALL ".join(f"SELECT unnest({g!r}) AS w, {i} AS k" for i, g in enumerate(matching.NICKNAMES)) + ")"


@query("fn27_suggestions", f"""WITH f AS (SELECT filed_id, string_split(name, ' ') AS t FROM ({FILED})), k AS (SELECT candidate_id, string_split(name, ' ') AS u FROM ({KNOWN})),
  a AS (SELECT DISTINCT t FROM f), b AS (SELECT DISTINCT u FROM k), p AS (SELECT t, u, t[-1] AS s, u[-1] AS r, t[:-2] AS g, u[:-2] AS h FROM a CROSS JOIN b),
  n AS (SELECT DISTINCT x.w AS x, y.w AS y FROM {_NICK} x JOIN {_NICK} y ON x.k = y.k),
  w AS (SELECT t, u, s, r, len(list_intersect(g, h)) > 0 AS same, EXISTS (SELECT 1 FROM n WHERE list_contains(g, n.x) AND list_contains(h, n.y)) OR len(list_intersect(g, h)) > 0 AS nick,
    len(list_filter(g, lambda x: len(list_filter(h, lambda y: levenshtein(x, y) <= 2 AND least(length(x), length(y)) >= 4)) > 0)) > 0 AS spelled FROM p),
  o AS (SELECT t, u, CASE WHEN s = r AND NOT same AND nick THEN 'nickname' WHEN s = r AND NOT same AND spelled THEN 'given-name spelling' WHEN s <> r AND list_contains(u, s) AND nick THEN 'part of a compound surname'
    WHEN s <> r AND length(s) >= 4 AND levenshtein(s, r) <= 2 AND nick THEN 'surname spelling' WHEN s <> r AND list_contains(t, r) AND nick THEN 'surname order or extra name' END AS reason FROM w)
  SELECT f.filed_id, k.candidate_id, o.reason FROM o JOIN f ON f.t = o.t JOIN k ON k.u = o.u WHERE o.reason IS NOT NULL""")
def fn27(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = raw(spark, sf_dir, "part")
    f, k = (spark.sql(q.replace("VARCHAR(9)", "STRING").replace("FROM part", "FROM {part}"), part=part).withColumn("tokens", F.split("name", " ")) for q in (FILED, KNOWN))
    return matching.suggestions(f.select("filed_id", "tokens"), k.select("candidate_id", "tokens"))


@query("ag24_collapse", oracle(f"SELECT spender_id, target_id, date, stance, count(*) - 1 AS dropped FROM expenditures GROUP BY 1, 2, 3, 4 HAVING count(*) > 1"))
def ag24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.collapse_duplicates(model(spark, sf_dir, "expenditures"), ["spender_id", "target_id", "date", "stance"], "doc_id")[1]


@query("ag24_collapsed_rows", oracle("SELECT spender_id, target_id, date, stance, min(doc_id) AS doc_id FROM expenditures GROUP BY 1, 2, 3, 4"))
def ag24b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.collapse_duplicates(model(spark, sf_dir, "expenditures"), ["spender_id", "target_id", "date", "stance"], "doc_id")[0].select("spender_id", "target_id", "date", "stance", "doc_id")


@query("ag25_unmatched_groups", oracle(f"SELECT spender_id, part_id % 50 AS name, count(*) AS rows, {M.format('amount')} AS amount, min(date) AS first, max(date) AS last, string_agg(DISTINCT stance, ',' ORDER BY stance) AS stances, CASE WHEN (part_id % 50) % 4 = 0 THEN 'out of scope' END AS disposition, (part_id % 50) % 4 <> 0 AS undecided FROM expenditures GROUP BY spender_id, part_id % 50"))
def ag25(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = model(spark, sf_dir, "expenditures").withColumn("name", F.col("part_id") % 50)
    decided = e.filter("name % 4 = 0").select("spender_id", "name").distinct().withColumn("disposition", F.lit("out of scope"))
    return matching.unmatched_groups(e, decided, ["spender_id", "name"])


ENTITIES = "SELECT p_partkey AS id, 'type' AS type, CASE WHEN p_partkey % 4 = 0 THEN p_name || ' Inc.' WHEN p_partkey % 4 = 1 THEN 'The ' || p_name || ' ' || p_type WHEN p_partkey % 4 = 2 THEN p_brand || ' ' || p_type || ' Union' ELSE substring(p_brand, 1, 1) || substring(p_type, 1, 1) END AS name FROM part"
_C = WORDS_SQL.format(c="name", drop=in_sql(text.ORG_STOP))
_A = WORDS_SQL.format(c="name", drop=in_sql(text.ACRONYM_STOP))


_PAIRS = f"""WITH e AS (SELECT id, name, list_sort(list_distinct({_C})) AS core, array_to_string(list_transform({_A}, lambda t: substring(t, 1, 1)), '') AS acro, array_to_string({_A}, '') AS comp FROM (SELECT min(id) AS id, name FROM ({ENTITIES}) GROUP BY name)),
  p AS (SELECT a.id AS a, b.id AS b, a.core AS ca, b.core AS cb, a.core = b.core AND len(a.core) > 0 AS same, a.comp <> '' AND b.comp <> '' AND (length(a.comp) <= 5 AND a.comp = b.acro OR length(b.comp) <= 5 AND b.comp = a.acro) AS acr,
    CASE WHEN len(a.core) = 0 OR len(b.core) = 0 THEN 0.0 ELSE CAST(len(list_intersect(a.core, b.core)) AS DOUBLE) / len(list_distinct(list_concat(a.core, b.core))) END AS score FROM e a JOIN e b ON a.id < b.id)
  SELECT a, b, CASE WHEN same THEN 'same name' WHEN acr THEN 'acronym' WHEN len(ca) > 0 AND len(cb) > 0 AND (len(list_filter(ca, lambda x: NOT list_contains(cb, x))) = 0 OR len(list_filter(cb, lambda x: NOT list_contains(ca, x))) = 0) THEN 'subset' ELSE 'similar' END AS why, round(score, 6) AS score
  FROM p WHERE same OR acr OR score >= 0.6 OR len(ca) > 0 AND len(cb) > 0 AND (len(list_filter(ca, lambda x: NOT list_contains(cb, x))) = 0 OR len(list_filter(cb, lambda x: NOT list_contains(ca, x))) = 0)"""


@query("jn34_near_duplicates", _PAIRS)
def jn34(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.near_duplicates(spark.sql(ENTITIES.replace("FROM part", "FROM {part}"), part=raw(spark, sf_dir, "part")))


@query("so6_ranked_suggestions", f"""WITH found AS ({_PAIRS}), money AS (SELECT min(id) AS id, name, CAST(sum(p_retailprice) AS DECIMAL(18,2)) AS m FROM ({ENTITIES}) e JOIN (SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,2)) AS p_retailprice FROM part) p ON e.id = p_partkey GROUP BY name)
  SELECT a, b, why, score, CASE WHEN why = 'similar' THEN 'review' ELSE 'high' END AS confidence, CAST(x.m + y.m AS DECIMAL(18,2)) AS dollars, CASE WHEN y.m > x.m THEN b ELSE a END AS canonical FROM found JOIN money x ON x.id = a JOIN money y ON y.id = b""")
def so6(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = raw(spark, sf_dir, "part")
    e = given(spark, sf_dir, ENTITIES).join(part.select(F.col("p_partkey").alias("id"), F.col("p_retailprice").cast("decimal(18,2)").alias("total")), "id")
    return matching.ranked(matching.near_duplicates(e), e, ["type"])


_GROUPS = "SELECT '{kind}' AS kind, min(key) AS key, m FROM (SELECT {key} AS key, list_sort(list_distinct(list({member}))) AS m FROM {rows} GROUP BY 1 HAVING count(DISTINCT {member}) >= 2) GROUP BY m"


@query("jn35_shared_employer", "SELECT kind, key, unnest(m) AS member, len(m) AS n FROM (" + _GROUPS.format(kind="brand", key="p_brand || '/' || p_size", member="p_partkey", rows="part") + ")")
def jn35(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = raw(spark, sf_dir, "part").select(F.concat_ws("/", "p_brand", F.col("p_size").cast("string")).alias("key"), "p_partkey")
    return matching.shared_groups(p, "key", "p_partkey", "brand")


#: People named by a number and a word; organisations of friends of the next person, and firms.
DONORS = """SELECT p_partkey AS donor_id, CASE p_partkey % 3 WHEN 0 THEN 'w' || CAST(p_partkey AS VARCHAR(20)) || ' ' || split_part(p_name, ' ', 2) || CAST(p_size AS VARCHAR(20))
    WHEN 1 THEN 'Friends of w' || CAST(p_partkey - 1 AS VARCHAR(20)) || ' ' || split_part(p_name, ' ', 2) || CAST(p_size % 2 + p_partkey % 50 AS VARCHAR(20)) || ' Inc.' ELSE p_brand || ' Works ' || CAST(p_size AS VARCHAR(20)) END AS name,
  CASE p_partkey % 3 WHEN 0 THEN 'Individual' ELSE 'PAC' END AS type, CASE WHEN p_partkey % 2 = 0 THEN p_brand || ' Works, ' || CAST(p_size AS VARCHAR(20)) || ' LLC' ELSE p_type END AS employer,
  CAST(p_retailprice AS DECIMAL(18,2)) AS total FROM part"""
_N, _E = _C, WORDS_SQL.format(c="employer", drop=in_sql(text.ORG_STOP))
_PEOPLE = "(SELECT donor_id, trim(regexp_replace(regexp_replace(lower(employer), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS e, string_split(lower(name), ' ')[-1] AS s FROM d WHERE type = 'Individual')"


@query("jn35_related_donors", f"""WITH d AS ({DONORS}), p AS (SELECT donor_id, name, list_distinct({_N}) AS t, array_to_string({_E}, ' ') AS work FROM d WHERE type = 'Individual'),
  o AS (SELECT donor_id, name, {_N} AS t, array_to_string({_N}, ' ') AS core FROM d WHERE type <> 'Individual'),
  pairs AS (SELECT p.donor_id AS a, o.donor_id AS b, 'name in organisation' AS kind, p.name AS key FROM p JOIN o ON len(p.t) > 0 AND list_has_all(o.t, p.t)
    UNION ALL SELECT p.donor_id, o.donor_id, 'employer is organisation', o.name FROM p JOIN o ON p.work <> '' AND p.work = o.core WHERE NOT (len(p.t) > 0 AND list_has_all(o.t, p.t))),
  g AS ({_GROUPS.format(kind="shared employer", key="e", member="donor_id", rows=f"{_PEOPLE} WHERE length(e) >= 3")} UNION ALL {_GROUPS.format(kind="shared surname", key="s", member="donor_id", rows=f"{_PEOPLE} WHERE length(s) >= 4")}
    UNION ALL SELECT kind, key || ' / ' || a || ' / ' || b, [a, b] FROM pairs),
  r AS (SELECT kind, key, unnest(m) AS donor_id, len(m) AS n FROM g)
  SELECT kind AS relationship, key AS label, r.donor_id, n, CAST(sum(total) OVER (PARTITION BY kind, key) AS DECIMAL(18,2)) AS dollars FROM r JOIN d ON r.donor_id = d.donor_id""")
def jn35_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.related_donors(given(spark, sf_dir, DONORS))


_TOKENS = f"list_distinct(string_split({_NORM.format('text')}, ' '))"


@query("jn33_keyword_candidates", f"""WITH i AS (SELECT item_id, {_TOKENS} AS it, unnest(list_transform(list_slice(list_sort(list_transform({TITLE_SQL}, lambda t: struct_pack(n := -length(t), t := t))), 1, 3), lambda e: e.t)) AS w FROM benchmark),
  r AS (SELECT conv_id || '-' || turn AS record_id, {_TOKENS} AS rt, turn % 2 = 0 AS divided FROM conversations), x AS (SELECT *, unnest(rt) AS w FROM r),
  s AS (SELECT DISTINCT item_id, record_id, CAST(len(list_intersect(it, rt)) + CASE WHEN divided THEN 5 ELSE 0 END + 2 AS INT) AS score FROM i JOIN x ON i.w = x.w)
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, record_id) AS INT) AS rank FROM s) WHERE rank <= 5""")
def jn33(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = raw(spark, sf_dir, "benchmark").select("item_id", text.title_keywords(F.col("text")).alias("keywords"), F.array_distinct(F.split(text.norm(F.col("text")), " ")).alias("tokens"), F.lit(2024).alias("year"))
    records = raw(spark, sf_dir, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("record_id"), F.array_distinct(F.split(text.norm(F.col("text")), " ")).alias("tokens"), (F.col("turn") % 2 == 0).alias("divided"), F.lit(2024).alias("year"))
    return matching.keyword_candidates(items, records)


@query("ag61_probe_totals", oracle(f"SELECT d.donor_id, d.name, d.type, {M.format('c.amount')} AS amount, count(c.donor_id) AS n FROM donors d LEFT JOIN contributions c ON c.donor_id = d.donor_id GROUP BY 1, 2, 3"))
def ag61(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = model(spark, sf_dir, "contributions").groupBy("donor_id").agg(total(F.col("amount")).alias("amount"), F.count(F.lit(1)).alias("n"))
    d = model(spark, sf_dir, "donors").select("donor_id", "name", "type")
    return d.join(sums, "donor_id", "left").select("donor_id", "name", "type", F.coalesce("amount", F.lit(0)).cast("decimal(18,2)").alias("amount"), F.coalesce("n", F.lit(0)).alias("n"))
