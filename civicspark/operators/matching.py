"""Matching free text to registries, and donors to each other."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.functions import text

#: Nicknames: fixed value.
NICKNAMES = [
    ["pete", "peter"], ["bill", "billy", "will", "william", "willie"], ["bob", "bobby", "rob", "robert"], ["jim", "jimmy", "james"], ["mike", "michael"], ["tony", "anthony"],
    ["theresa", "therese", "teresa"], ["dan", "danny", "daniel"], ["tom", "tommy", "thomas"], ["joe", "joseph"], ["chris", "christopher"],
    ["kate", "katie", "katherine", "kathryn", "catherine"], ["liz", "beth", "elizabeth"], ["sam", "samantha", "samuel"], ["nick", "nicholas"], ["matt", "matthew"],
    ["dave", "david"], ["steve", "steven", "stephen"], ["ed", "eddie", "edward"], ["ron", "ronnie", "ronald"], ["greg", "gregory"], ["gil", "gilbert"],
    ["jessie", "jessica"], ["leo", "leonardo"], ["tim", "timmy", "timothy"], ["ray", "raymond"], ["al", "alan", "albert"], ["andy", "andrew"],
    ["pat", "patrick", "patricia"], ["jen", "jenny", "jennifer"], ["deb", "debbie", "debra", "deborah"], ["sue", "susan"], ["rick", "richard", "dick"], ["dj", "dennis"],
]


def scoped(registry: DataFrame, windows: Sequence[str]) -> DataFrame:
    """registry (key, candidate_id, ward, district, ord, window, mayor) with a row for each scope that admits the
    candidacy: one of a window only for payments dated in it, any other for all and for those of no window
    (""); one for mayor only where the payment's office names the mayor."""
    spread = F.when(F.col("window").isNotNull(), F.array("window")).otherwise(F.array(F.lit(""), *map(F.lit, windows)))
    offices = F.when(F.col("mayor"), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False)))
    rows = registry.filter("key IS NOT NULL").withColumn("window", F.explode(spread)).withColumn("mayor", F.explode(offices))
    return rows.select("window", "mayor", "key", "candidate_id", "ward", "district", "ord")


def ladder(targets: DataFrame, rungs: Sequence[tuple[str, str, Column, DataFrame]]) -> DataFrame:
    """target_id, candidate_id, method, needs_review: the first rung with a hit decides.

    A rung is (name, kind, the target's keys as an array, scoped() rows of the registry). Kinds: "resolve" takes
    the only hit; of several the one of the target's ward, else of its district, for review; else the first by
    ord, as name_fallback, for review. "one" takes the only hit as sure, "review" for review, and neither takes
    any of several. "guard" stops where more than one key is known: several_names, no candidate.
    targets: target_id, window, mayor, ward, district and what the keys need; one row for each distinct name,
    office and window, not for each payment. The registry is brought to a row a key before it is joined, so a
    name that many candidacies have multiplies nothing."""
    hits = []
    low, high = F.min("candidate_id").alias("lo"), F.max("candidate_id").alias("hi")
    for i, (name, kind, keys, registry) in enumerate(rungs):
        asked = targets.select("target_id", "window", "mayor", "ward", "district", F.explode(F.array_distinct(F.array_compact(keys))).alias("key"))
        on = ["window", "mayor", "key"]
        found = asked.join(registry.groupBy(*on).agg(low, high, F.min(F.struct("ord", "candidate_id")).alias("first")), on)
        if kind == "guard":
            rows = found.groupBy("target_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            rows = rows.select("target_id", F.lit(None).cast(registry.schema["candidate_id"].dataType).alias("candidate_id"), F.lit("several_names").alias("method"), F.lit(False).alias("needs_review"))
        elif kind == "resolve":
            for part in ("ward", "district"):
                near = registry.filter(F.col(part).isNotNull()).groupBy(*on, part).agg(low.alias(f"{part}_lo"), high.alias(f"{part}_hi"))
                found = found.join(near, [*on, part], "left")
            ends = [f(c).alias(c) for f, c in ((F.min, "lo"), (F.max, "hi"), (F.min, "first"), (F.min, "ward_lo"), (F.max, "ward_hi"), (F.min, "district_lo"), (F.max, "district_hi"))]
            g = found.groupBy("target_id").agg(*ends)
            only, ward, district = (F.col(f"{x}lo") == F.col(f"{x}hi") for x in ("", "ward_", "district_"))
            pick = F.when(only, F.col("lo")).when(ward, F.col("ward_lo")).when(district, F.col("district_lo")).otherwise(F.col("first.candidate_id"))
            method = F.when(only | F.coalesce(ward, F.lit(False)) | F.coalesce(district, F.lit(False)), name).otherwise("name_fallback")
            rows = g.select("target_id", pick.alias("candidate_id"), method.alias("method"), (~only).alias("needs_review"))
        else:
            one = found.groupBy("target_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo = hi")
            rows = one.select("target_id", F.col("lo").alias("candidate_id"), F.lit(name).alias("method"), F.lit(kind == "review").alias("needs_review"))
        hits.append(rows.select("target_id", F.struct(F.lit(i).alias("rung"), "candidate_id", "method", "needs_review").alias("hit")))
    won = reduce(DataFrame.unionByName, hits).groupBy("target_id").agg(F.min_by("hit", "hit.rung").alias("hit"))
    joined = targets.select("target_id").join(won, "target_id", "left")
    return joined.select("target_id", "hit.candidate_id", F.coalesce("hit.method", F.lit("unmatched")).alias("method"), F.coalesce("hit.needs_review", F.lit(False)).alias("needs_review"))


def office_holders(targets: DataFrame, holders: DataFrame) -> DataFrame:
    """target_id, holder_id: a holder whose surname is among the target's tokens, borne out by ward or first name; only if
    one is left. targets: target_id, tokens, ward. holders: holder_id, surname, first, ward. Holders of one name
    and ward are one row when they are joined."""
    spread = targets.select("target_id", "tokens", "ward", F.explode(F.array_distinct("tokens")).alias("surname"))
    alike = holders.groupBy("surname", "first", F.col("ward").alias("_ward")).agg(F.min("holder_id").alias("lo"), F.max("holder_id").alias("hi"))
    hits = spread.join(alike, "surname")
    of = F.coalesce(F.col("ward") == F.col("_ward"), F.lit(False))
    strong = hits.filter(of | F.array_contains("tokens", F.col("first"))).withColumn("of", of)
    ends = [F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min(F.when(F.col("of"), F.col("lo"))).alias("of_lo"), F.max(F.when(F.col("of"), F.col("hi"))).alias("of_hi")]
    only = F.when(F.col("of_lo") == F.col("of_hi"), F.col("of_lo")).when(F.col("lo") == F.col("hi"), F.col("lo"))
    return strong.groupBy("target_id").agg(*ends).select("target_id", only.alias("holder_id")).filter("holder_id IS NOT NULL")


def confirm_reviews(matches: DataFrame, confirmed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The review flag is cleared for pairs that people have confirmed."""
    listed = confirmed.select(*keys).distinct().withColumn("_ok", F.lit(True))
    return matches.join(listed, list(keys), "left").withColumn("needs_review", F.col("needs_review") & F.col("_ok").isNull()).drop("_ok")


def _nicknames() -> Column:
    groups = {}
    for i, g in enumerate(NICKNAMES):
        for name in g:
            groups.setdefault(name, []).append(i)
    return F.create_map(*[x for k, v in groups.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])


def _nick(a: Column, b: Column) -> Column:
    table = _nicknames()
    return (a == b) | F.coalesce(F.arrays_overlap(F.try_element_at(table, a), F.try_element_at(table, b)), F.lit(False))


def _shortened(word: Column) -> Column:
    """word and what is left of it without any one or two of its letters. Two words at edit distance 2 or less
    have one of these in common."""
    drop = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, 1, i - 1), w.substr(i + 1, F.length(w))))
    once = drop(word)
    return F.array_distinct(F.concat(F.array(word), once, F.flatten(F.transform(once, drop))))


def _alike(mine: DataFrame, theirs: DataFrame, least: int) -> DataFrame:
    """x, y: words of mine (x) and of theirs (y) that differ, at an edit distance of 2 or less, x of `least` letters or more.
    Words meet by what is left of them without one or two letters, each word once."""
    x = mine.filter(F.length("x") >= least).distinct().select("x", F.explode(_shortened(F.col("x"))).alias("left"))
    y = theirs.distinct().select("y", F.explode(_shortened(F.col("y"))).alias("left"))
    return x.join(y, "left").filter("x <> y").select("x", "y").distinct().filter(F.levenshtein("x", "y") <= 2)


def _hint_pairs(filed: DataFrame, registry: DataFrame) -> DataFrame:
    """t, u: token lists that may have a reason. filed: t; registry: u, each list once.

    Words are compared first, then lists meet only by words that are so related: a surname of thousands of names joins
    those with a given name that is another form of theirs. Lists that share surname and given name, the large
    groups, have no reason by that and don't meet."""
    def side(df: DataFrame, tokens: str) -> DataFrame:
        given = F.slice(tokens, F.lit(1), F.size(tokens) - 1)
        known = F.coalesce(F.try_element_at(_nicknames(), F.col("_given")), F.array().cast("array<int>"))
        out = df.filter(F.size(tokens) > 1).select(tokens, F.element_at(tokens, -1).alias("last"), given.alias("given")).withColumn("_given", F.explode("given"))
        return out.select("*", F.explode(F.concat(F.array("_given"), F.transform(known, lambda k: k.cast("string")))).alias("key"))

    f, r = side(filed, "t"), side(registry, "u")
    given, other = f.select("t", "last", F.col("_given").alias("x")).distinct(), r.select("u", "last", F.col("_given").alias("y")).distinct()
    # Given names that are forms of one, by nickname or by spelling, of one surname.
    nick = f.select(F.col("_given").alias("x"), "key").distinct().join(r.select(F.col("_given").alias("y"), "key").distinct(), "key").filter("x <> y").select("x", "y")
    spelled = _alike(given.select("x"), other.select("y").filter(F.length("y") >= 4), 4)
    forms = nick.unionByName(spelled).distinct()
    one_surname = given.join(forms, "x").join(other, ["last", "y"]).select("t", "u")
    # A surname that stands among the other's given names; the lists share a given name or forms of one.
    within = lambda df, c: df.select(c, "key", F.explode("given").alias("word"))
    compound = f.select("t", "key", F.col("last").alias("word")).join(within(r, "u"), ["word", "key"]).select("t", "u")
    order = within(f, "t").join(r.select("u", "key", F.col("last").alias("word")), ["word", "key"]).select("t", "u")
    # Surnames spelled alike.
    alike = _alike(f.select(F.col("last").alias("x")), r.select(F.col("last").alias("y")), 4)
    surnames = f.select("t", "key", F.col("last").alias("x")).join(alike, "x").join(r.select("u", "key", F.col("last").alias("y")), ["y", "key"]).select("t", "u")
    return one_surname.unionByName(compound).unionByName(order).unionByName(surnames).distinct()


def suggestions(filed: DataFrame, registry: DataFrame) -> DataFrame:
    """filed_id, candidate_id, reason: hints for people, never a match. Both sides have tokens (array, last is the
    surname). No pair with a reason is lost, and the registry isn't crossed: see _hint_pairs()."""
    # Equal token lists are compared once; ids come back afterwards.
    pairs = _hint_pairs(filed.select(F.col("tokens").alias("t")).distinct(), registry.select(F.col("tokens").alias("u")).distinct())
    n, m = F.size("t"), F.size("u")
    g, s = F.slice("t", F.lit(1), n - 1), F.element_at("t", -1)
    h, r = F.slice("u", F.lit(1), m - 1), F.element_at("u", -1)
    same = F.arrays_overlap(g, h)
    nick = F.exists(g, lambda a: F.exists(h, lambda b: _nick(a, b)))
    spelled = F.exists(g, lambda a: F.exists(h, lambda b: (F.levenshtein(a, b) <= 2) & (F.least(F.length(a), F.length(b)) >= 4)))
    close = same | nick
    reason = (
        F.when((s == r) & ~same & nick, "nickname")
        .when((s == r) & ~same & spelled, "given-name spelling")
        .when((s != r) & F.array_contains("u", s) & close, "part of a compound surname")
        .when((s != r) & (F.length(s) >= 4) & (F.levenshtein(s, r) <= 2) & close, "surname spelling")
        .when((s != r) & F.array_contains("t", r) & close, "surname order or extra name")
    )
    found = pairs.select("t", "u", reason.alias("reason")).filter("reason IS NOT NULL")
    left, right = filed.select("filed_id", F.col("tokens").alias("t")).distinct(), registry.select("candidate_id", F.col("tokens").alias("u")).distinct()
    return found.join(left, "t").join(right, "u").select("filed_id", "candidate_id", "reason")


def unmatched_groups(rows: DataFrame, dispositions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unmatched payments by group: rows, amount, first and last date, stances, and what was decided."""
    g = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("decimal(18,2)").alias("amount"), F.min("date").alias("first"), F.max("date").alias("last"), F.array_join(F.array_sort(F.collect_set("stance")), ",").alias("stances"))
    return g.join(dispositions, list(keys), "left").withColumn("undecided", F.col("disposition").isNull())


def collapse_duplicates(rows: DataFrame, keys: Sequence[str], order: str) -> tuple[DataFrame, DataFrame]:
    """The first row, by order, of each set of equal keys; and how many were dropped by set."""
    w = Window.partitionBy(*keys)
    numbered = rows.withColumn("_i", F.row_number().over(w.orderBy(order)))
    dropped = rows.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("dropped")).filter("dropped > 0")
    return numbered.filter("_i = 1").drop("_i"), dropped


def _choices(tokens: Column, k: int) -> Column:
    """All choices of k tokens of an array, in its order, as text."""
    if k == 1:
        return tokens
    rest = lambda i: F.slice(tokens, i + 2, F.size(tokens))
    return F.flatten(F.transform(tokens, lambda x, i: F.transform(_choices(rest(i), k - 1), lambda more: F.concat_ws(" ", x, more))))


def _least_shared(least: float, longest: int = 40) -> dict[int, int]:
    """For a set of n tokens: how many it shares at least with a set that is similar enough and neither holds nor is
    held by it. Sets of other sizes than those listed have no such partner, or are longer than `longest`."""
    out = {}
    for n in range(1, longest + 1):
        shared = {m: math.ceil((n + m) * least / (1 + least) - 1e-9) for m in range(max(1, int(n * least)), int(n / least) + 2)}
        fit = [c for m, c in shared.items() if c < min(n, m)]
        if fit:
            out[n] = max(1, min(fit))
    return out


def name_classes(entities: DataFrame) -> DataFrame:
    """id (the least of the class), type, name, core, ordered (the core tokens, rarest first), acro, compact."""
    classes = entities.groupBy("type", "name").agg(F.min("id").alias("id"))
    core = F.array_sort(F.array_distinct(text.core_tokens(F.col("name"))))
    e = classes.select("id", "type", "name", core.alias("core"), text.acronym(F.col("name")).alias("acro"), text.compact(F.col("name")).alias("compact"))
    each = e.select("id", "type", F.explode("core").alias("w"))
    held = each.groupBy("type", "w").agg(F.count(F.lit(1)).alias("df"))
    order = each.join(held, ["type", "w"]).groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("df", "w"))), lambda x: x["w"]).alias("ordered"))
    return e.join(order, "id", "left").withColumn("ordered", F.coalesce("ordered", F.array().cast("array<string>")))


def name_pairs(e: DataFrame, least: float) -> DataFrame:
    """a, b: classes of names that may be one, a < b. e: of name_classes().

    Equal sets meet by the whole set; an acronym meets the names that spell it. A set that another holds meets it by its
    three rarest tokens (all, if it has fewer), which the other has among its own. Sets that only overlap share three
    tokens of their prefixes, in one order of all tokens, rarest first: with c tokens to share of n, the first n - c + 3
    of each. (Sets that share fewer than three and are similar enough are equal or one in the other.) So a token or a pair
    that thousands of names have brings none of them together by itself."""
    n = F.size("ordered")
    side = lambda df, i, key: df.select("type", F.col("id").alias(i), key.alias("key"))
    some = e.filter(n > 0)
    whole = F.array_join("ordered", " ")
    equal = side(some, "a", whole).join(side(some, "b", whole), ["type", "key"]).select("a", "b")
    spelt = side(e.filter("acro <> ''"), "a", F.col("acro")).join(side(e.filter("compact <> '' AND length(compact) <= 5"), "b", F.col("compact")), ["type", "key"]).select("a", "b")
    rarest = lambda k: F.concat(F.lit(f"{k}:"), F.array_join(F.slice("ordered", 1, 3), " "))
    asked = side(some.filter(n < 3), "a", F.concat(n.cast("string"), F.lit(":"), whole)).unionByName(side(some.filter(n >= 3), "a", rarest(3)))
    marked = lambda k: F.transform(_choices(F.col("ordered"), k), lambda x: F.concat(F.lit(f"{k}:"), x))
    holds = side(some, "b", F.explode(F.concat(*map(marked, (1, 2, 3)))))
    inside = asked.join(holds, ["type", "key"]).select("a", "b")
    known = _least_shared(least)
    if min(known.values(), default=3) < 3:
        raise ValueError("least is too low for prefixes of three tokens")
    shared = F.try_element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), n)
    shared = F.when(n > max(known, default=0), F.ceil(n * F.lit(least) - 1e-9).cast("int")).otherwise(shared)
    prefixes = some.withColumn("c", shared).filter("c IS NOT NULL").select("type", "id", F.explode(_choices(F.slice("ordered", F.lit(1), n - F.col("c") + 3), 3)).alias("key"))
    over = prefixes.select("type", "key", F.col("id").alias("a")).join(prefixes.select("type", "key", F.col("id").alias("b")), ["type", "key"]).filter("a < b").select("a", "b")
    met = equal.unionByName(spelt).unionByName(inside).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return met.unionByName(over).distinct()


def near_duplicates(entities: DataFrame, least: float = 0.6) -> DataFrame:
    """a, b, why, score of similar names within a type: equal normal names, acronyms, or a token overlap of at
    least least, taken as 1 where one name's tokens are all the other's.

    entities: id, name, type. Rows of one name and type are a class, known by its least id; pairs are of classes,
    and membership is the name. No pair is lost: see name_pairs()."""
    e = name_classes(entities)
    pairs = name_pairs(e, least)
    left, right = e.select(*[F.col(c).alias(f"l_{c}") for c in e.columns]), e.select(*[F.col(c).alias(f"r_{c}") for c in e.columns])
    j = pairs.join(left, F.col("a") == F.col("l_id")).join(right, F.col("b") == F.col("r_id"))
    score = text.jaccard(F.col("l_core"), F.col("r_core"))
    subset = (F.size("l_core") > 0) & (F.size("r_core") > 0) & (text.is_subset(F.col("l_core"), F.col("r_core")) | text.is_subset(F.col("r_core"), F.col("l_core")))
    acronym = text.acronym_match(F.col("l_name"), F.col("r_name"))
    why = F.when((F.col("l_core") == F.col("r_core")) & (F.size("l_core") > 0), "same name").when(acronym, "acronym").when(subset, "subset").when(score >= least, "similar")
    return j.select("a", "b", why.alias("why"), F.round(score, 6).alias("score")).filter("why IS NOT NULL")


def shared_groups(rows: DataFrame, key: str, member: str, kind: str) -> DataFrame:
    """kind, key, member, n: a row for each member of every key that two members or more share. Of keys with the same
    set of members the least is given.

    No group is gathered: sets are told apart by their size, least and greatest member, and two sums of hashes."""
    m = rows.filter(F.col(key).isNotNull() & F.col(member).isNotNull()).select(F.col(key).alias("key"), F.col(member).alias("member")).distinct()
    h = lambda seed: F.xxhash64(F.lit(seed), "member")
    g = m.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("member").alias("lo"), F.max("member").alias("hi"), F.bit_xor(h(1)).alias("x"), F.bit_xor(h(2)).alias("y")).filter("n >= 2")
    kept = g.groupBy("n", "lo", "hi", "x", "y").agg(F.min("key").alias("key"))
    return m.join(kept.select("key", "n"), "key").select(F.lit(kind).alias("kind"), "key", "member", "n")


def _organisation_pairs(people: DataFrame, others: DataFrame) -> DataFrame:
    """p_id, o_id, kind, key, p_total, o_total: a person and an organisation whose name holds all words of theirs, or else
    that is their employer by name. Names are compared once, by the person's word that fewest organisations hold."""
    words = lambda c: F.array_sort(F.array_distinct(text.core_tokens(F.col(c))))
    p = people.select(F.col("donor_id").alias("p_id"), F.col("name").alias("p_name"), F.col("total").alias("p_total"), words("name").alias("p"), F.array_join(text.core_tokens(F.col("employer")), " ").alias("work"))
    o = others.select(F.col("donor_id").alias("o_id"), F.col("name").alias("o_name"), F.col("total").alias("o_total"), words("name").alias("o"), F.array_join(text.core_tokens(F.col("name")), " ").alias("core"))
    org_words = o.select("o").distinct().select("o", F.explode("o").alias("w"))
    held = org_words.groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    # A word that no organisation holds settles that the name is in none.
    asked = p.select("p").distinct().select("p", F.explode("p").alias("w")).join(held, "w", "left")
    rarest = asked.groupBy("p").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "w")).alias("r")).filter("r.df > 0").select("p", F.col("r.w").alias("w"))
    names = rarest.join(org_words, "w").filter(F.size(F.array_except("p", "o")) == 0).select("p", "o")
    inside = p.join(names, "p").join(o, "o").select("p_id", "o_id", F.lit("name in organisation").alias("kind"), F.col("p_name").alias("key"), "p_total", "o_total")
    # What few bytes meet may be many pairs, so the parts are counted and not left to their size.
    parts = int(people.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    works = p.filter("work <> ''").repartition(parts, "work").join(o.repartition(parts, "core"), F.col("work") == F.col("core"))
    # Most pairs are settled by one word, without a set for each.
    works = works.filter(~((F.size("p") > 0) & F.array_contains("o", F.try_element_at("p", F.lit(1))) & (F.size(F.array_except("p", "o")) == 0)))
    return inside.unionByName(works.select("p_id", "o_id", F.lit("employer is organisation").alias("kind"), F.col("o_name").alias("key"), "p_total", "o_total"))


def related_donors(donors: DataFrame, person: str = "Individual") -> DataFrame:
    """relationship, label, donor_id, n, dollars: donors that are apart but belong together, a row for each member of a group;
    dollars are the group's. donors: donor_id, name, type, employer, total; others than of type person are organisations.

    People share an employer (three letters or more) or a surname (four or more). A person goes with an organisation
    by _organisation_pairs(). Pairs may be many more than donors, so they carry both totals and are neither shuffled
    nor summed; only those of ids that stand in several rows are grouped, as the shared ones are."""
    employer, last = text.norm(F.col("employer")), text.surname(F.col("name"))
    people = donors.filter(F.col("type") == person)
    by = lambda key, kind: shared_groups(people.select(key.alias("k"), "donor_id"), "k", "donor_id", kind)
    shared = by(F.when(F.length(employer) >= 3, employer), "shared employer").unionByName(by(F.when(F.length(last) >= 4, last), "shared surname"))

    repeated = donors.groupBy("donor_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR donor_id IS NULL").select(F.col("donor_id").alias("_id"))
    same = F.col("donor_id").eqNullSafe(F.col("_id"))
    once, several = donors.join(repeated, same, "left_anti"), donors.join(repeated, same, "left_semi")
    sides = lambda d: (d.filter(F.col("type") == person), d.filter(F.col("type") != person))
    (p, o), (p_several, o_several) = sides(once), sides(several)
    label = F.concat_ws(" / ", "key", F.col("p_id").cast("string"), F.col("o_id").cast("string"))
    of_pairs = lambda pairs, *more: pairs.select("kind", label.alias("key"), F.explode(F.array("p_id", "o_id")).alias("member"), F.lit(2).cast("long").alias("n"), *more)
    both = F.coalesce(F.col("p_total") + F.col("o_total"), "p_total", "o_total").cast("decimal(18,2)")
    plain = of_pairs(_organisation_pairs(p, o), both.alias("dollars"))
    unclear = of_pairs(_organisation_pairs(p_several, sides(donors)[1]).unionByName(_organisation_pairs(p, o_several)))

    rows = shared.unionByName(unclear).join(donors.select(F.col("donor_id").alias("member"), "total"), "member")
    sums = rows.groupBy("kind", "key").agg(F.sum("total").cast("decimal(18,2)").alias("dollars"))
    told = rows.join(sums, ["kind", "key"]).select("kind", "key", "member", "n", "dollars").unionByName(plain)
    return told.select(F.col("kind").alias("relationship"), F.col("key").alias("label"), F.col("member").alias("donor_id"), "n", "dollars")


def ranked(pairs: DataFrame, entities: DataFrame, organisations: Sequence[str]) -> DataFrame:
    """The pairs of near_duplicates() in order of confidence, then dollars at stake, with canonical: the row of more money
    (ties: the lower id). entities: id, name, type, total. A pair of organisations by name, acronym or subset is of
    high confidence; people of one name may be two, so theirs is for review. Money is that of all rows of both names."""
    e = entities.groupBy("type", "name").agg(F.min("id").alias("id"), F.sum("total").cast("decimal(18,2)").alias("money"))
    x, y = (e.select(F.col("id").alias(c), F.col("type").alias(f"t_{c}"), F.col("money").alias(f"m_{c}")) for c in ("a", "b"))
    j = pairs.join(x, "a").join(y, "b")
    high = F.col("t_a").isin(*organisations) & F.col("why").isin("same name", "acronym", "subset")
    confidence = F.when(high, "high").otherwise("review")
    out = j.select("a", "b", "why", "score", confidence.alias("confidence"), (F.col("m_a") + F.col("m_b")).cast("decimal(18,2)").alias("dollars"), F.when(F.col("m_b") > F.col("m_a"), F.col("b")).otherwise(F.col("a")).alias("canonical"))
    return out.orderBy(F.col("confidence") != "high", F.desc("dollars"), "a", "b")


def keyword_candidates(items: DataFrame, records: DataFrame, n: int = 5) -> DataFrame:
    """item_id, record_id, score, rank: records whose title has one of the item's keywords, by shared tokens, then
    divided votes, then year. items: item_id, keywords, tokens, year. records: record_id, tokens, divided, year."""
    spread = items.select("item_id", F.col("tokens").alias("it"), F.col("year").alias("iy"), F.explode("keywords").alias("w")).join(records.select("record_id", F.col("tokens").alias("rt"), "divided", F.col("year").alias("ry"), F.explode("tokens").alias("w")), "w")
    score = F.size(F.array_intersect("it", "rt")) + F.when(F.col("divided"), 5).otherwise(0) + F.when(F.col("iy") == F.col("ry"), 2).otherwise(0)
    scored = spread.select("item_id", "record_id", score.alias("score")).distinct()
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), "record_id"))).filter(F.col("rank") <= n)
