"""Who is who: families of donors, committees and their owners, people and their candidacies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.functions.money import total
from civicspark.functions.text import is_subset, kebab


def unique_only(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose keys occur once: an ambiguous key is never guessed."""
    return df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).filter("_n = 1").drop("_n")


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def resolve(df: DataFrame, key: str, sources: Sequence[tuple[str, DataFrame]], value: str, out: str) -> DataFrame:
    """df with the value of the first source that has its key, and that source's name in out_source.

    sources: (name, frame of key and value), in order of trust; keys are unique in each."""
    found, names = [], []
    for i, (name, frame) in enumerate(sources):
        df = df.join(frame.select(F.col(key), F.col(value).alias(f"_v{i}")), key, "left")
        found.append(F.col(f"_v{i}"))
        names.append(F.when(F.col(f"_v{i}").isNotNull(), name))
    return df.withColumn(out, F.coalesce(*found)).withColumn(f"{out}_source", F.coalesce(*names)).drop(*[f"_v{i}" for i in range(len(sources))])


def family_parent(donors: DataFrame, canonical: DataFrame) -> DataFrame:
    """donor_id, parent_id: the canonical donor of its family, else itself. canonical: cluster_id, canonical_id."""
    return donors.join(canonical, "cluster_id", "left").select("donor_id", "cluster_id", F.coalesce("canonical_id", "donor_id").alias("parent_id"))


def bridge_committees(donors: DataFrame, committees: DataFrame, name_key: Column) -> DataFrame:
    """donor_id, committee_id, via, collision: by filing id, else by normalised name. Of several committees of
    one name the last, by id, wins and is marked. donors: donor_id, name, filing_id. committees: committee_id, name."""
    by_name = committees.select(name_key.alias("_key"), "committee_id").groupBy("_key").agg(F.max("committee_id").alias("_named"), (F.count(F.lit(1)) > 1).alias("_many"))
    keyed = donors.withColumn("_key", name_key).join(by_name, "_key", "left").join(committees.select(F.col("committee_id").alias("_filed")), F.col("filing_id") == F.col("_filed"), "left")
    via = F.when(F.col("_filed").isNotNull(), "filing id").when(F.col("_named").isNotNull(), "name")
    return keyed.select("donor_id", F.coalesce("_filed", "_named").alias("committee_id"), via.alias("via"), F.coalesce(F.col("_filed").isNull() & F.col("_many"), F.lit(False)).alias("collision")).filter("committee_id IS NOT NULL")


def owning_candidacy(candidacies: DataFrame) -> DataFrame:
    """committee_id, candidate_id, race_id: of the candidacies that claim a committee the one with the latest
    election, ties by ord. candidacies: committee_id, candidate_id, race_id, election_date, ord."""
    return first_per(candidacies.filter("committee_id IS NOT NULL"), ["committee_id"], [F.col("election_date").desc_nulls_last(), F.col("ord")]).select("committee_id", "candidate_id", "race_id")


def link_committees(committees: DataFrame, owners: DataFrame) -> DataFrame:
    """committees with their owner's candidacy and race; a spender's record is never linked."""
    o = owners.select("committee_id", F.col("candidate_id").alias("_c"), F.col("race_id").alias("_r"))
    spender = F.col("type") == "independent_expenditure"
    return committees.join(o, "committee_id", "left").withColumn("candidate_id", F.when(~spender, F.col("_c"))).withColumn("race_id", F.when(~spender, F.col("_r"))).drop("_c", "_r")


def stamp_pairs(facts: DataFrame, pairs: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """facts with a boolean: its keys are on a closed list of pairs."""
    listed = pairs.select(*keys).distinct().withColumn("_listed", F.lit(True))
    return facts.join(listed, list(keys), "left").withColumn(out, F.coalesce("_listed", F.lit(False))).drop("_listed")


def self_funding(df: DataFrame, donor: str, candidate: str) -> Column:
    """The donor's name is the candidate's: families overlap and a canonical given name is shared; a name
    without a comma counts when one side's tokens all are the other's. donor, candidate: structs of
    family and given token arrays."""
    d, c = F.col(donor), F.col(candidate)
    share = F.arrays_overlap(d["family"], c["family"]) & F.arrays_overlap(d["given"], c["given"])
    every = lambda s: F.array_union(s["family"], s["given"])
    whole = (F.size(every(d)) >= 2) & (is_subset(every(d), every(c)) | is_subset(every(c), every(d)))
    return F.coalesce(share | whole, F.lit(False))


def family_rollup(members: DataFrame, sums: DataFrame, least: int = 2) -> DataFrame:
    """cluster_id, donor_id, role, amount, family_total, is_parent. Members without a donor are dropped, and so are
    families of fewer than least; the parent is the listed one if present, else the first by ord.

    members: cluster_id, donor_id, ord, canonical_id. sums: donor_id, amount (every known donor)."""
    known = members.join(sums, "donor_id")
    w = Window.partitionBy("cluster_id")
    sized = known.withColumn("size", F.count(F.lit(1)).over(w)).filter(F.col("size") >= least)
    listed = F.max(F.when(F.col("donor_id") == F.col("canonical_id"), F.col("donor_id"))).over(w)
    first = F.min(F.struct("ord", "donor_id")).over(w)["donor_id"]
    out = sized.withColumn("parent", F.coalesce(listed, first)).withColumn("family_total", F.sum("amount").over(w).cast("decimal(18,2)"))
    return out.select("cluster_id", "donor_id", F.when(F.col("donor_id") == F.col("parent"), "parent").otherwise("alt-name").alias("role"), "amount", "family_total")


def repair_families(members: DataFrame, present: DataFrame) -> DataFrame:
    """cluster_id, action, parent_id, members: after a reload a family is kept, re-parented to its first present
    member, dissolved (one left) or pruned (none). members: cluster_id, donor_id, ord, is_parent."""
    p = members.join(present.select("donor_id").distinct().withColumn("here", F.lit(True)), "donor_id", "left")
    here = F.coalesce("here", F.lit(False))
    g = p.groupBy("cluster_id").agg(F.count_if(here).alias("members"), F.min_by(F.when(here, F.col("donor_id")), F.when(here, F.struct("ord", "donor_id"))).alias("first"), F.max(F.when(here & F.col("is_parent"), F.col("donor_id"))).alias("parent"))
    action = F.when(F.col("members") == 0, "prune").when(F.col("members") == 1, "dissolve").when(F.col("parent").isNotNull(), "keep").otherwise("re-parent")
    return g.select("cluster_id", action.alias("action"), F.when(F.col("members") >= 2, F.coalesce("parent", "first")).alias("parent_id"), "members")


def apply_overrides(donors: DataFrame, overrides: DataFrame) -> DataFrame:
    """donors with editors' values: the primary industry leads, additions follow once each, other fields only
    where given. donors: donor_id, industries, notes. overrides: donor_id, primary_industry, additional, notes."""
    o = overrides.select("donor_id", "primary_industry", "additional", F.col("notes").alias("_notes"))
    j = donors.join(o, "donor_id", "left")
    base = F.when(F.col("primary_industry").isNotNull(), F.array("primary_industry")).otherwise(F.col("industries"))
    merged = F.array_distinct(F.concat(base, F.coalesce("additional", F.array().cast("array<string>"))))
    return j.select("donor_id", merged.alias("industries"), F.coalesce("_notes", "notes").alias("notes"))


def unknown_ids(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return rows.join(known.select(key), key, "left_anti")


def reingest(old: DataFrame, new: DataFrame) -> DataFrame:
    """Donors of two loads: the new facts win, editors' fields stay; a bare "unclassified" takes the new class.
    donor_id, name, industries, notes."""
    o, n = old.select(*[F.col(c).alias(f"o_{c}") for c in ("donor_id", "name", "industries", "notes")]), new.select(*[F.col(c).alias(f"n_{c}") for c in ("donor_id", "name", "industries")])
    j = o.join(n, F.col("o_donor_id") == F.col("n_donor_id"), "full_outer")
    bare = F.col("o_industries").isNull() | (F.col("o_industries") == F.array(F.lit("unclassified")))
    state = F.when(F.col("o_donor_id").isNull(), "new").when(F.col("n_donor_id").isNull(), "kept").otherwise("updated")
    return j.select(F.coalesce("n_donor_id", "o_donor_id").alias("donor_id"), F.coalesce("n_name", "o_name").alias("name"), F.when(bare, F.coalesce("n_industries", "o_industries")).otherwise(F.col("o_industries")).alias("industries"), F.col("o_notes").alias("notes"), state.alias("state"))


def sorted_token_alias(ids: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """id, hits, alias: ids that aren't known but are the same tokens in another order as known ones; one hit
    is an alias, more are left to people. Ids of one token are skipped."""
    tokens = F.array_join(F.array_sort(F.split(key, "-")), "-")
    missing = ids.select(key).distinct().join(known.select(key), key, "left_anti").filter(F.contains(F.col(key), F.lit("-"))).withColumn("_k", tokens)
    hits = known.select(tokens.alias("_k"), F.col(key).alias("_id")).groupBy("_k").agg(F.count(F.lit(1)).alias("hits"), F.min("_id").alias("_id"))
    return missing.join(hits, "_k").select(key, "hits", F.when(F.col("hits") == 1, F.col("_id")).alias("alias"))


def inverted(pairs: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    """The map the other way round, and the keys on either side that aren't one to one."""
    bad = None
    for side in (a, b):
        many = pairs.groupBy(side).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.lit(side).alias("side"), F.col(side).cast("string").alias("key"), "n")
        bad = many if bad is None else bad.unionByName(many)
    return pairs.select(b, a), bad


def get_or_create(names: DataFrame, known: DataFrame, order: str) -> DataFrame:
    """name, key, is_new: the known key of a name, else a slug; slugs that clash with each other or with a known key
    take -2, -3 and so on, in order. known: name, key."""
    found = names.join(known, "name", "left")
    new = found.filter("key IS NULL").withColumn("slug", kebab(F.col("name")))
    taken = known.select(F.col("key").alias("slug"), F.lit(1).alias("taken")).distinct()
    numbered = new.join(taken, "slug", "left").withColumn("i", F.row_number().over(Window.partitionBy("slug").orderBy(order)) + F.coalesce("taken", F.lit(0)))
    minted = numbered.select("name", F.when(F.col("i") == 1, F.col("slug")).otherwise(F.concat("slug", F.lit("-"), F.col("i").cast("string"))).alias("key"), F.lit(True).alias("is_new"))
    return found.filter("key IS NOT NULL").select("name", "key", F.lit(False).alias("is_new")).unionByName(minted)


def merge_parents(a: DataFrame, b: DataFrame) -> DataFrame:
    """donor_id, parent_id, conflict over two sets of families: grouping wins over standing alone, the first set over
    the second where both group; two different groupings are a conflict. donor_id, parent_id."""
    j = a.select("donor_id", F.col("parent_id").alias("pa")).join(b.select("donor_id", F.col("parent_id").alias("pb")), "donor_id", "full_outer")
    ga, gb = F.col("pa") != F.col("donor_id"), F.col("pb") != F.col("donor_id")
    parent = F.when(F.coalesce(ga, F.lit(False)), F.col("pa")).when(F.coalesce(gb, F.lit(False)), F.col("pb")).otherwise(F.coalesce("pa", "pb"))
    return j.select("donor_id", parent.alias("parent_id"), F.coalesce(ga & gb & (F.col("pa") != F.col("pb")), F.lit(False)).alias("conflict"))


def prune_unused(dimension: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    return dimension.join(facts.select(key).distinct(), key, "left_semi")


def replace_partition(fact: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """fact with all rows of new's keys replaced by new: a reload that can be repeated."""
    return fact.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def families_from_members(rows: DataFrame) -> DataFrame:
    """cluster_id, name, members, canonical, conflict: first-seen name, members in order, and whether rows disagree
    about the canonical member. rows: cluster_id, cluster_name, donor_id, canonical_id, ord."""
    return rows.groupBy("cluster_id").agg(
        F.min_by("cluster_name", "ord").alias("name"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "donor_id"))), lambda x: x["donor_id"].cast("string")), ",").alias("members"),
        F.min_by("canonical_id", "ord").alias("canonical"),
        (F.countDistinct("canonical_id") > 1).alias("conflict"),
    )


def parent_first(members: Column, parent: Column) -> Column:
    return F.concat(F.array(parent), F.array_remove(members, parent))


def second_hop(links: DataFrame, funders: DataFrame, n: int = 3) -> DataFrame:
    """candidate_id, spender_id, spent, donor_id, given, rank: who spends on a candidate, and each spender's n largest
    funders. links: candidate_id, spender_id, amount. funders: spender_id, donor_id, amount."""
    spent = links.groupBy("candidate_id", "spender_id").agg(total(F.col("amount")).alias("spent"))
    given = funders.groupBy("spender_id", "donor_id").agg(total(F.col("amount")).alias("given"))
    top = given.withColumn("rank", F.row_number().over(Window.partitionBy("spender_id").orderBy(F.col("given").desc(), "donor_id"))).filter(F.col("rank") <= n)
    return spent.join(top, "spender_id", "left")
