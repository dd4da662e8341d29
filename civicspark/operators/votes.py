"""Roll calls: wide grids to positions, voters to seats at a date, tallies and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.functions.money import vote_position, vote_record


def unpivot_votes(grid: DataFrame, id_cols: Sequence[str], vocabulary: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Positions (id_cols, seat, position) of a grid with a column a seat, blank as "-"; and the cells outside the vocabulary."""
    seats = [c for c in grid.columns if c not in id_cols]
    long = grid.unpivot(list(id_cols), seats, "seat", "position").withColumn("position", F.coalesce(F.nullif(F.trim("position"), F.lit("")), F.lit("-")))
    known = F.col("position").isin("-", *vocabulary)
    return long.filter(known), long.filter(~known)


def divided_votes(person_votes: DataFrame) -> DataFrame:
    """vote_id of events with a no or an abstention."""
    return person_votes.filter(F.col("option").isin("no", "abstain")).select("vote_id").distinct()


def seat_at(votes: DataFrame, stints: DataFrame) -> DataFrame:
    """votes with the seat of the voter at the vote's date and whether it is a fallback: the only stint; else of the
    stints active then the latest to start; else of all stints the latest to start.

    A person's stints (a few) are gathered, so votes join one row each. stints: person_id, seat, start_date, end_date."""
    listed = stints.groupBy("person_id").agg(F.array_sort(F.collect_list(F.struct("start_date", "seat", "end_date"))).alias("s"))
    j = votes.join(listed, F.col("voter_id") == F.col("person_id"), "left")
    active = F.filter("s", lambda x: F.coalesce(x["start_date"] <= F.col("date"), F.lit(True)) & F.coalesce(x["end_date"] >= F.col("date"), F.lit(True)))
    chosen = F.when(F.size("s") == 1, F.element_at("s", 1)).when(F.size(active) > 0, F.try_element_at(active, F.lit(-1))).otherwise(F.try_element_at("s", F.lit(-1)))
    fallback = (F.size("s") > 1) & (F.size(active) == 0)
    return j.select(*[F.col(f"`{c}`") for c in votes.columns], chosen["seat"].alias("seat"), F.coalesce(fallback, F.lit(False)).alias("fallback"))


def fill_voter_ids(votes: DataFrame, people: DataFrame) -> DataFrame:
    """Null voter ids by exact name, where one person only has that name. people: person_id, name."""
    unique = people.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("person_id").alias("_id")).filter("n = 1").select(F.col("name").alias("_name"), "_id")
    return votes.join(unique, F.col("voter_name") == F.col("_name"), "left").withColumn("voter_id", F.coalesce("voter_id", "_id")).drop("_name", "_id")


def tallies(votes: DataFrame) -> DataFrame:
    """vote_id, tally (map), positions (map of seat to record), unresolved (votes without a seat)."""
    g = votes.groupBy("vote_id", "option").agg(F.count(F.lit(1)).alias("n")).groupBy("vote_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("option", "n")))).alias("tally"))
    seats = votes.filter("seat IS NOT NULL").groupBy("vote_id", "seat").agg(F.max_by("option", "event_id").alias("option"))
    positions = seats.groupBy("vote_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("seat").cast("string").alias("seat"), vote_record(F.col("option")).alias("record"))))).alias("positions"))
    lost = votes.groupBy("vote_id").agg(F.count_if(F.col("seat").isNull()).alias("unresolved"))
    return g.join(positions, "vote_id", "left").join(lost, "vote_id", "left")


def semantic_positions(votes: DataFrame, featured: DataFrame) -> DataFrame:
    """vote_id, position, n of featured votes."""
    return votes.join(featured.select("vote_id"), "vote_id", "left_semi").groupBy("vote_id", vote_position(F.col("option")).alias("position")).agg(F.count(F.lit(1)).alias("n"))


def prune_positions(positions: DataFrame, featured: DataFrame, key: str = "vote_id") -> tuple[DataFrame, DataFrame]:
    """Positions of featured votes, and those of votes no longer featured."""
    f = featured.select(key).distinct()
    return positions.join(f, key, "left_semi"), positions.join(f, key, "left_anti")


def first_by_code(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("_n = 1").drop("_n")


def vote_profile(votes: DataFrame) -> DataFrame:
    """month, events, divided, and events by how many voted: under 10, 10 to 24, 25 and more."""
    per = votes.groupBy(F.date_format("date", "yyyy-MM").alias("month"), "vote_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("option").isin("no", "abstain")).alias("d"))
    return per.groupBy("month").agg(F.count(F.lit(1)).alias("events"), F.count_if("d").alias("divided"), F.count_if(F.col("n") < 10).alias("few"), F.count_if((F.col("n") >= 10) & (F.col("n") < 25)).alias("some"), F.count_if(F.col("n") >= 25).alias("many"))


def membership_profile(stints: DataFrame) -> DataFrame:
    """seat, holders, successions, open: how often a seat changed hands, and stints without an end."""
    return stints.groupBy("seat").agg(F.countDistinct("person_id").alias("holders"), (F.count(F.lit(1)) - 1).alias("successions"), F.count_if(F.col("end_date").isNull()).alias("open"))


def unresolved_voters(votes: DataFrame, people: DataFrame) -> DataFrame:
    return votes.select("voter_id").distinct().join(people.select(F.col("person_id").alias("voter_id")), "voter_id", "left_anti")


def cast_by_violations(cast_by: DataFrame, votes: DataFrame, positions: DataFrame) -> DataFrame:
    """vote_id, seat, violation of attributions: unknown vote, unknown seat of it, blank position, blank name, repeated."""
    w = Window.partitionBy("vote_id", "seat")
    c = cast_by.withColumn("n", F.count(F.lit(1)).over(w)).join(votes.select("vote_id").distinct().withColumn("v", F.lit(True)), "vote_id", "left")
    c = c.join(positions.select("vote_id", "seat", "position").withColumn("p", F.lit(True)), ["vote_id", "seat"], "left")
    rules = F.array(
        F.when(F.col("v").isNull(), "unknown vote"),
        F.when(F.col("v") & F.col("p").isNull(), "unknown seat"),
        F.when(F.col("p") & (F.col("position") == "-"), "blank position"),
        F.when(F.coalesce(F.trim("cast_by_name"), F.lit("")) == "", "blank name"),
        F.when(F.col("n") > 1, "repeated"),
    )
    return c.select("vote_id", "seat", F.explode(F.array_compact(rules)).alias("violation")).distinct()
