"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialise, text_or_empty

#: What the dynamic programme may have left to fit, in words; beyond it whole documents are taken first.
FIT_WORDS = 1 << 16
#: Rows of one length and source that one task ranks; larger groups are dealt by hash first.
RANK_ROWS = 20_000


def targets(per_source: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """source, source_size -> the same with weight and target.

    Sources in code-point order, null last, take the weights in turn and share the total of all
    sizes. A target stops at max_repeats times its source's size; the excess goes to the others by
    weight until none is above. That is filling to one level L: target = min(cap, L * weight), where
    L follows from the sources sorted by cap / weight. The windows here run over one row a source.
    """
    everything = Window.partitionBy()
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    numbered = per_source.withColumn("_turn", turn).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_turn") - 1) % len(weights) + 1).cast("int")))
    capped = numbered.withColumn("_cap", F.col("source_size").cast("double") * max_repeats).withColumn("_ratio", F.col("_cap") / F.col("weight"))
    before = Window.orderBy("_ratio", "_turn").rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        capped.withColumn("_spent", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_used", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("_level", (F.sum(F.col("source_size").cast("double")).over(everything) - F.col("_spent")) / (F.sum("weight").over(everything) - F.col("_used")))
        .withColumn("_fits", F.col("_level") <= F.col("_ratio"))
    )
    level = F.min(F.when(F.col("_fits"), F.struct("_ratio", "_turn", "_level"))).over(everything)["_level"]
    return levels.withColumn("target", F.least(F.col("_cap"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))).select("source", "source_size", "weight", "target")


def subset_sum(lengths: np.ndarray, copies: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take, at most copies, so that the sum is as near budget as it gets.

    Bounded knapsack: each length's copies are split into powers of two; first[s] is the part that
    first reached the sum s, so the way back takes every part once at most.
    """
    take = np.zeros(len(lengths), dtype=np.int64)
    usable = np.flatnonzero((copies > 0) & (lengths > 0))
    if budget <= 0 or not len(usable):
        return take
    # A sum beyond the budget matters only if it is nearer than nothing, and without any of its parts it is within.
    top = budget + min(budget, int(lengths[usable].max()))
    first = np.full(top + 1, -1, dtype=np.int32)
    reached = np.zeros(top + 1, dtype=bool)
    reached[0] = True
    parts: list[tuple[int, int, int]] = []
    for i in usable:
        size, left, k = int(lengths[i]), int(min(copies[i], top // lengths[i])), 1
        while left > 0:
            k = min(k, left)
            if (w := k * size) <= top:
                new = reached[:-w] & ~reached[w:]
                first[w:][new] = len(parts)
                reached[w:] |= new
                parts.append((int(i), k, w))
            left, k = left - k, k * 2
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at:
        i, k, w = parts[first[at]]
        take[i] += k
        at -= w
    return take


def fill(lengths: np.ndarray, counts: np.ndarray, budget: int, fit_words: int = FIT_WORDS) -> np.ndarray:
    """How many documents of each length to take for a budget of words.

    An even share of every length first, then whole documents from the longest down while more than
    fit_words is left, then the exact fit of what remains. Few documents may miss the budget that way; where
    it is at most fit_words, the fit without even shares is taken if it comes nearer.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), dtype=np.int64)
    if budget >= total:
        return counts.copy()
    take = np.minimum(counts, np.floor(counts * (budget / total)).astype(np.int64))
    left = budget - int((take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= fit_words:
            break
        if lengths[i] and (more := min(int(counts[i] - take[i]), left // int(lengths[i]))):
            take[i] += more
            left -= more * int(lengths[i])
    if left <= fit_words + int(lengths.max()):
        take += subset_sum(lengths, counts - take, left)
    miss = abs(budget - int((take * lengths).sum()))
    if miss and budget <= fit_words:
        free = subset_sum(lengths, counts, budget)
        if abs(budget - int((free * lengths).sum())) < miss:
            return free
    return take


def _plan_source(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rounds and extra documents for each length of one source; a row a length, whatever the documents."""
    pdf = pdf.sort_values("size").reset_index(drop=True)
    lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    total, target, most = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0]), int(pdf["most"].iloc[0])
    rounds = min(most, int(target // total)) if total else 0
    extra = fill(lengths, counts, int(round(target - rounds * total))) if rounds < most else np.zeros(len(lengths), dtype=np.int64)
    return pd.DataFrame({"source": pdf["source"], "size": lengths, "n": counts, "source_size": total, "target": target, "rounds": rounds, "extra": extra})


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: int = 3, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc (the whole row), size in words, source_size, target and repeats (0 to max_repeats).

    A null or empty text has size 0 and is taken as often as its source's full rounds; a null source
    is a source of its own. Rows of one id and size are taken alike. An empty table gives no rows.
    """
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).select("doc", F.regexp_count(text_or_empty(f"doc.`{text_col}`"), F.lit(WORD)).cast("long").alias("_size"), F.xxhash64(F.lit(seed), F.col(f"doc.`{id_col}`")).alias("_draw"))
    light = materialise(sized.select(F.col(f"doc.`{id_col}`").alias("id"), F.col(f"doc.`{source_col}`").alias("source"), F.col("_size").alias("size"), F.col("_draw").alias("draw")), "mix-sizes")
    histogram = light.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    per_source = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = targets(per_source, weights, max_repeats).withColumnRenamed("source", "_s")
    with_goal = histogram.join(goals, F.col("source").eqNullSafe(F.col("_s"))).select("source", "size", "n", "source_size", "target", F.lit(max_repeats).alias("most"))
    schema = "source string, size long, n long, source_size long, target double, rounds int, extra long"
    plan = materialise(with_goal.groupBy("source").applyInPandas(_plan_source, schema), "mix-plan")

    # The draw at which a length's quota ends. Lengths with many documents are dealt to parts by draw, so no task ranks them whole.
    partial = plan.filter("extra > 0 and extra < n").select(F.col("source").alias("ps"), F.col("size").alias("pz"), "extra", F.ceil(F.col("n") / RANK_ROWS).alias("parts"))
    part = F.pmod(F.shiftrightunsigned("draw", 7), F.col("parts"))
    drawn = light.join(partial, F.col("source").eqNullSafe(F.col("ps")) & (F.col("size") == F.col("pz"))).select("source", "size", "draw", "id", "extra", part.alias("part"))
    by_length = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    quota = (
        drawn.groupBy("source", "size", "part", "extra").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("quota", F.col("extra") - F.coalesce(F.sum("rows").over(by_length), F.lit(0)))
        .select(F.col("source").alias("qs"), F.col("size").alias("qz"), F.col("part").alias("qp"), "rows", "quota")
    )
    ranked = drawn.join(quota, F.col("source").eqNullSafe(F.col("qs")) & (F.col("size") == F.col("qz")) & (F.col("part") == F.col("qp")))
    ranked = ranked.filter("quota > 0").withColumn("rank", F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("draw", "id")))
    ends = ranked.filter("rank = least(quota, rows)").groupBy("source", "size").agg(F.map_from_entries(F.collect_list(F.struct("part", "draw"))).alias("ends")).select(F.col("source").alias("es"), F.col("size").alias("ez"), "ends")
    rules = plan.join(ends, F.col("source").eqNullSafe(F.col("es")) & (F.col("size") == F.col("ez")), "left").select(
        F.col("source").alias("_rs"), F.col("size").alias("_rz"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("rounds").alias("_rounds"), F.col("extra").alias("_extra"), F.col("n").alias("_n"), F.ceil(F.col("n") / RANK_ROWS).alias("_parts"), F.col("ends").alias("_ends")
    )
    rules = materialise(rules, "mix-rules")
    joined = sized.join(rules, F.col(f"doc.`{source_col}`").eqNullSafe(F.col("_rs")) & (F.col("_size") == F.col("_rz")))
    end = F.try_element_at("_ends", F.pmod(F.shiftrightunsigned("_draw", 7), F.col("_parts")))
    more = F.when(F.col("_extra") >= F.col("_n"), 1).when(F.col("_extra") <= 0, 0).otherwise(F.coalesce((F.col("_draw") <= end).cast("int"), F.lit(0)))
    return joined.select("doc", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_rounds") + more).cast("int").alias("repeats"))


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """docs as the mix takes them: a document taken twice is there twice. Columns stay as they are."""
    taken = mix(docs, **options).filter("repeats > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("copy"))
    return taken.select("doc.*")
