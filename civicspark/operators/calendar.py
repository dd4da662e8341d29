"""Dates to cycles, election windows and filed periods: interval joins against small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that a table of cycles or windows may have; they are broadcast.
MOST_INTERVALS = 10_000
#: Cycles up to which a date's is said by one CASE; beyond it they are joined.
CASES = 64


def small(intervals: DataFrame) -> DataFrame:
    """The table, marked for broadcast once its size is checked."""
    if (n := intervals.limit(MOST_INTERVALS + 1).count()) > MOST_INTERVALS:
        raise ValueError(f"{n} intervals or more: not a table of cycles or windows")
    return F.broadcast(intervals)


def contains(date: Column, start: Column, end: Column) -> Column:
    """start <= date <= end where a null bound is open; null for a null date."""
    return F.coalesce(date >= start, F.when(date.isNotNull(), True)) & F.coalesce(date <= end, F.when(date.isNotNull(), True))


def with_cycle(facts: DataFrame, cycles: DataFrame, date: str = "date", out: str = "cycle", before: str | None = "pre-2011", after: str | None = None, gap: str | None = None, null: str | None = "undated") -> DataFrame:
    """facts with the code of the cycle that its date falls in.

    before, gap and after name the cycle of dates outside all of them ("last" means the last cycle's
    code), null that of rows without a date. cycles: code, start_date, end_date; they don't overlap, see
    overlapping_intervals(). They are read once, on the driver."""
    listed = cycles.select("code", "start_date", "end_date").orderBy("start_date").limit(MOST_INTERVALS + 1).collect()
    if len(listed) > MOST_INTERVALS:
        raise ValueError(f"over {MOST_INTERVALS} intervals: not a table of cycles")
    first, end, last = (listed[0]["start_date"], max(c["end_date"] for c in listed), listed[-1]["code"]) if listed else (None, None, None)
    named = lambda v: F.lit(last if v == "last" else v).cast("string")
    d, code = F.col(date), F.col("_code")
    if len(listed) <= CASES:
        within = F.lit(None).cast("string")
        for c in reversed(listed):
            within = F.when((d >= F.lit(c["start_date"])) & (d <= F.lit(c["end_date"])), c["code"]).otherwise(within)
        joined = facts.withColumn("_code", within)
    else:
        c = F.broadcast(cycles.select(F.col("code").alias("_code"), F.col("start_date").alias("_start"), F.col("end_date").alias("_end")))
        joined = facts.join(c, (d >= F.col("_start")) & (d <= F.col("_end")), "left").drop("_start", "_end")
    value = F.when(d.isNull(), named(null)).when(code.isNotNull(), code).when(d < F.lit(first), named(before)).when(d > F.lit(end), named(after)).otherwise(named(gap))
    return joined.withColumn(out, value).drop("_code")


def with_window(facts: DataFrame, windows: DataFrame, date: str = "date", office_type: str = "office_type", out: str = "window_id") -> DataFrame:
    """facts with the first window, by ord, of its office type that holds its date; null where none does.

    The windows of an office type may overlap: each row is matched to the least of them by ord, by
    keeping the row whole through an aggregate-free rule. windows: office_type, window_id, start_date, end_date, ord."""
    kinds = Window.partitionBy("office_type")
    w = windows.select("office_type", F.struct("ord", "window_id", "start_date", "end_date").alias("w")).withColumn("all", F.array_sort(F.collect_list("w").over(kinds))).select(F.col("office_type").alias("_kind"), F.col("all").alias("_all")).distinct()
    joined = facts.join(small(w), F.col(office_type) == F.col("_kind"), "left")
    first = F.try_element_at(F.filter("_all", lambda x: contains(F.col(date), x["start_date"], x["end_date"])), F.lit(1))
    return joined.withColumn(out, first["window_id"]).drop("_kind", "_all")


def leading_periods(periods: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The periods of each key that are the first, by beg, then fin, for some day; of equal ones that of the least columns.

    A period that ends no later than one before it in that order is never first, so each that stays ends on a day of
    its own: there are no more than days, however many were filed. Null ends are open."""
    rest = [c for c in columns if c not in ("beg", "fin")]
    one = periods.groupBy(*keys, "beg", "fin").agg(F.min(F.struct(*rest)).alias("_rest")) if rest else periods.select(*keys, "beg", "fin").distinct()
    end = F.coalesce("fin", F.lit("9999-12-31").cast("date"))
    earlier = Window.partitionBy(*keys).orderBy(F.col("beg").asc_nulls_first(), end).rowsBetween(Window.unboundedPreceding, -1)
    kept = one.withColumn("_upto", F.max(end).over(earlier)).filter(F.col("_upto").isNull() | (end > F.col("_upto")))
    return kept.select(*keys, "beg", "fin", *[F.col(f"_rest.{c}").alias(c) for c in rest])


def first_period(facts: DataFrame, periods: DataFrame, keys: list[str], date: str, columns: list[str]) -> DataFrame:
    """facts with columns of the first period, by beg, then fin, of its keys that holds its date; null where none does.

    periods: keys, beg, fin, columns. Those that lead on some day are gathered by key (no more than there are days), so
    a fact joins one row and no fact is multiplied."""
    inner = list(dict.fromkeys(["beg", "fin", *columns]))
    lead = leading_periods(periods, keys, inner)
    # Each that leads has a beginning or an end of its own; an open end comes after all others.
    ordered = F.array_sort(F.collect_list(F.struct("beg", F.coalesce("fin", F.lit("9999-12-31").cast("date")).alias("end"), F.struct(*inner).alias("p"))))
    listed = lead.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.transform(ordered, lambda x: x["p"]).alias("_periods"))
    joined = facts.join(listed, [F.col(k) == F.col(f"_{k}") for k in keys], "left")
    hit = F.try_element_at(F.filter("_periods", lambda p: contains(F.col(date), p["beg"], p["fin"])), F.lit(1))
    return joined.withColumn("_hit", hit).select(*facts.columns, *[F.col(f"_hit.{c}").alias(c if c not in facts.columns else f"period_{c}") for c in columns])


def window_union(windows: DataFrame, key: str = "office_type") -> DataFrame:
    """The span of all windows of an office type; an open end stays open."""
    return windows.groupBy(key).agg(
        F.when(~F.bool_or(F.col("start_date").isNull()), F.min("start_date")).alias("start_date"),
        F.when(~F.bool_or(F.col("end_date").isNull()), F.max("end_date")).alias("end_date"),
    )


def overlapping_intervals(cycles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Neighbours that overlap, in order of their start, in each group of keys; empty for a sound table. Without keys the
    table is one group, in one task: a table of cycles."""
    w = Window.partitionBy(*keys).orderBy("start_date", "code")
    neighbours = cycles.withColumn("previous", F.lag("code").over(w)).withColumn("previous_end", F.lag("end_date").over(w))
    return neighbours.filter("start_date <= previous_end").select(*keys, "previous", "code", "previous_end", "start_date")


def interval_labels(intervals: DataFrame, key: str) -> DataFrame:
    """intervals with label ("code (first day to last)", dots for an open end) and current: the code that starts last in its
    group of key, ties by code."""
    day = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("..."))
    last = intervals.groupBy(key).agg(F.max_by("code", F.struct("start_date", "code")).alias("current"))
    label = F.concat(F.col("code").cast("string"), F.lit(" ("), day("start_date"), F.lit(" to "), day("end_date"), F.lit(")"))
    return intervals.withColumn("label", label).join(last, key)


def active_in(start: Column, end: Column, term_start: Column, term_end: Column) -> Column:
    """A membership overlaps a term; null ends are open."""
    return F.coalesce(start <= term_end, F.lit(True)) & F.coalesce(end >= term_start, F.lit(True))
