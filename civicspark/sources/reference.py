"""Editor-maintained reference tables, read strictly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.functions.text import blank_to_null


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1), text of every line, without its carriage return.

    Files are split as ever: lines are numbered inside their block, and what earlier blocks of the file hold is added
    from a table of one row a block."""
    text = spark.read.option("lineSep", "\n").text(path)
    at = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), F.regexp_replace("value", "\r$", "").alias("text"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = at.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n")).select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("file", "block").orderBy("pos"))
    return at.withColumn("i", inside).join(blocks, ["file", "block"]).select("file", (F.col("before") + F.col("i")).alias("line"), "text")


def load_reference(spark: SparkSession, path: str, header: Sequence[str], key: Sequence[str], vocabulary: dict[str, Sequence[str]] | None = None, known: dict[str, DataFrame] | None = None, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """Rows of text tables and violations (file, line, violation) that name the line.

    Lines that begin with # and blank lines are comments. The first other line of each file must be the header. Checked
    are the width, edge spaces, blank keys, vocabularies, repeated keys, and ids that must be known."""
    lines = numbered_lines(spark, path).filter((F.trim("text") != "") & ~F.col("text").startswith("#"))
    first = lines.groupBy("file").agg(F.min(F.struct("line", "text")).alias("h")).select("file", F.col("h.line").alias("head"), F.col("h.text").alias("found"))
    wrong = first.filter(F.col("found") != sep.join(header)).limit(3).collect()
    if wrong or first.isEmpty():
        raise ValueError(f"{path}: the header is not {sep.join(header)!r}: {[(r.file, r.found) for r in wrong] or 'no lines'}")
    cells = lines.join(first.select("file", "head"), "file").filter("line > head").withColumn("cells", F.split("text", sep))
    wide = cells.filter(F.size("cells") == len(header)).select("file", "line", *[F.element_at("cells", i + 1).alias(c) for i, c in enumerate(header)])
    # The rules of a row in one pass: an array of those that it breaks.
    rules = [(F.concat(F.size("cells").cast("string"), F.lit(f" cells, not {len(header)}")), F.size("cells") != len(header))]
    cell = {c: F.when(F.size("cells") == len(header), F.get("cells", F.lit(i))) for i, c in enumerate(header)}
    rules += [(F.lit(f"{c} has edge spaces"), cell[c] != F.trim(cell[c])) for c in header]
    rules += [(F.lit(f"{c} is blank"), F.trim(cell[c]) == "") for c in key]
    rules += [(F.lit(f"{c} is not in its vocabulary"), ~cell[c].isin(*allowed)) for c, allowed in (vocabulary or {}).items()]
    bad = cells.select("file", "line", F.explode(F.array_compact(F.array(*[F.when(broken, what) for what, broken in rules]))).alias("violation"))
    repeated = wide.groupBy(*key).agg(F.count(F.lit(1)).alias("c"), F.max(F.struct("file", "line")).alias("at")).filter("c > 1")
    bad = bad.unionAll(repeated.select("at.file", "at.line", F.lit("the key appears twice")))
    for c, frame in (known or {}).items():
        ids = frame.select(F.col(frame.columns[0]).cast("string").alias(c)).distinct()
        bad = bad.unionAll(wide.join(ids, c, "left_anti").select("file", "line", F.lit(f"{c} is unknown")))
    return wide.drop("file", "line"), bad


def file_headers(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """file, header (array): the first line of every file, before any schema is bound to it."""
    text = spark.read.option("lineSep", "\n").text(path)
    at = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), "value")
    first = at.filter("block = 0").groupBy("file").agg(F.min_by("value", "pos").alias("value"))
    return first.select("file", F.split(F.regexp_replace("value", "\r$", ""), sep).alias("header"))


def header_faults(headers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """file, fault: columns that a file's header lacks, has besides, has twice, or has in another order."""
    want = F.array(*map(F.lit, columns))
    told = lambda what, names: F.when(F.size(names) > 0, F.concat(F.lit(f"{what} "), F.array_join(F.array_sort(names), ",")))
    twice = F.array_distinct(F.filter("header", lambda c: F.size(F.filter("header", lambda d: d == c)) > 1))
    same = F.array_sort("header") == F.array_sort(want)
    faults = F.array_compact(F.array(told("missing", F.array_except(want, "header")), told("unknown", F.array_except("header", want)), told("twice", twice), F.when(same & (F.col("header") != want), "another order")))
    return headers.select("file", F.explode(faults).alias("fault"))


def wide_header_faults(headers: DataFrame, fixed: Sequence[str], keys: DataFrame, trailing: Sequence[str]) -> DataFrame:
    """file, fault: the fixed columns come first, the trailing ones last, and between them one for each key, in any order.
    keys: key, a table of its own; a file joins it once, by an array of it."""
    n, m = len(fixed), len(trailing)
    every = keys.agg(F.array_sort(F.collect_set("key")).alias("keys"))
    rows = headers.join(F.broadcast(every), F.lit(True)) if keys.limit(10_001).count() <= 10_000 else headers.join(every, F.lit(True))
    size = F.size("header")
    middle = F.slice("header", F.lit(n + 1), F.greatest(size - n - m, F.lit(0)))
    told = lambda what, names: F.when(F.size(names) > 0, F.concat(F.lit(f"{what} "), F.array_join(F.array_sort(names), ",")))
    first = F.slice("header", F.lit(1), F.lit(n)) != F.array(*map(F.lit, fixed)) if n else F.lit(False)
    last = F.slice("header", F.greatest(size - m + 1, F.lit(1)), F.lit(m)) != F.array(*map(F.lit, trailing)) if m else F.lit(False)
    faults = F.array_compact(F.array(F.when(first, "fixed columns"), F.when(last, "trailing columns"), told("seat missing", F.array_except("keys", middle)), told("seat unknown", F.array_except(middle, "keys"))))
    return rows.select("file", F.explode(faults).alias("fault"))


def read_overrides(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Editors' rows with an id; blank cells are null, and so is a column that isn't there."""
    cells = [blank_to_null(F.col(c)).alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    return df.select(blank_to_null(F.col(key)).alias(key), *cells).filter(F.col(key).isNotNull())


def merge_vocab(base: DataFrame, tab: DataFrame, starters: dict[str, str]) -> DataFrame:
    """key, label: a later tab updates the base where it has a label; fixed starters win for their keys."""
    j = base.select("key", F.col("label").alias("_b")).join(tab.select("key", F.col("label").alias("_t")), "key", "full_outer")
    fixed = base.sparkSession.createDataFrame(list(starters.items()), "key string, label string")
    merged = j.select("key", F.coalesce("_t", "_b").alias("label"))
    return merged.join(fixed.select("key"), "key", "left_anti").unionByName(fixed)


def read_roster(df: DataFrame, seat: str) -> DataFrame:
    """Rows whose seat is a whole number; blank cells are null."""
    cells = [F.col(c).try_cast("int").alias(c) if c == seat else blank_to_null(F.col(c)).alias(c) for c in df.columns]
    return df.select(*cells).filter(F.col(seat).isNotNull())


def require_header(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    if df.columns != list(columns):
        raise ValueError(f"the header is {df.columns}, not {list(columns)}")
    return df


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with columns there; others may be beside them."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns {missing} are missing")
    return df


def require_wide_header(df: DataFrame, fixed: Sequence[str], keys: Sequence[str], trailing: Sequence[str]) -> DataFrame:
    """Fixed columns, then one for each key in any order, then trailing ones."""
    n, m = len(fixed), len(df.columns) - len(trailing)
    middle = df.columns[n:m]
    if df.columns[:n] != list(fixed) or df.columns[m:] != list(trailing):
        raise ValueError("the fixed or trailing columns are not as they should be")
    if sorted(middle) != sorted(keys):
        raise ValueError(f"seats missing {sorted(set(keys) - set(middle))}, unknown {sorted(set(middle) - set(keys))}")
    return df


def resolve_columns(df: DataFrame, candidates: dict[str, Sequence[str]]) -> DataFrame:
    """df with standard names: of each name's candidates the first that is there, whatever its case."""
    there = {c.lower(): c for c in df.columns}
    out = []
    for name, options in candidates.items():
        found = next((there[o.lower()] for o in options if o.lower() in there), None)
        if found is None:
            raise ValueError(f"none of {list(options)} is a column: {df.columns}")
        out.append(F.col(f"`{found}`").alias(name))
    return df.select(*out)


def read_selection(df: DataFrame) -> DataFrame:
    """Committees to follow, with the ward of a "ward-N" scope."""
    ward = F.nullif(F.regexp_extract("office_scope", "^ward-([0-9]+)$", 1), F.lit("")).cast("int")
    return df.filter(blank_to_null(F.col("committee_id")).isNotNull()).withColumn("ward", ward)


def races_from_features(spark: SparkSession, path: str | None, prefix: str, count: int) -> DataFrame:
    """race_id, district of a boundary file's features; without one, count races in a row."""
    if path is None:
        return spark.range(1, count + 1).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("race_id"), F.col("id").cast("string").alias("district"))
    doc = spark.read.text(path, wholetext=True)
    features = doc.select(F.explode(F.from_json("value", "features array<struct<properties:map<string,string>>>")["features"]).alias("f"))
    district = F.coalesce(F.try_element_at("f.properties", F.lit("district")), F.try_element_at("f.properties", F.lit("name")))
    return features.select(F.concat(F.lit(prefix), F.lower(F.regexp_replace(district, "[^A-Za-z0-9]+", ""))).alias("race_id"), district.alias("district"))


def explode_map(df: DataFrame, column: str, value_schema: str, key: str) -> DataFrame:
    """Rows of a JSON document's map: its keys in a column of their own."""
    return df.select(F.explode(F.from_json(column, f"map<string,{value_schema}>")).alias(key, "v")).select(key, "v.*")
