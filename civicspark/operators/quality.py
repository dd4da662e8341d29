"""Data-quality rules as jobs: each gives violations (rule, severity, key, detail); a run is their union."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType
from pyspark.sql.window import Window

ERROR, WARNING = "error", "warning"


def violations(df: DataFrame, rule: str, key: Column, detail: Column | str = "", severity: str = ERROR) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), key.cast("string").alias("key"), (F.lit(detail) if isinstance(detail, str) else detail.cast("string")).alias("detail"))


def row_rules(df: DataFrame, key: str, rules: dict[str, Column], severity: str = ERROR) -> DataFrame:
    """Every rule that a row breaks (its condition is true), in one pass over the table."""
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), name) for name, c in rules.items()]))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(broken).alias("rule")).select("rule", F.lit(severity).alias("severity"), "key", F.lit("").alias("detail"))


def not_unique(df: DataFrame, rule: str, keys: Sequence[str], severity: str = ERROR) -> DataFrame:
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return violations(g, rule, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.col("n"), severity)


def unresolved(df: DataFrame, key: str, known: DataFrame, known_key: str, rule: str, severity: str = ERROR) -> DataFrame:
    lost = df.filter(F.col(key).isNotNull()).select(key).distinct().join(known.select(F.col(known_key).alias(key)).distinct(), key, "left_anti")
    return violations(lost, rule, F.col(key), "", severity)


def equal_sums(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, rule: str, severity: str = ERROR) -> DataFrame:
    """Keys whose sums differ between two tables: a recount on another path."""
    s = lambda df, out: df.groupBy(*keys).agg(F.sum(value).cast("decimal(18,2)").alias(out))
    j = s(a, "x").join(s(b, "y"), list(keys), "full_outer").filter(~F.coalesce("x", F.lit(0)).eqNullSafe(F.coalesce("y", F.lit(0))))
    return violations(j, rule, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.concat_ws(" vs ", F.coalesce(F.col("x").cast("string"), F.lit("none")), F.coalesce(F.col("y").cast("string"), F.lit("none"))), severity)


def family_rules(donors: DataFrame) -> DataFrame:
    """Families of two or more, with one parent that is a member, each donor in one. donors: donor_id, cluster_id, parent_id."""
    m = donors.filter("cluster_id IS NOT NULL")
    g = m.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("parent_id").alias("parents"), F.count_if(F.col("donor_id") == F.col("parent_id")).alias("own"))
    return row_rules(g, "cluster_id", {"family has two members": F.col("n") < 2, "family has one parent": F.col("parents") != 1, "parent is a member": F.col("own") != 1})


def no_mixed_unclassified(donors: DataFrame) -> DataFrame:
    """"unclassified" never stands beside another tag. donors: donor_id, tags (array)."""
    return row_rules(donors, "donor_id", {"unclassified stands alone": F.array_contains("tags", "unclassified") & (F.size("tags") > 1)})


def stream_fusion(facts: DataFrame) -> DataFrame:
    """No committee has both direct gifts and funders' rows. facts: committee_id, stream."""
    g = facts.groupBy("committee_id").agg(F.count_if(F.col("stream") == "direct").alias("d"), F.count_if(F.col("stream") == "funder").alias("f")).filter("d > 0 AND f > 0")
    return violations(g, "streams are apart", F.col("committee_id"), F.concat_ws("/", "d", "f"))


def fused_totals(rows: DataFrame, key: str, streams: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """No stored figure is the sum of two streams or more: every combination is compared."""
    combos = []
    for bits in range(1 << len(streams)):
        chosen = [s for i, s in enumerate(streams) if bits >> i & 1]
        if len(chosen) >= 2:
            # Adding a stream of 0 fuses nothing.
            combos.append((reduce(lambda a, b: a + b, [F.col(s) for s in chosen]), reduce(lambda a, b: a & b, [F.col(s) != 0 for s in chosen])))
    hit = reduce(lambda a, b: a | b, [(F.col(t) == c) & nonzero for t in totals for c, nonzero in combos])
    return row_rules(rows, key, {"no fused total": hit})


def text_rules(df: DataFrame, key: str, column: str, owned: bool = False) -> DataFrame:
    """No control characters or replacement marks; names we own have no double or edge spaces."""
    c = F.col(column)
    rules = {"no control characters": c.rlike("[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x9F]"), "no replacement mark": F.contains(c, F.lit("�"))}
    if owned:
        rules |= {"no double space": F.contains(c, F.lit("  ")), "no edge space": c != F.trim(c)}
    return row_rules(df, key, rules)


def symmetric_bridge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Links that only one side knows. a: donor_id, committee_id. b: committee_id, donor_id."""
    x, y = a.filter("committee_id IS NOT NULL").select("donor_id", "committee_id"), b.filter("donor_id IS NOT NULL").select("donor_id", "committee_id")
    return violations(x.exceptAll(y), "bridge is known on both sides", F.col("donor_id"), "donor only").unionByName(violations(y.exceptAll(x), "bridge is known on both sides", F.col("donor_id"), "committee only"))


def person_links(links: DataFrame, candidacies: DataFrame, evidence: Sequence[str]) -> DataFrame:
    """Both ids, a known candidacy, the role of its election, known evidence, no repetition."""
    n = F.count(F.lit(1)).over(Window.partitionBy("person_id", "candidacy_id"))
    j = links.withColumn("n", n).join(candidacies.select("candidacy_id", F.col("election_id").alias("e")), "candidacy_id", "left")
    return row_rules(j, "candidacy_id", {"link has both ids": F.col("person_id").isNull() | F.col("candidacy_id").isNull(), "candidacy exists": F.col("e").isNull(), "role is the election": F.col("role") != F.col("e"), "evidence is known": ~F.col("evidence").isin(*evidence), "link is given once": F.col("n") > 1})


def applied_values(edits: DataFrame, table: DataFrame, key: str, column: str) -> DataFrame:
    """Every edited value stands in the table."""
    j = edits.filter(F.col(column).isNotNull()).select(key, F.col(column).alias("want")).join(table.select(key, F.col(column).alias("have")), key, "left").filter(~F.col("want").eqNullSafe(F.col("have")))
    return violations(j, "edit is applied", F.col(key), F.concat_ws(" vs ", "want", F.coalesce("have", F.lit("none"))))


def banned_keys(df: DataFrame, banned: Sequence[str]) -> list[str]:
    """Paths of fields with a banned name anywhere in the schema."""
    found: list[str] = []

    def walk(kind: object, path: str) -> None:
        if isinstance(kind, StructType):
            for f in kind.fields:
                here = f"{path}.{f.name}".lstrip(".")
                if f.name in banned:
                    found.append(here)
                walk(f.dataType, here)
        elif isinstance(kind, ArrayType):
            walk(kind.elementType, path)
        elif isinstance(kind, MapType):
            walk(kind.valueType, path)

    walk(df.schema, "")
    return found


#: A string of JSON, and the colon after it if it is a key. Strings are taken whole, one after another, so a key's text
#: inside a value is none.
_JSON_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*+:)?'


def json_keys(c: Column) -> Column:
    """All keys of a JSON text, whatever their depth."""
    found = F.filter(F.regexp_extract_all(c, F.lit(_JSON_STRING), F.lit(0)), lambda x: x.endswith(":"))
    return F.transform(found, lambda x: F.from_json(F.concat(F.lit("["), F.regexp_replace(x, r"\s*:$", ""), F.lit("]")), "array<string>")[0])


def keys_within(c: Column, kind: DataType, json: bool = False) -> Column | None:
    """All keys below a column, of structs, maps and arrays within each other and, if told, of texts that are JSON; None
    if its type has none."""
    none = F.array().cast("array<string>")
    if isinstance(kind, StructType):
        below = [k for f in kind.fields if (k := keys_within(c[f.name], f.dataType, json)) is not None]
        return F.concat(F.array(*[F.lit(f.name) for f in kind.fields]), *[F.coalesce(k, none) for k in below])
    if isinstance(kind, MapType):
        own = F.map_keys(c).cast("array<string>")
        if keys_within(c, kind.valueType, json) is None:
            return own
        return F.concat(own, F.flatten(F.transform(F.map_values(c), lambda x: F.coalesce(keys_within(x, kind.valueType, json), none))))
    if isinstance(kind, ArrayType):
        if keys_within(c, kind.elementType, json) is None:
            return None
        return F.flatten(F.transform(c, lambda x: F.coalesce(keys_within(x, kind.elementType, json), none)))
    return json_keys(c) if json and isinstance(kind, StringType) else None


def banned_within(df: DataFrame, key: str, banned: Sequence[str], json: Sequence[str] = ()) -> DataFrame:
    """key, column, found, n: rows that have a banned key anywhere, in the types of a column, as a key of a map, or in the
    JSON text of a column that json names. A null row or part has none."""
    out = None
    for f in df.schema.fields:
        names = keys_within(F.col(f"`{f.name}`"), f.dataType, f.name in json)
        own = F.array(*[F.lit(f.name)])
        every = own if names is None else F.concat(own, F.coalesce(names, F.array().cast("array<string>")))
        one = df.select(F.col(key), F.lit(f.name).alias("column"), F.explode(F.filter(every, lambda x: x.isin(*banned))).alias("found"))
        out = one if out is None else out.unionAll(one)
    return out.groupBy(key, "column", "found").agg(F.count(F.lit(1)).alias("n"))


def run_rules(rules: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """All violations of a run."""
    return reduce(DataFrame.unionByName, [r() for r in rules])


def gate(found: DataFrame) -> None:
    """Raises if any error was found; warnings pass."""
    errors = found.filter(F.col("severity") == ERROR)
    first = errors.limit(5).collect()
    if first:
        raise ValueError(f"{errors.count()} errors, first: " + "; ".join(f"{r.rule}: {r.key} {r.detail}" for r in first))
