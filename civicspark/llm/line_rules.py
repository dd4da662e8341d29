"""Quality rules: measures of the text alone, and lines that too many documents of one host share.

Only DataFrame functions: no Python worker, no row leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, ascii_lower, materialise, text_or_empty

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: White space inside a line, as the pattern of a word has it.
SPACES = r"[\x20\x09\x0B-\x0D]+"
#: Hashes of frequent lines that are broadcast at most (16 MB); beyond that, hosts are dealt over SALTS parts.
BROADCAST_HASHES = 2_000_000
SALTS = 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once a row, also where use() looks at it from within a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column, window: int = 8) -> Column:
    """Words of an array that lie in windows found twice or more in it, the first one included.

    A window is known by 64 bits. Only an array with a repeated window is sorted: by hash, where
    equal windows are neighbours, then by place, where each window adds what the last one left.
    """

    def covered(hashes: Column) -> Column:
        return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))), twice)

    def twice(pairs: Column) -> Column:
        def like_a_neighbour(pair: Column, k: Column) -> Column:
            return F.coalesce((F.get(pairs, k - 1)["h"] == pair["h"]) | (F.get(pairs, k + 1)["h"] == pair["h"]), F.get(pairs, k - 1)["h"] == pair["h"], F.get(pairs, k + 1)["h"] == pair["h"])

        return let(F.sort_array(F.transform(F.filter(pairs, like_a_neighbour), lambda pair: pair["at"])), length)

    def length(places: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(-window).alias("last"))
        add = lambda done, at: F.struct((done["total"] + F.least(F.lit(window), at - done["last"])).alias("total"), at.alias("last"))
        return F.aggregate(places, start, add, lambda done: done["total"])

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window)))
    found = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(words) > window, found).otherwise(F.lit(0).cast("long"))


def lines_of(text: Column) -> Column:
    """Lines as they count for frequency: A-Z lower-cased, white space collapsed and trimmed; those without a word are empty."""
    return F.transform(F.split(F.regexp_replace(ascii_lower(text), SPACES, " "), "\n"), lambda line: F.trim(line))


def _host(column: str) -> Column:
    """A name that is never null: no host is a host of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def frequent_lines(docs: DataFrame, percent: float = 2, least: int = 10, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """_host, line (64 bits of it), n_docs: the lines that more than `least` documents of the host hold, and more than
    `percent` in 100 of its documents.

    Documents with equal texts are one document, so copies don't make their own lines frequent; a line counts once a
    document. Both counts are distinct counts with partial sums by (host, line, document), which spreads a host with a
    third of all rows and a line that every document has. At most 100 / percent times a host's mean number of lines
    can be frequent in it.
    """
    text = text_or_empty(text_col)
    each = docs.select(_host(host_col).alias("_host"), F.xxhash64(text).alias("doc"), text.alias("_text"))
    hosts = each.groupBy("_host").agg(F.countDistinct("doc").alias("docs"))
    hashes = F.array_distinct(F.transform(F.filter(lines_of(F.col("_text")), lambda line: line != ""), lambda line: F.xxhash64(line)))
    counted = each.select("_host", "doc", F.explode(hashes).alias("line")).groupBy("_host", "line").agg(F.countDistinct("doc").alias("n_docs"))
    return counted.filter(F.col("n_docs") > least).join(hosts, "_host").filter(F.col("n_docs") * 100 > F.col("docs") * percent).select("_host", "line", "n_docs")


def _with_frequent(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """rows (with _host, _text) and _known: the hashes of the host's frequent lines, or null."""
    found = materialise(frequent, "frequent-lines")
    lists = found.groupBy("_host").agg(F.collect_list("line").alias("_known"))
    if found.count() <= BROADCAST_HASHES:
        return rows.join(F.broadcast(lists), "_host", "left")
    salted = lists.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("_text"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["_host", "_salt"], "left").drop("_salt")


def _judged(docs: DataFrame, percent: float, least: int, most_gone: int, min_words: int, most_repeated: int, host_col: str, text_col: str) -> DataFrame:
    """_row (the row of docs), the measures, and the lines of the text with those taken out that are frequent."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), _host(host_col).alias("_host"), text_or_empty(text_col).alias("_text"))
    rows = _with_frequent(rows, frequent_lines(docs, percent, least, host_col, text_col))
    # Arrays that later columns look at more than once stand in a projection of their own.
    rows = rows.withColumns({"_words": F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)), "_raw": F.split("_text", "\n")})
    # A frequent line that the document holds is looked up among the host's by hash; most documents hold none.
    norm = F.when(F.col("_known").isNotNull(), lines_of(F.col("_text")))
    held = let(norm, lambda lines: let(F.array_intersect(F.transform(lines, lambda x: F.xxhash64(x)), F.col("_known")), lambda bad: F.transform(lines, lambda x: F.when(F.array_contains(bad, F.xxhash64(x)) & (x != ""), F.size(F.split(x, " "))).otherwise(F.lit(0)))))
    rows = rows.withColumn("_gone", held)
    with_word = F.filter("_raw", lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    n_words, removed = F.size("_words").cast("long"), F.coalesce(F.aggregate("_gone", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    rows = rows.select(
        "_row",
        "_raw",
        "_gone",
        n_words.alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(with_word, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        removed.alias("removed_words"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    depleted = 100 * F.col("removed_words") > most_gone * F.col("n_words")
    return rows.withColumns({"base_failed": failed, "kept": ~failed & ~depleted})


def line_rules(
    docs: DataFrame, percent: float = 2, least: int = 10, most_gone: int = 50, min_words: int = 20, most_repeated: int = 30,
    id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """One row for each row of docs: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words,
    base_failed and kept.

    base_failed: under min_words words, or over most_repeated in 100 of them in 8-word windows that the text repeats.
    removed_words are those of lines that frequent_lines() finds in the document's host; a document that loses over
    most_gone in 100 of its words by them is depleted and not kept.

    Null text counts as empty: no words, failed. Rows without a host share one. Repeated rows and null ids pass through
    one to one; equal texts of a host are one document for the counts. An empty table gives no rows; other columns are
    ignored, whatever their names. Whole texts count, however long.
    """
    judged = _judged(docs, percent, least, most_gone, min_words, most_repeated, host_col, text_col)
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept"]
    return judged.select(F.col(f"_row.`{id_col}`").alias(id_col), *measures)


def cleaned(
    docs: DataFrame, percent: float = 2, least: int = 10, most_gone: int = 50, min_words: int = 20, most_repeated: int = 30,
    host_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """The rows of docs that line_rules() keeps, with frequent lines taken out of the text; all other columns stay as
    they are. Nulls, repeated rows and empty tables as there."""
    judged = _judged(docs, percent, least, most_gone, min_words, most_repeated, host_col, text_col).filter("kept")
    stay = F.filter("_raw", lambda line, i: F.coalesce(F.get("_gone", i), F.lit(0)) == 0)
    text = F.when(F.col("removed_words") > 0, F.array_join(stay, "\n")).otherwise(F.col(f"_row.`{text_col}`"))
    return judged.select(*[text.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
