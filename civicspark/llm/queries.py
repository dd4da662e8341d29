"""The registered queries of this subpackage, each over whole tables, and the SQL that repeats them where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, html_text, line_rules, media, mixing, near_dedup, packing, quality, resampling, runs, suffix_dedup, token_counts, warc
from .common import WORD, table, text_or_empty


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(table(spark, sf_dir, "documents")).drop("low_hash")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one text in ten goes on with a block of its own words: with h the crc32 of the id, those
    with h % 10 = 0; g = h // 10 says where the block begins and how long it is. A null id plants nothing."""
    text, h = text_or_empty("text"), F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    rows = docs.select("doc_id", text.alias("text"), F.expr("crc32(cast(doc_id AS string)) div 10").alias("g"), words.alias("words"), F.size(words).alias("n"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n"))).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    planted = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", place(i))), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    told = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(told, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_mixing, op3_html_text, op4_warc, op5_packing, op6_token_counts, op7_suffix_dedup, op8_media, op9_near_dedup, op10_exact_dedup, op11_word_runs, op12_importance, op13_line_rules)}

ORACLE_SQL = {
    "op10_exact_dedup": """
        WITH t AS (
          SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
        ), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
        FROM t JOIN g ON t.norm = g.norm
    """,
    "op13_line_rules": r"""
        WITH t AS (
          SELECT doc_id, coalesce(source, '') || CASE WHEN source IS NULL THEN '' ELSE '=' END AS host, coalesce(text, '') AS text FROM documents
        ), w AS (
          SELECT doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, string_split(text, chr(10)) AS raw FROM t
        ), windows AS (
          SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w
        ), twice AS (
          SELECT doc_id, unnest(list(i)) AS i FROM (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram FROM windows) GROUP BY doc_id, gram HAVING count(*) > 1
        ), repeats AS (
          SELECT doc_id, sum(least(8, i - before)) AS n FROM (SELECT doc_id, i, lag(i, 1, -8) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM twice) GROUP BY doc_id
        ), raw_lines AS (
          SELECT doc_id, host, text, unnest(raw) AS line FROM w
        ), lines AS (
          SELECT doc_id, host, text, line,
            trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS norm
          FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        ), dups AS (
          SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id
        ), hosts AS (
          SELECT host, count(DISTINCT text) AS docs FROM t GROUP BY host
        ), frequent AS (
          SELECT host, norm FROM (SELECT host, norm, count(DISTINCT text) AS n FROM lines GROUP BY host, norm) JOIN hosts USING (host)
          WHERE n > 10 AND n * 100 > docs * 2
        ), gone AS (
          SELECT doc_id, sum(len(string_split(norm, ' '))) AS n FROM lines JOIN frequent USING (host, norm) GROUP BY doc_id
        ), m AS (
          SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
            CAST(length(regexp_replace(w.text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
            CAST(length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
            CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words
          FROM w LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN gone USING (doc_id)
        )
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
          NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT 100 * removed_words > 50 * n_words AS kept
        FROM m
    """,
}
