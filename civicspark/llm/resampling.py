"""Target-distribution importance resampling: documents drawn by how much more likely their words are in a target.

Features are runs of words, hashed into a fixed number of buckets. A bucket's gain is the log of its share in the target
over its share in the source; a document's weight is the mean gain of its features; adding Gumbel noise that only its
id decides and keeping the highest draws without replacement, by weight.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.operators.numbering import numbered

from .common import give_back, materialise, text_or_empty

#: Words of A-Z lower-cased text: letters and digits, and all beyond ASCII.
FEATURE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Features whose bucket a Python worker remembers before it starts anew.
REMEMBER = 200_000


class Buckets(dict):
    """The bucket of each feature seen: its CRC of UTF-8 bytes, modulo their number. Forgets all rather than grow."""

    def __init__(self, count: int):
        super().__init__()
        self.count = count

    def __missing__(self, feature: str) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        found = zlib.crc32(feature.encode()) % self.count
        if len(feature) <= 64:
            self[feature] = found
        return found


def splitter():
    """A pre-tokeniser that is not trained: it splits text into words with their offsets."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(FEATURE_WORD), "removed", invert=True)


def features(text: str, spans: list[tuple[int, int]], longest: int) -> Iterator[str]:
    """All runs of 1 to `longest` words, by windows over their offsets; words are joined by one space."""
    for n in range(1, longest + 1):
        for i in range(len(spans) - n + 1):
            yield " ".join([text[a:b] for a, b in spans[i : i + n]])


def bucketed(docs: DataFrame, longest: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """id, n_words, n_features and at (the buckets of all features, little-endian unsigned 32 or 16 bits) of each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    unit = bucket_unit(buckets)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = splitter(), Buckets(buckets)
        for batch in batches:
            sizes, counts, held = [], [], []
            for value in batch.column(1):
                text = value.as_py().encode().lower().decode()  # bytes: A-Z only
                spans = [span for _, span in words.pre_tokenize_str(text)]
                at = np.fromiter(map(known.__getitem__, features(text, spans, longest)), unit)
                sizes.append(len(spans))
                counts.append(len(at))
                held.append(at.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(held, pa.binary())], ["id", "n_words", "n_features", "at"])
        give_back()

    return docs.select(F.col(id_col), text_or_empty(text_col)).mapInArrow(split, f"id {kind}, n_words long, n_features long, at binary")


def bucket_unit(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def histogram(rows: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all rows each bucket holds. A task counts into one array of fixed size; what meets in the
    shuffle and on the driver is a number for each bucket."""
    unit = bucket_unit(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for at in batch.column(0):
                held += np.bincount(np.frombuffer(at.as_py(), unit), minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(held[some], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in rows.select("at").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln(p_target / p_source)) of each bucket, with one added to each count."""
    buckets, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return [
        math.floor(1000 * math.log((float(t + 1) * float(all_source + buckets)) / (float(s + 1) * float(all_target + buckets))))
        for s, t in zip(source.tolist(), target.tolist())
    ]


def noise(doc_id: object, seed: int) -> int:
    """floor(1000 g) of a Gumbel variate that only seed and id decide; a null id counts as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance(
    docs: DataFrame, target: DataFrame, percent: float = 10, longest: int = 1, buckets: int = 10_000, min_words: int = 20, seed: int = 2024,
    id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """id, n_features, weight, score and rank for each row of docs.

    Of the N rows with at least min_words words, floor(percent * N / 100) are drawn: the highest scores, ties to the
    smaller id. rank is 1, 2, 3, ... in that order, null for the rest. Null text counts as empty: no features, weight 0.
    Rows that repeat an id have the same score and ranks that follow each other; a null id comes last among equal
    scores. An empty table gives no rows, an empty target gains that favour rare words; other columns are ignored.

    Texts are split once; what is written is two bytes a feature. Ranks are numbered by ranges of the score.
    """
    held = materialise(bucketed(docs, longest, buckets, id_col, text_col), "feature-buckets")
    wanted = bucketed(target.select(F.lit(0).alias("_id"), F.col(target_text).alias("_text")), longest, buckets, "_id", "_text")
    gain = np.array(gains(histogram(held, buckets), histogram(wanted, buckets)), np.int64)
    kind, unit = held.schema["id"].dataType.simpleString(), bucket_unit(buckets)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, scores = [], []
            for doc, at in zip(batch.column(0).to_pylist(), batch.column(3)):
                own = np.frombuffer(at.as_py(), unit)
                weights.append(int(gain[own].sum()) // len(own) if len(own) else 0)
                scores.append(weights[-1] + noise(doc, seed))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64()), pa.array(scores, pa.int64())], ["id", "n_words", "n_features", "weight", "score"])

    scored = materialise(held.mapInArrow(score, f"id {kind}, n_words long, n_features long, weight long, score long"), "importance")
    able = scored.filter(F.col("n_words") >= min_words)
    draws = math.floor(percent * able.count() / 100)
    ranked = numbered(able, "_rank", [F.col("score").desc(), F.col("id").asc_nulls_last()])
    rank = F.when(F.col("_rank") <= draws, F.col("_rank"))
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    return ranked.select(*columns, rank.alias("rank")).unionAll(scored.filter(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank")))


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **settings: object) -> DataFrame:
    """The rows of docs that importance() draws, as they are. Rows that repeat a drawn id are drawn with it; rows
    without an id are not drawn."""
    drawn = importance(docs, target, id_col=id_col, **settings).filter("rank IS NOT NULL").select(F.col(id_col).alias("_drawn")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return rows.join(drawn, F.col(f"_row.`{id_col}`") == F.col("_drawn"), "left_semi").select("_row.*")
