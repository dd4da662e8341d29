"""Importance resampling against a plain version."""

import collections
import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from civicspark.llm import queries, resampling

from .test_llm import SF, awkward, awkward_rows, empty  # noqa: F401


def grams(text, longest):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(found), [" ".join(found[i : i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)]


def plain_importance(rows, target, percent=10, longest=1, buckets=10_000, min_words=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    all_rows = [(doc, *grams(text, longest)) for doc, text in rows]
    s = collections.Counter(bucket(f) for r in all_rows for f in r[2])
    t = collections.Counter(bucket(f) for text in target for f in grams(text, longest)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)]
    out = []
    for doc, n_words, fs in all_rows:
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: int(percent * len(able) / 100)], 1):
        r[4] = k
    return [tuple(r[:5]) for r in out]


def as_tuples(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_importance_of_the_tables(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = as_tuples(queries.op12_importance(spark, sf))
    assert got == collections.Counter(plain_importance(rows, target))
    assert max(r[4] or 0 for r in got) > 10


@pytest.mark.parametrize(("longest", "buckets"), [(2, 64), (3, 100_000)])
def test_importance_of_longer_features(spark, longest, buckets, monkeypatch):
    monkeypatch.setattr(resampling, "REMEMBER", 50)
    rows = [(i, " ".join(f"W{(i * k) % 37}-é{k % 5}" for k in range(i))) for i in range(80)]
    target = ["w1 é2 w3", None, "w5"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "passage string")
    setting = {"percent": 33, "longest": longest, "buckets": buckets, "min_words": 7, "seed": 5}
    expected = plain_importance(rows, target, **setting)
    assert as_tuples(resampling.importance(docs, wanted, target_text="passage", **setting)) == collections.Counter(expected)
    drawn = resampling.resampled(docs, wanted, target_text="passage", **setting)
    assert drawn.columns == docs.columns and {r.doc_id for r in drawn.collect()} == {r[0] for r in expected if r[4]}


def test_importance_awkward(spark, awkward, empty):  # noqa: F811
    rows = [(r[0], r[1]) for r in awkward_rows()]
    target = spark.createDataFrame([("Lorem ipsum",), (None,)], "text string")
    clash = awkward.select("*", *[F.lit("x").alias(c) for c in ("id", "at", "score2", "rank", "_rank", "_at", "_part", "weight", "n_words")])
    for docs in (awkward, clash):
        for percent in (0, 10, 50, 100):
            assert as_tuples(resampling.importance(docs, target, percent=percent, min_words=1)) == collections.Counter(plain_importance(rows, ["Lorem ipsum", None], percent=percent, min_words=1))
    assert resampling.importance(empty, target).count() == resampling.resampled(empty, target).count() == 0
    assert as_tuples(resampling.importance(awkward, target.limit(0))) == collections.Counter(plain_importance(rows, []))
    assert resampling.resampled(clash, target, percent=100, min_words=1).columns == clash.columns


def test_target_like_documents_are_preferred(spark):
    rows = [(i, " ".join((f"alpha{k % 9}" if i % 2 else f"beta{k % 9}") for k in range(40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = resampling.importance(docs, spark.createDataFrame([("alpha1 alpha2 alpha3 " * 9000,)], "text string"), percent=25).filter("rank IS NOT NULL").collect()
    assert len(got) == 100 and sum(r.doc_id % 2 for r in got) > 60
