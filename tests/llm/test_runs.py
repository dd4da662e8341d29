"""Periodic runs of words against their definition."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from civicspark.llm import queries, runs

from .test_llm import SF, awkward, awkward_rows, empty, texts, words  # noqa: F401


def smallest_period(row):
    return next(q for q in range(1, len(row) + 1) if all(row[i] == row[i + q] for i in range(len(row) - q)))


def plain_runs(row, min_length=6, min_exponent=4):
    """Every maximal stretch of each period, kept if that is its smallest."""
    found = []
    for q in range(1, len(row) // min_exponent + 1):
        i = 0
        while i + q < len(row):
            j = i
            while j + q < len(row) and row[j] == row[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_exponent * q) and smallest_period(row[i : i + length]) == q:
                found.append((i, length, q))
            i = max(j, i) + 1
    return sorted(found)


def planted(doc, row):
    h = zlib.crc32(str(doc).encode())
    n, g = len(row), h // 10
    if doc is None or h % 10 or not n:
        return row
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [row[i] if i < a else row[a + (i - a) % p] for i in range(n)]


def plain_row(doc, text):
    row = planted(doc, words(text))
    found = plain_runs(row)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for k, w in enumerate(row) if k not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(told), sha(kept))


def test_word_runs(spark, texts):  # noqa: F811
    got = {r.doc_id: tuple(r) for r in queries.op11_word_runs(spark, SF).collect()}
    assert got == {doc: plain_row(doc, text) for doc, text in texts.items()}
    assert sum(r[1] > 0 for r in got.values()) >= 15


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 2), (3, 3), (9, 2), (4, 5)])
def test_runs_of_drawn_texts(least, exponent):
    """Few words, blocks within blocks, several texts at once."""
    for seed in range(120):
        draw = random.Random(seed)
        docs = []
        for _ in range(draw.randint(0, 5)):
            row = [draw.choice("ab" if seed % 3 else "abcd") for _ in range(draw.randint(0, 24))]
            for _ in range(draw.randint(0, 3)):
                at, block = draw.randint(0, len(row)), row[draw.randint(0, len(row)) :][: draw.randint(1, 7)]
                row[at:at] = block * draw.randint(1, 6)
            docs.append(row)
        assert runs.find_runs(docs, least, exponent) == [plain_runs(row, least, exponent) for row in docs]


def test_runs_of_one_word_and_of_many_occurrences():
    assert runs.find_runs([["a"] * 5, ["a"] * 6, [], ["a"] * 5000]) == [[], [(0, 6, 1)], [], [(0, 5000, 1)]]
    scattered = [w for k in range(30_000) for w in (f"u{k}", *"qrstuvw")]
    assert runs.find_runs([scattered + list("xy") * 8]) == [[(len(scattered), 16, 2)]]
    with pytest.raises(ValueError):
        runs.find_runs([["a"]], min_exponent=1)


def test_runs_do_not_cross_texts_or_depend_on_batches(spark, monkeypatch):
    rows = [(i, "na " * (i % 9)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(runs, "BATCH_WORDS", 7)
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed, r.n_words) for r in runs.periodic_runs(docs).collect()}
    assert got == {i: ([(0, n, 1)] if n >= 6 else [], "na" if n >= 6 else " ".join(["na"] * n), n) for i, n in ((i, i % 9) for i, _ in rows)}


def test_runs_awkward(spark, awkward, empty, monkeypatch):  # noqa: F811
    short = awkward.withColumn("text", F.when(F.length("text") > 1000, F.substring("text", 1, 5999)).otherwise(F.col("text")))
    rows = [(r[0], r[1][:5999] if r[1] else r[1]) for r in awkward_rows()]
    monkeypatch.setattr(queries, "table", lambda *_: short)
    got = collections.Counter(tuple(r) for r in queries.op11_word_runs(spark, SF).collect())
    assert got == collections.Counter(plain_row(*r) for r in rows)
    assert runs.periodic_runs(empty).count() == 0
    longest = runs.periodic_runs(awkward.filter("doc_id = 6")).first()
    assert [tuple(x) for x in longest.runs] == [(0, 12_000, 3)] and longest.collapsed == "lorem ipsum, Dolor!"
