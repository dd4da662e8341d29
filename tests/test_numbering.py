"""Numbers over all rows, dealt by ranges."""

import random

from pyspark.sql import functions as F

from civicspark.operators import changes, numbering, views


def test_numbers_follow_the_order(spark):
    rows = [(i, random.Random(i).randint(0, 50), None if i % 7 == 0 else f"n{i % 13}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, amount long, name string").repartition(6)
    got = numbering.numbered(df, "place", [F.col("amount").desc(), F.col("name").asc_nulls_first(), "id"])
    want = sorted(rows, key=lambda r: (-r[1], r[2] or "", r[0]))
    assert [tuple(r) for r in got.orderBy("place").collect()] == [(*r, k) for k, r in enumerate(want, 1)]


def test_no_task_sees_all_rows(spark):
    df = spark.range(40_000).repartition(8)
    plans = [numbering.numbered(df, "n", ["id"]), changes.mint_ids(df.select("id"), spark.createDataFrame([("f-7",), ("g-99",)], "id string"), "id", "f-", "id")]
    for out in plans:
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 40_000
    assert {r.id for r in plans[1].collect()} == {f"f-{k}" for k in range(8, 40_008)}


def test_ties_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a")] * 5 + [(None, "b")], "id long, name string")
    assert sorted(r.n for r in numbering.numbered(df, "n", ["id"]).collect()) == [1, 2, 3, 4, 5, 6]
    assert numbering.numbered(df.limit(0), "n", ["id"]).count() == 0


def test_page_cap_by_floor_and_by_page(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(50)], "id long, amount long")
    for floor, most in ((400, 10), (0, 50), (495, 4), (1000, 4)):
        got = [tuple(r) for r in views.page_cap(df, "amount", "id", floor, 4).orderBy("rank").collect()]
        assert got == [(49 - k, (49 - k) * 10, k + 1) for k in range(most)]
