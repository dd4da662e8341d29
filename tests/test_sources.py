"""Text folding, fingerprints, banned keys, line numbers, headers, and periods that lead."""

import datetime
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from civicspark.functions import text
from civicspark.operators import calendar, quality
from civicspark.sources import reference, sinks

D = datetime.date


def test_folding_equals_decomposition(spark):
    """Every character that text may hold, one by one and among others."""
    rows = ["".join(chr(c) for c in range(k, k + 64) if not 0xD800 <= c < 0xE000) for k in range(0, 0x20000, 64)] + ["Zoë Ångström", "ﬁne ½ ① ㎏", "éä", "", None]
    got = {r.s: r.f for r in spark.createDataFrame([(x,) for x in rows], "s string").select("s", text.fold(F.col("s")).alias("f")).collect()}
    assert got == {x: x if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode() for x in rows}


def test_folding_tries_no_long_classes(spark):
    """Long texts fold in a time that grows with their length alone: no pattern lists hundreds of characters, and none are looked for one by one."""
    rows = ["plain words " * 4000, "жизнь … ½ ﬁn é\n" * 4000, "\U00100000…\ue000" * 500]
    folded = spark.createDataFrame([(x,) for x in rows], "s string").repartition(1).select("s", text.fold(F.col("s")).alias("f"))
    assert {r.s: r.f for r in folded.collect()} == {x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode() for x in rows}
    plan = folded._jdf.queryExecution().analyzed().toString()
    assert "map(" not in plan and all(len(p) < 100 for p in re.findall(r"RLIKE\((?:[^,]|,(?! ))*, (\[.*?\])\)|RLIKE (\[.*?\])", plan) for p in p)


def test_slugs_of_letters_beyond_latin(spark):
    names = ["Ἀλέξανδρος Παπαδόπουλος", "Ångström-Öberg  III", "Fr. José “Pepe” Ñúñez V", "Ⅷ von Brück", "김 민준"]
    got = [r.s for r in spark.createDataFrame([(n,) for n in names], "n string").select(text.person_slug(F.col("n")).alias("s")).collect()]
    assert got == ["αλεξανδρος-παπαδοπουλος", "angstrom-oberg-iii", "jose-nunez-v", "viii-von-bruck", "민준"]


def test_fingerprints_merge(spark):
    rows = [(i % 5, f"t{i % 3}", None if i % 4 == 0 else i / 4, datetime.datetime(2024, 1, 1, 0, 0, i % 60)) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, name string, x double, at timestamp")
    whole = sinks.fingerprint(df).first()
    assert sinks.fingerprint(df.orderBy(F.rand(1)).repartition(7)).first() == whole
    assert sinks.merged_fingerprints(sinks.fingerprint(df, ["k"])).first() == whole and whole["rows"] == 200
    changed = [df.limit(199), df.union(df.limit(1)), df.withColumn("name", F.when(F.col("k") == 3, "t9").otherwise(F.col("name"))), df.withColumn("x", F.coalesce("x", F.lit(0.0)))]
    assert all(sinks.fingerprint(c).first() != whole for c in changed)
    assert [x for x in sinks.fingerprint(df.limit(0)).first()] == [0, 0, 0, 0, 0]


def test_banned_keys_at_any_depth(spark):
    kind = "id int, m map<string,array<map<string,string>>>, s struct<a:array<struct<ssn:int,b:map<string,int>>>>, doc string, other string"
    long = '"' + "x" * 200_000 + '\\"ssn\\": '
    rows = [
        (1, {"ok": [{"fine": "ssn"}, {"phone": "1"}], "phone": []}, {"a": [{"ssn": 1, "b": {"ssn": 2}}]}, '{"a": [{"b": {"ssn": 1}}], "c": "\\"phone\\": 1", "phone" : null}', '{"ssn": 1}'),
        (2, None, None, None, None),
        (3, {"x": None}, {"a": [{"ssn": None, "b": None}]}, '{"k": ' + long + '", "\\u0070hone": 2}', ""),
        (4, {}, {"a": []}, "not json ssn:", "x"),
    ]
    got = {(r.id, r.column, r.found, r.n) for r in quality.banned_within(spark.createDataFrame(rows, kind), "id", ["ssn", "phone"], ["doc"]).collect()}
    shape = {(i, "s", "ssn", 1) for i in (3, 4)}  # the type of the column names it wherever there is a value
    assert got - shape - {(1, "s", "ssn", 2), (1, "s", "ssn", 3)} == {(1, "m", "phone", 2), (1, "doc", "ssn", 1), (1, "doc", "phone", 1), (3, "doc", "phone", 1)}
    assert quality.banned_within(spark.createDataFrame(rows, kind).select("id", "other"), "id", ["ssn"]).count() == 0


def test_lines_are_numbered_across_splits(spark, tmp_path):
    for name, n in (("a.txt", 3000), ("b.txt", 7)):
        (tmp_path / name).write_bytes(b"".join(b"line %d of %s%s\n" % (i + 1, name.encode(), b"\r" if i % 3 == 0 else b"") for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = reference.numbered_lines(spark, str(tmp_path))
        got = {(r.file.rsplit("/", 1)[-1], r.line): r.text for r in lines.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {(f, i + 1): f"line {i + 1} of {f}" for f, n in (("a.txt", 3000), ("b.txt", 7)) for i in range(n)}


def test_a_reference_table_of_several_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("# note\n\nid\tkind\n1\tgood\n2\tbad\n")
    (tmp_path / "b.tsv").write_text("id\tkind\n3\n1\tgood\n")
    rows, bad = reference.load_reference(spark, str(tmp_path), ["id", "kind"], ["id"], {"kind": ["good"]})
    assert sorted(r.id for r in rows.collect()) == ["1", "1", "2"]
    assert {(r.file[-5:], r.line, r.violation) for r in bad.collect()} == {("a.tsv", 5, "kind is not in its vocabulary"), ("b.tsv", 2, "1 cells, not 2"), ("b.tsv", 3, "the key appears twice")}
    (tmp_path / "c.tsv").write_text("id\tsort\n")
    with pytest.raises(ValueError, match="c.tsv"):
        reference.load_reference(spark, str(tmp_path), ["id", "kind"], ["id"])


def test_headers_are_looked_at_file_by_file(spark, tmp_path):
    heads = {"a": "id\tname", "b": "name\tid", "c": "id\tid\tname", "d": "id", "e": "id\tname\tx", "f": ""}
    for f, h in heads.items():
        (tmp_path / f).write_text(h + "\r\n1\t2\n")
    found = reference.file_headers(spark, str(tmp_path))
    got = {(r.file[-1], r.fault) for r in reference.header_faults(found, ["id", "name"]).collect()}
    assert got == {("b", "another order"), ("c", "twice id"), ("d", "missing name"), ("e", "unknown x"), ("f", "missing id,name"), ("f", "unknown ")}
    keys = spark.createDataFrame([("name",)], "key string")
    wide = {(r.file[-1], r.fault) for r in reference.wide_header_faults(found, ["id"], keys, []).collect()}
    assert wide == {("b", "fixed columns"), ("b", "seat missing name"), ("b", "seat unknown id"), ("c", "seat unknown id"), ("d", "seat missing name"), ("e", "seat unknown x"), ("f", "fixed columns"), ("f", "seat missing name")}


def test_first_periods_equal_the_definition(spark):
    draw = random.Random(4)
    day = lambda: D(2020, 1, 1) + datetime.timedelta(days=draw.randint(0, 60))
    periods = []
    for _ in range(150):
        a, b = sorted((day(), day()))
        periods.append((draw.randint(0, 3), None if draw.random() < 0.05 else a, None if draw.random() < 0.05 else b, draw.randint(0, 9)))
    facts = [(i, draw.randint(0, 4), None if i % 17 == 0 else day()) for i in range(300)]
    got = {r.i: (r.beg, r.fin, r.doc) for r in calendar.first_period(spark.createDataFrame(facts, "i int, k int, date date"), spark.createDataFrame(periods, "k int, beg date, fin date, doc int"), ["k"], "date", ["beg", "fin", "doc"]).collect()}
    far, early = D(9999, 12, 31), D(1, 1, 1)
    for i, k, date in facts:
        held = [p for p in periods if date and p[0] == k and (p[1] or early) <= date <= (p[2] or far)]
        first = min(held, key=lambda p: (p[1] or early, p[2] or far, p[3]), default=None)
        assert got[i] == (first[1:] if first else (None,) * 3)


def test_a_filer_with_a_million_periods(spark):
    n = 1_000_000
    periods = spark.range(n).select(F.lit(1).alias("k"), F.date_add(F.lit(D(2000, 1, 1)), (F.col("id") % 5000).cast("int")).alias("beg"), F.date_add(F.lit(D(2000, 1, 1)), (F.col("id") % 5000 + F.col("id") % 97).cast("int")).alias("fin"), "id")
    assert calendar.leading_periods(periods, ["k"], ["beg", "fin", "id"]).count() <= 5097
    facts = spark.range(2000).select(F.lit(1).alias("k"), F.date_add(F.lit(D(2000, 1, 1)), F.col("id").cast("int")).alias("date"))
    found = calendar.first_period(facts, periods, ["k"], "date", ["beg", "fin"])
    assert found.filter("beg IS NULL OR date NOT BETWEEN beg AND fin").count() == 0
