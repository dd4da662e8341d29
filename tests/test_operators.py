"""Operators on small fixtures: the cases that the tables don't hold, and rules that must bite."""

import collections
import datetime as dt
import decimal
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from civicspark.functions import money, text
from civicspark.operators import calendar, changes, entities, filings, matching, quality, rollups, setops, validators, votes
from civicspark.sources import bulk, reference, sinks


def d(s):
    return dt.date.fromisoformat(s)


def test_half_up_cents(spark):
    got = spark.createDataFrame([("30.555",), ("10.005",), (" ",), (None,), ("x",)], "t string").select(money.cents(F.col("t")).alias("c")).collect()
    assert [str(r.c) for r in got] == ["30.56", "10.01", "0.00", "0.00", "None"]


def test_person_slug(spark):
    names = ["Dr. Ada L. Ferro", "Emil Stone, Jr.", "Tove Lind-Berg", 'Noël "Nono" Brück', "", None]
    got = [r.s for r in spark.createDataFrame([(n,) for n in names], "n string").select(text.person_slug(F.col("n")).alias("s")).collect()]
    assert got == ["ada-ferro", "emil-stone-jr", "tove-lind-berg", "noel-bruck", "", ""]


def test_suggestions(spark):
    filed = spark.createDataFrame([(1, ["bill", "smith"]), (2, ["jon", "smyth"]), (3, ["maria", "lopez"]), (4, ["ana", "diaz", "maria"])], "filed_id int, tokens array<string>")
    known = spark.createDataFrame([(10, ["william", "smith"]), (20, ["jon", "smith"]), (30, ["maria", "lopez", "garcia"]), (40, ["ana", "diaz"])], "candidate_id int, tokens array<string>")
    got = {(r.filed_id, r.candidate_id): r.reason for r in matching.suggestions(filed, known).collect()}
    assert got[1, 10] == "nickname" and got[2, 20] == "surname spelling" and got[3, 30] == "part of a compound surname" and got[4, 40] == "surname order or extra name"


def test_suggestions_lose_no_pair(spark):
    """Nicknames with surnames that differ in their first letters, and any two edits anywhere."""
    filed = [(1, ["bob", "macdonald"]), (2, ["ann", "abcdef"]), (3, ["ann", "abxcdye"])]
    known = [(10, ["robert", "mcdonald"]), (20, ["ann", "bcde"]), (30, ["ann", "abcde"]), (40, ["ann", "xbcdez"]), (50, ["ann", "xyzdef"])]
    got = matching.suggestions(spark.createDataFrame(filed, "filed_id int, tokens array<string>"), spark.createDataFrame(known, "candidate_id int, tokens array<string>")).collect()
    assert {(r.filed_id, r.candidate_id) for r in got} == {(1, 10), (2, 20), (2, 30), (2, 40), (3, 30)} and {r.reason for r in got} == {"surname spelling"}


def test_near_duplicates_of_a_frequent_single_token(spark):
    rows = [(1, "Acme"), (2, "Acme Widgets"), (3, "Tools Acme"), (4, "ACME"), (5, "Zenith Widgets")]
    e = spark.createDataFrame([(i, "t", n) for i, n in rows] + [(6, "u", "Acme")], "id int, type string, name string")
    whole = {(r.a, r.b, r.why, r.score) for r in matching.near_duplicates(e).collect()}
    assert {(a, b) for a, b, *_ in whole} == {(1, 2), (1, 3), (1, 4), (2, 4), (3, 4)}  # "Acme" and "ACME" are two classes
    again = e.unionByName(spark.createDataFrame([(9, "t", "Acme"), (8, "t", "Acme Widgets")], e.schema))
    assert {(r.a, r.b, r.why, r.score) for r in matching.near_duplicates(again).collect()} == whole


DONOR = "donor_id int, name string, type string, employer string, total decimal(18,2)"


def test_pairs_of_related_donors_carry_their_money(spark):
    """One employer of many people by many firms: the pairs are many more than the donors, and none is shuffled again."""
    rows = [(i, f"ada w{i}", "Individual", "Zenith Works", None if i == 3 else i) for i in range(300)] + [(1000 + i, "Zenith Works, Inc.", "PAC", None, None if i < 2 else i) for i in range(300)]
    found = matching.related_donors(spark.createDataFrame([(a, b, c, e, t if t is None else decimal.Decimal(t)) for a, b, c, e, t in rows], DONOR)).filter("relationship = 'employer is organisation'")
    got = {(r.label, r.donor_id): r.dollars for r in found.collect()}
    money_of = lambda a, b: None if a == 3 and b < 2 else (0 if a == 3 else a) + (0 if b < 2 else b)
    assert got == {(f"Zenith Works, Inc. / {a} / {1000 + b}", m): money_of(a, b) for a in range(300) for b in range(300) for m in (a, 1000 + b)}

    # Nothing above the pairs of plain ids joins or sums them.
    lines = [(len(re.match(r"[\s:+-]*", line)[0]), line) for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    above = []
    for i, (depth, line) in enumerate(lines):
        if "Generate explode(array(p_id" in line:
            above.append([x.lstrip(" :+-").split()[0] for k, (d, x) in enumerate(lines[:i]) if d < depth and all(e > d for e, _ in lines[k + 1 : i])])
    assert any(not {"Join", "Aggregate"} & set(x) for x in above)


def test_related_donors_of_repeated_ids(spark):
    """An id in several rows: its pairs count each of them, as the SQL does."""
    rows = [(1, "ada w1", "Individual", "Zenith Works", 5), (1, "ada w2", "Individual", "Zenith Works", 7), (2, "bea w2", "Individual", "Zenith Works", 1), (8, "Zenith Works Inc.", "PAC", "", 10), (9, "Zenith Works", "PAC", "", 20), (9, "Zenith Works", "PAC", "", 30)]
    found = matching.related_donors(spark.createDataFrame([(*r[:4], decimal.Decimal(r[4])) for r in rows], DONOR)).filter("relationship = 'employer is organisation'")
    got = collections.Counter((r.label, r.donor_id, int(r.dollars)) for r in found.collect())
    once, both, four = "Zenith Works Inc. / 2 / 8", "Zenith Works / 2 / 9", "Zenith Works / 1 / 9"
    assert got == {(once, 2, 11): 1, (once, 8, 11): 1, (both, 2, 102): 2, (both, 9, 102): 4, ("Zenith Works Inc. / 1 / 8", 1, 44): 4, ("Zenith Works Inc. / 1 / 8", 8, 44): 2, (four, 1, 248): 8, (four, 9, 248): 8}


def plain_hint(t, u):
    """The reason of two token lists, by its definition."""
    from civicspark.operators.matching import NICKNAMES

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    if not t or not u:
        return None
    (g, s), (h, r) = (t[:-1], t[-1]), (u[:-1], u[-1])
    same = bool(set(g) & set(h))
    nick = any(a == b or any(a in n and b in n for n in NICKNAMES) for a in g for b in h)
    spelled = any(distance(a, b) <= 2 and min(len(a), len(b)) >= 4 for a in g for b in h)
    if s == r:
        return None if same else "nickname" if nick else "given-name spelling" if spelled else None
    if s in u and (same or nick):
        return "part of a compound surname"
    if len(s) >= 4 and distance(s, r) <= 2 and (same or nick):
        return "surname spelling"
    return "surname order or extra name" if r in t and (same or nick) else None


def test_suggestions_equal_the_definition(spark):
    draw = random.Random(3)
    given, last = ["bob", "robert", "rob", "anna", "anne", "jonah", "jonas", "kate", "li"], ["smith", "smyth", "smithe", "stone", "li", "anna", "stones", "smithers"]
    lists = lambda: [[draw.choice(given) for _ in range(draw.randint(0, 2))] + ([draw.choice(last)] if draw.random() < 0.97 else []) for _ in range(120)]
    filed, known = lists(), lists()
    frames = [spark.createDataFrame(list(enumerate(x)), f"{c} int, tokens array<string>") for x, c in ((filed, "filed_id"), (known, "candidate_id"))]
    got = {(r.filed_id, r.candidate_id): r.reason for r in matching.suggestions(*frames).collect()}
    assert got == {(i, j): why for i, t in enumerate(filed) for j, u in enumerate(known) if (why := plain_hint(t, u))}


def test_a_surname_of_thousands_brings_only_related_names_together(spark):
    names = [["john", hashlib.md5(str(i).encode()).hexdigest(), "smith"] for i in range(4000)] + [["jon", "smith"], ["jack", "q", "smith"]]
    df = spark.createDataFrame([(n,) for n in names], "t array<string>")
    pairs = matching._hint_pairs(df, df.withColumnRenamed("t", "u"))
    results = matching.suggestions(df.selectExpr("t[1] AS filed_id", "t AS tokens"), df.selectExpr("t[1] AS candidate_id", "t AS tokens"))
    assert results.count() <= pairs.count() <= 2 * results.count() + 100 < 100_000


@pytest.mark.parametrize("least", [0.6, 0.75])
def test_near_duplicates_equal_all_pairs(spark, least):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(14)]
    rows = [(i, f"t{i % 2}", " ".join(draw.sample(words, draw.randint(1, 9)))) for i in range(160)] + [(900, "t0", "wwww"), (901, "t0", ""), (902, "t1", "of the")]
    df = spark.createDataFrame(rows, "id int, type string, name string")
    e = {r.id: r for r in matching.name_classes(df).collect()}
    whole = set()
    for a in e.values():
        for b in e.values():
            if a.id < b.id and a.type == b.type:
                x, y = set(a.core), set(b.core)
                acro = any(p.compact and len(p.compact) <= 5 and p.compact == q.acro for p, q in ((a, b), (b, a)))
                if acro or x and y and (x <= y or y <= x or len(x & y) >= least * len(x | y) - 1e-9):
                    whole.add((a.id, b.id))
    assert {(r.a, r.b) for r in matching.near_duplicates(df, least).collect()} == whole and len(whole) > 50


def test_a_pair_of_tokens_of_thousands_brings_no_names_together(spark):
    rows = [(i, "t", f"north local union{i} hall{i} branch{i}") for i in range(4000)] + [(5000, "t", "north local"), (5001, "t", "north local union7 hall7 branch7 annex")]
    e = matching.name_classes(spark.createDataFrame(rows, "id int, type string, name string"))
    assert matching.name_pairs(e, 0.6).count() <= 2 * 4002  # the short name is in all others


def test_keyword_candidates(spark):
    items = spark.createDataFrame([(1, ["housing"], ["housing", "plan"], 2024)], "item_id int, keywords array<string>, tokens array<string>, year int")
    records = spark.createDataFrame([("a", ["housing", "plan"], False, 2023), ("b", ["housing"], True, 2024), ("c", ["plan"], True, 2024)], "record_id string, tokens array<string>, divided boolean, year int")
    got = [(r.record_id, r.score, r["rank"]) for r in matching.keyword_candidates(items, records).orderBy("rank").collect()]
    assert got == [("b", 8, 1), ("a", 2, 2)]


def test_ladder(spark):
    """Hits on a rung: alone, by ward, by district, or guessed; scopes of windows and of the mayor; the guard; single rungs."""
    c = "target_id int, name string, window string, mayor boolean, ward int, district string"
    targets = spark.createDataFrame(
        [(1, "a lee", "", False, 3, None), (2, "a lee", "", False, None, None), (3, "a lee", "", False, None, "2a"), (4, "b roe", "", False, None, None), (5, "m", "", False, None, None), (6, "m", "", True, None, None),
         (7, "w", "w1", False, None, None), (8, "w", "", False, None, None), (9, "a lee roe", "", False, None, None), (10, "x roe", "", False, 5, None), (11, "ann roe", "", False, None, None)], c)
    rows = [("a lee", 100, 3, "1a", 1, None, False), ("a lee", 200, 4, "2a", 2, None, False), ("m", 300, None, None, 3, None, True), ("w", 400, None, None, 4, "w1", False), ("w", 500, None, None, 5, "w2", False), ("ann roe", 600, 5, None, 6, None, False)]
    registry = spark.createDataFrame(rows, "key string, candidate_id int, ward int, district string, ord int, window string, mayor boolean")
    surname = matching.scoped(registry.withColumn("key", F.element_at(F.split("key", " "), -1)).filter("key IN ('lee', 'roe')"), ["w1", "w2"])
    tokens = F.split("name", " ")
    rungs = [("exact", "resolve", F.array("name"), matching.scoped(registry, ["w1", "w2"])), ("several_names", "guard", tokens, surname), ("surname", "review", F.slice(tokens, -1, 1), surname)]
    got = {r.target_id: (r.candidate_id, r.method, r.needs_review) for r in matching.ladder(targets, rungs).collect()}
    assert got == {
        1: (100, "exact", True), 2: (100, "name_fallback", True), 3: (200, "exact", True), 4: (600, "surname", True), 5: (None, "unmatched", False), 6: (300, "exact", False),
        7: (400, "exact", False), 8: (None, "unmatched", False), 9: (None, "several_names", False), 10: (600, "surname", True), 11: (600, "exact", False),
    }


def test_cash_of_the_latest_amended_report(spark):
    f = spark.createDataFrame([(1, 7, d("2024-01-01"), d("2024-03-31"), d("2024-04-10"), "q"), (2, 7, d("2024-01-01"), d("2024-03-31"), d("2024-05-01"), "q"), (3, 8, d("2024-01-01"), d("2024-03-31"), d("2024-04-01"), "q")], "doc_id int, committee_id int, beg date, fin date, received date, kind string")
    s = spark.createDataFrame([(1, "1.00"), (2, "30.555")], "doc_id int, cash string").withColumn("cash", F.col("cash").cast("decimal(20,6)"))
    c = spark.createDataFrame([(7,), (8,), (9,)], "committee_id int")
    got = {r.committee_id: (str(r.cash), r.lacks_totals) for r in filings.latest_cash(c, filings.final_filings(f), s).collect()}
    assert got == {7: ("30.56", False), 8: ("None", True), 9: ("None", False)}


def test_equal_times_supersede_nothing(spark):
    f = spark.createDataFrame([(1, 7, d("2024-01-01"), d("2024-03-31"), d("2024-04-10")), (2, 7, d("2024-03-01"), d("2024-06-30"), d("2024-04-10"))], "doc_id int, committee_id int, beg date, fin date, received date").withColumn("superseded", F.lit(0))
    assert filings.overlap_superseders(f).count() == 0


def test_superseders_of_few_and_of_many_finals_are_those_of_all_pairs(spark, monkeypatch):
    rng, day0, rows = random.Random(5), d("1969-06-01"), []
    for filer, n, span in ((1, 30, 900), (2, 300, 2500), (3, 65, 40), (4, 1, 9), (None, 90, 400)):
        for _ in range(n):
            beg = rng.randrange(span)
            end = beg + rng.choice([0, 1, 6, 30, 90, 91, 1500, 90_000, -3])
            day = lambda x: None if rng.random() < 0.04 else day0 + dt.timedelta(days=x)
            rows.append((len(rows), filer, day(beg), day(end), day(rng.randrange(120))))
    f = spark.createDataFrame(rows, "doc_id int, committee_id int, beg date, fin date, received date")
    latest = filings.latest_versions(f).collect()
    sound = [x for x in latest if None not in (x.committee_id, x.beg, x.fin, x.received) and x.beg <= x.fin]
    want = {}
    for a in sound:
        later = [(b.received, b.doc_id) for b in sound if b.committee_id == a.committee_id and b.received > a.received and a.beg <= b.fin and b.beg <= a.fin]
        if later:
            want[a.doc_id] = max(later)[::-1]
    assert len(want) > 100
    for most in (filings.GATHERED, 0, 1000):
        monkeypatch.setattr(filings, "GATHERED", most)
        got = filings.overlap_superseders(filings.latest_versions(f)).collect()
        assert len(got) == len(want) and {r.doc_id: (r.by_doc, r.by_received) for r in got} == want
        kept = filings.final_filings(f).collect()
        assert sorted(r.doc_id for r in kept) == sorted(x.doc_id for x in latest if x.doc_id not in want)
        assert {r.doc_id: r.superseded for r in kept} == {x.doc_id: x.superseded for x in latest if x.doc_id not in want}
    assert filings.final_filings(f.limit(0)).count() == 0


def test_shares_sum_to_the_scale(spark):
    rows = spark.createDataFrame([("g", "a", "1.00"), ("g", "b", "1.00"), ("g", "c", "1.00"), ("z", "a", "0.00")], "k string, n string, v string").withColumn("v", F.col("v").cast("decimal(18,2)"))
    got = {(r.k, r.n): r.units for r in rollups.apportion(rows, ["k"], "n", "v").collect()}
    assert got == {("g", "a"): 333334, ("g", "b"): 333333, ("g", "c"): 333333, ("z", "a"): 0}


def test_open_windows_and_null_dates(spark):
    w = spark.createDataFrame([("m", "early", None, d("2020-01-01"), 1), ("m", "late", d("2019-06-01"), None, 2)], "office_type string, window_id string, start_date date, end_date date, ord int")
    facts = spark.createDataFrame([(1, "m", d("2019-12-01")), (2, "m", d("2021-01-01")), (3, "m", None), (4, "x", d("2019-12-01"))], "id int, office_type string, date date")
    got = {r.id: r.window_id for r in calendar.with_window(facts, w).collect()}
    assert got == {1: "early", 2: "late", 3: None, 4: None}


def test_seat_falls_back_and_says_so(spark):
    v = spark.createDataFrame([(1, 5, d("2024-06-01")), (2, 6, d("2024-06-01")), (3, 9, d("2024-06-01"))], "event_id int, voter_id int, date date")
    s = spark.createDataFrame([(5, 1, d("2020-01-01"), d("2022-01-01")), (5, 2, d("2022-01-02"), d("2023-01-01")), (6, 3, d("2025-01-01"), None)], "person_id int, seat int, start_date date, end_date date")
    got = {r.event_id: (r.seat, r.fallback) for r in votes.seat_at(v, s).collect()}
    assert got == {1: (2, True), 2: (3, False), 3: (None, False)}


def test_unpivot_vocabulary(spark):
    grid = spark.createDataFrame([("v1", "Yes", "", "Maybe")], "vote_id string, s1 string, s2 string, s3 string")
    good, bad = votes.unpivot_votes(grid, ["vote_id"], ["Yes", "No"])
    assert {(r.seat, r.position) for r in good.collect()} == {("s1", "Yes"), ("s2", "-")} and [r.seat for r in bad.collect()] == ["s3"]


def test_sorted_tokens(spark):
    known = spark.createDataFrame([("ann-bee",), ("cat-dog",), ("dog-cat",)], "id string")
    ids = spark.createDataFrame([("bee-ann",), ("single",), ("ann-bee",)], "id string")
    assert [(r.id, r.alias) for r in entities.sorted_token_alias(ids, known).collect()] == [("bee-ann", "ann-bee")]


def test_map_inversion_bites(spark):
    pairs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "ward int, committee string")
    assert [(r.side, r.key) for r in entities.inverted(pairs, "ward", "committee")[1].collect()] == [("committee", "a")]


def test_control_id_must_occur(spark):
    t = spark.createDataFrame([("x",)], "id string")
    with pytest.raises(ValueError):
        setops.occurrences({"t": t}, "id", t, spark.createDataFrame([("y",)], "id string"))


def test_fingerprint_ignores_order_but_not_repetitions(spark):
    rows = [(1, "a"), (2, "b"), (2, "b")]
    one = lambda r: sinks.fingerprint(spark.createDataFrame(r, "k int, v string")).first()
    assert one(rows) == one(rows[::-1]) and one(rows) != one(rows[:2])


def test_quality_rules_bite(spark):
    clean = spark.createDataFrame([(1, "f", 1), (2, "f", 1)], "donor_id int, cluster_id string, parent_id int")
    assert quality.family_rules(clean).count() == 0
    broken = spark.createDataFrame([(1, "f", 1), (2, "f", 2), (3, "g", 3)], "donor_id int, cluster_id string, parent_id int")
    found = quality.family_rules(broken)
    assert {(r.rule, r.key) for r in found.collect()} == {("family has one parent", "f"), ("parent is a member", "f"), ("family has two members", "g")}
    with pytest.raises(ValueError):
        quality.gate(found)
    quality.gate(quality.run_rules([lambda: quality.family_rules(clean)]))
    words = spark.createDataFrame([(1, "ok"), (2, "bad\x92"), (3, "no�"), (4, " edge")], "k int, t string")
    assert {r.key for r in quality.text_rules(words, "k", "t", owned=True).collect()} == {"2", "3", "4"}
    assert quality.banned_keys(spark.sql("SELECT struct(1 AS total, array(struct(2 AS x)) AS a) AS s"), ["total", "x"]) == ["s.total", "s.a.x"]


def test_fused_total_bites(spark):
    rows = spark.createDataFrame([(1, 5, 7, 12), (2, 5, 0, 5), (3, 5, 7, 5)], "k int, a int, b int, figure int")
    assert [r.key for r in quality.fused_totals(rows, "k", ["a", "b"], ["figure"]).collect()] == ["1"]


def test_flags_round_trip(spark):
    cell = "loan|https://a.example|seen; audit; |no type"
    df = spark.createDataFrame([(cell,), (None,)], "c string").withColumn("f", changes.parse_flags(F.col("c")))
    assert [[tuple(x) for x in r.f] for r in df.collect()] == [[("loan", "https://a.example", "seen"), ("audit", "", "")], []]
    assert [r.e for r in df.select(changes.encode_flags(F.col("f")).alias("e")).collect()] == ["loan|https://a.example|seen; audit", ""]


HEADER = "ID\tCommitteeID\tName\tNote"


@pytest.fixture
def export(tmp_path):
    lines = [HEADER]
    for i in range(400):
        lines.append(f"{i}\t{i % 7}\tO’Mara {i}\tplain")
        if i % 9 == 0:
            lines += ["continued", f"again {i}"]
    path = tmp_path / "export.txt"
    path.write_bytes(("\r\n".join(lines) + "\r\n").encode("cp1252"))
    return str(path), lines


def test_records_run_over_block_edges(spark, export):
    path, lines = export
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        physical = bulk.physical_lines(spark, path)
        assert physical.rdd.getNumPartitions() > 10
        records = bulk.reassemble(physical).filter("record > 0")
        got = {r.record: r.text for r in records.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want, current = [], None
    for line in lines[1:]:
        if line[:1].isdigit():
            want.append(line)
        else:
            want[-1] += "\n" + line
    assert [got[i + 1] for i in range(len(want))] == want and len(got) == len(want)


def test_bulk_decoding(spark, export, tmp_path):
    path, _ = export
    assert bulk.scan_unmapped(spark, path).count() == 0
    assert "O’Mara 3" in {r.Name for r in bulk.read_bulk_tsv(spark, path).collect()}
    bad = tmp_path / "bad.txt"
    bad.write_bytes(b"ID\tName\r\n1\tx\x81y\r\n")
    assert bulk.scan_unmapped(spark, str(bad)).first()["n"] == 1
    with pytest.raises(ValueError):
        bulk.read_bulk_tsv(spark, str(bad))


def test_short_and_long_records(spark):
    r = spark.createDataFrame([("f", 1, 1, "1\t2"), ("f", 2, 1, "1\t2\t3"), ("f", 3, 2, "1\t2\t3\t4")], "file string, record int, lines int, text string")
    ok, bad = bulk.split_admit_quarantine(r, 3)
    assert {x.record: x.fields for x in ok.collect()} == {1: ["1", "2", ""], 2: ["1", "2", "3"]}
    assert [x.record for x in bad.collect()] == [3]
    assert bulk.in_quarantine(bad, spark.createDataFrame([("4",), ("9",)], "id string"), "id").count() == 1
    bulk.assert_accounting(spark.range(4), r)
    with pytest.raises(ValueError):
        bulk.assert_accounting(spark.range(5), r)


def test_receipts_checks(spark):
    rows = spark.createDataFrame([("1", "a"), (" ", ""), ("2", "b")], "committee string, name string")
    got = bulk.read_receipts(rows, ["committee", "name"], "committee")
    assert got.count() == 2 and got.first()["several_committees"]
    with pytest.raises(ValueError):
        bulk.read_receipts(rows, ["amount"], "committee")
    with pytest.raises(ValueError):
        bulk.read_receipts(rows.filter("name = ''"), ["committee", "name"], "committee")


def test_reference_table_names_its_lines(spark, tmp_path):
    path = tmp_path / "ref.tsv"
    path.write_text("# note\nid\tkind\n1\tgood\n2\tbad\n1\tgood\n3\n4 \tgood\n")
    rows, bad = reference.load_reference(spark, str(path), ["id", "kind"], ["id"], {"kind": ["good"]}, {"id": spark.createDataFrame([("1",), ("2",)], "id string")})
    assert rows.count() == 4
    assert {(r.line, r.violation) for r in bad.collect()} == {(4, "kind is not in its vocabulary"), (5, "the key appears twice"), (6, "1 cells, not 2"), (7, "id has edge spaces"), (7, "id is unknown")}
    with pytest.raises(ValueError):
        reference.load_reference(spark, str(path), ["id", "other"], ["id"])


def test_headers_and_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "code int, s2 int, s1 int")
    reference.require_wide_header(df, ["code"], ["s1", "s2"], [])
    for keys in (["s1"], ["s1", "s2", "s3"]):
        with pytest.raises(ValueError):
            reference.require_wide_header(df, ["code"], keys, [])
    with pytest.raises(ValueError):
        reference.require_header(df, ["code"])
    with pytest.raises(ValueError):
        reference.resolve_columns(df, {"x": ["y"]})


def test_races_from_a_boundary_file(spark, tmp_path):
    path = tmp_path / "b.json"
    path.write_text('{"features": [{"properties": {"district": "1A"}}, {"properties": {"name": "2B"}}]}')
    got = {(r.race_id, r.district) for r in reference.races_from_features(spark, str(path), "sb-d", 0).collect()}
    assert got == {("sb-d1a", "1A"), ("sb-d2b", "2B")}


def test_publish_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    t = lambda n: {"t": spark.range(n).toDF("id")}
    sinks.publish(spark, t(3), path, "v1", lambda tables: None)

    def refuse(tables):
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.publish(spark, t(5), path, "v2", refuse)
    assert sinks.current(spark, path, "t").count() == 3
    sinks.publish(spark, t(5), path, "v3", lambda tables: None)
    assert sinks.current(spark, path, "t").count() == 5


def test_files_by_key_and_shards(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (1, "c", 7)], "committee int, name string, amount int")
    sinks.write_per_key(df, str(tmp_path / "k"), "committee", ["name", "amount"])
    assert spark.read.option("header", True).csv(str(tmp_path / "k" / "by_committee=1")).count() == 2
    sinks.write_shards({"slim": (df, ["committee", "amount"])}, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s" / "slim")).columns == ["committee", "amount"]


def test_a_key_has_one_file_unless_its_rows_are_many(spark, tmp_path):
    df = spark.range(3000).select((F.col("id") % 20).alias("k"), "id").unionByName(spark.range(3000, 4000).select(F.lit(None).cast("long").alias("k"), "id")).repartition(8)
    sinks.write_per_key(df, str(tmp_path / "k"), "k", ["id"], rows_a_file=150)
    files = collections.Counter(f.parent.name for f in (tmp_path / "k").glob("*/*.csv"))
    assert {files.pop(f"by_k={k}") for k in range(20)} == {1} and [*files] == ["by_k=__HIVE_DEFAULT_PARTITION__"] and 1 < files["by_k=__HIVE_DEFAULT_PARTITION__"] <= 7
    back = spark.read.option("header", True).schema("id long, by_k long").csv(str(tmp_path / "k"))
    assert sorted(map(tuple, back.select("by_k", "id").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_footprints_keep_counted_parts(spark, monkeypatch):
    """Facts by donor are summed in parts that follow their rows; small parts are not merged."""
    from civicspark.operators import views
    from civicspark.plans import registry

    query, rows = registry.QUERIES["ag40_footprint"], spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    monkeypatch.setattr(views, "PART_ROWS", 500, raising=False)
    assert query(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == -(-rows // 500) > 4


def test_donor_lists_read_line_items_once(spark):
    """What is said of donors comes from written lists; line items are read again for the items only."""
    from civicspark.plans import registry

    plan = registry.QUERIES["dq16_donor_lists"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [" in line and "l_suppkey" in line for line in plan.splitlines()) == 1


def test_matched_facts_keep_their_parts(spark):
    """Facts of many filers stay in as many parts as a shuffle has, however small these are."""
    facts = spark.range(2000).select((F.col("id") % 100).alias("committee_id"), F.lit(d("2020-02-01")).alias("date"), F.lit(1).cast("decimal(18,2)").alias("amount"), F.lit("a").alias("contribution_type"))
    periods = spark.range(50).select(F.col("id").alias("committee_id"), F.lit(d("2020-01-01")).alias("beg"), F.lit(d("2020-03-31")).alias("fin"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        m = filings.matched_facts(periods, facts, ["a"], "b", F.lit(False))
        assert m.rdd.getNumPartitions() == 16
        assert {(r.committee_id, r.beg, int(r.itemised)) for r in m.collect()} == {(i, d("2020-01-01") if i < 50 else None, 20) for i in range(100)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_vote_rules_tell_an_absent_roster_from_an_empty_one(spark):
    votes = spark.createDataFrame([(1, "2024-01-02", '["x"]'), (2, None, None)], "vote_id long, date string, type string")
    meta = spark.createDataFrame([("a", 1, None), ("b", 9, True)], "code string, vote_id long, reverse_coded boolean")
    positions = spark.createDataFrame([(1, 5)], "vote_id long, seat long")
    roster = spark.createDataFrame([(4, "a"), (4, "z")], "seat long, code string")
    declared = spark.createDataFrame([(2,)], "term_votes long")

    def run(r):
        return {(v.rule, v.key, v.detail) for v in validators.vote_rules(votes, meta, positions, r, declared).collect()}

    base = {("vote is dated", "2", ""), ("featured vote resolves", "b", ""), ("retired field is absent", "b", "")}
    assert run(roster) == base | {("code resolves", "z", ""), ("seat resolves", "5", "")}
    assert run(None) == base | {("roster is there", "roster", "absent")}
    assert run(roster.limit(0)) == base | {("roster is there", "roster", "empty")}
