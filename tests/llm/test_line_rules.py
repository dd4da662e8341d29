"""Quality rules over lines that documents of a host share."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from civicspark.llm import line_rules, queries

from ..compare import assert_same, connect
from .test_llm import LONG, SF, ascii_lower, awkward, awkward_rows, empty, words  # noqa: F401


def plain_measures(text):
    text = text or ""
    found = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = collections.Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    inside = {k for i in range(len(found) - 7) if windows[tuple(found[i : i + 8])] > 1 for k in range(i, i + 8)}
    return {"n_words": len(found), "word_chars": sum(map(len, found)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside)}


def plain_rules(rows, percent=2, least=10):
    """rows: (id, host, text), in their order."""
    texts, holds = collections.defaultdict(set), collections.defaultdict(set)
    norm = lambda line: " ".join(words(ascii_lower(line)))
    for _, host, text in rows:
        texts[host].add(text or "")
        for line in {norm(x) for x in (text or "").split("\n")} - {""}:
            holds[host, line].add(text or "")
    often = {k for k, v in holds.items() if len(v) > least and len(v) * 100 > percent * len(texts[k[0]])}
    out = []
    for doc, host, text in rows:
        m = plain_measures(text)
        gone = sum(len(norm(x).split(" ")) for x in (text or "").split("\n") if (host, norm(x)) in often)
        failed = m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]
        left = "\n".join(x for x in (text or "").split("\n") if (host, norm(x)) not in often)
        out.append((doc, m, gone, failed, not failed and 2 * gone <= m["n_words"], left))
    return out


def as_tuples(df):
    return collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.removed_words, r.base_failed, r.kept) for r in df.collect())


def test_rules_equal_sql(spark):
    assert_same(queries.op13_line_rules(spark, SF), connect(SF), queries.ORACLE_SQL["op13_line_rules"])


def family():
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    rows = [(i, "a", f"{body(i)}\nSubscribe  to our\tNewsletter!\nown line {i}") for i in range(14)]
    rows += [(100 + i, "a", "SUBSCRIBE to our newsletter!\n" * 8 + body(i)[:40]) for i in range(2)]  # little else
    rows += [(200 + i, "a", f"{body(77)}\nonly copies hold this line") for i in range(40)]  # one text
    rows += [(300 + i, "b", f"{body(300 + i)}\nsubscribe to our newsletter!") for i in range(9)]  # too few there
    rows += [(400 + i, None, f"{body(400 + i)}\nno host at all") for i in range(12)]
    rows += [(500, "a", None), (None, "a", body(500)), (501, "", f"{body(501)}\nno host at all"), (502, "a", ("lorem ipsum dolor sit " * 9 + "\n") * 500)]
    return rows


@pytest.mark.parametrize("most", [line_rules.BROADCAST_HASHES, 0])
def test_rules_by_host(spark, monkeypatch, most):
    monkeypatch.setattr(line_rules, "BROADCAST_HASHES", most)
    rows = family()
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    expected = plain_rules(rows)
    want = collections.Counter((doc, *m.values(), gone, failed, kept) for doc, m, gone, failed, kept, _ in expected)
    assert as_tuples(line_rules.line_rules(docs)) == want
    by_id = {r[0]: r for r in expected}
    assert by_id[0][2] == 4 and by_id[0][4] and by_id[200][2] == by_id[300][2] == 0 and by_id[400][2] == 4 and not by_id[100][4] and by_id[501][2] == 0
    left = {r.doc_id: r.text for r in line_rules.cleaned(docs).collect()}
    assert left == {doc: text for doc, _, _, _, kept, text in expected if kept}
    assert line_rules.cleaned(docs).columns == docs.columns


def test_rules_awkward(spark, awkward, empty):  # noqa: F811
    rows = [(r[0], r[3], r[1]) for r in awkward_rows()]
    want = collections.Counter((doc, *m.values(), gone, failed, kept) for doc, m, gone, failed, kept, _ in plain_rules(rows))
    assert as_tuples(line_rules.line_rules(awkward)) == want
    assert line_rules.line_rules(empty).count() == line_rules.cleaned(empty).count() == 0
    assert line_rules.cleaned(awkward).columns == awkward.columns
    clash = awkward.select("*", F.lit(1).alias("_host"), F.lit(2).alias("n_words"), F.lit(3).alias("_known"), F.lit(4).alias("line"), F.lit(5).alias("_words"))
    assert as_tuples(line_rules.line_rules(clash)) == want and line_rules.cleaned(clash).columns == clash.columns


def test_repeats_in_a_very_long_text(spark):
    text = LONG + " ".join(f"u{i % 900}" for i in range(20_000))
    row = line_rules.line_rules(spark.createDataFrame([(1, "s", text)], "doc_id long, source string, text string")).first()
    assert {k: row[k] for k in plain_measures("")} == plain_measures(text)
