"""The training-data operators against plain versions, on the smallest tables and on awkward rows."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from civicspark.llm import exact_dedup, html_text, media, mixing, near_dedup, packing, quality, queries, suffix_dedup, token_counts, warc

from ..compare import assert_same, connect

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, score string, node string, run string, _row string, bin string, _gone string, _stays string, _node string, _partly string"
WORD_MODEL, PIECE_MODEL = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = "lorem ipsum, Dolor! " * 4000


def awkward_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties, and columns named like our own."""
    texts = [None, "", " \t\n", "one", "Same words Here and There", "same words here and there", LONG, LONG, "ÄÖ ß 漢字 \x00 x", "a b c d e f g h"]
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None, "k", "x", "n", "r", "w", "b", "g", "s", "o", "p") for i, t in enumerate(texts)]
    return rows + [rows[3], rows[9], (None, "null id", *[None] * 13), (None,) * 15]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# 1


def test_quality_held_out(spark):
    rows = queries.op1_quality(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.9


def test_quality_gradients():
    draw = np.random.default_rng(1)
    w = {"E": draw.normal(0, 0.3, (5, 4)), "e": draw.normal(0, 0.3, 4), "V": draw.normal(0, 1, (4, 3)), "U": draw.normal(0, 1, (4, 3)), "a": draw.normal(0, 1, 3), "c": draw.normal(0, 1, 4), "d": np.array([0.1])}
    x, starts, y = draw.normal(0, 1, (7, 5)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])

    def loss(w):
        p = quality._forward(w, x, starts)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = quality._gradients(w, x, starts, y)
    for k in w:
        for i in range(min(4, w[k].size)):
            up, down = ({**w, k: w[k].copy()} for _ in range(2))
            up[k].flat[i] += 1e-5
            down[k].flat[i] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - grads[k].flat[i]) < 1e-6


def test_quality_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(3, 1), (9, 0), (9, 0), (None, 1), (4, None)], "doc_id long, quality int")
    rows = quality.classify(awkward, labels).collect()
    assert len(rows) == len(awkward_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(empty, labels).count() == 0
    none = quality.classify(awkward, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.accepted(awkward, labels.limit(0)).columns == awkward.columns


def test_quality_fit_is_bounded_in_passages(spark):
    """Documents of 1 MB are learned from by passages over all of their text, and all passages stay within the bound."""
    texts = {i: ("word " * 200_000) if i % 3 == 0 else ("Plain text, a sentence. " * 40 if i % 2 else "$$ 4711 ||| " * 40) for i in range(24)}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    seen = {i for i in texts if zlib.crc32(str(i).encode()) % 5}
    for most, expected in ((24_000, len(seen)), (100, len(seen)), (7, 7)):
        chosen, _ = quality._sample(docs, labels, "doc_id", "text", "quality", 6_000, most)
        assert chosen.count() == expected and {r.id for r in chosen.collect()} <= seen
    rows = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    short = {i for i in seen if i % 3}
    assert len(rows) == 24 and min(rows[i] for i in short if i % 2) > max(rows[i] for i in short if i % 2 == 0)


def test_quality_learns_a_label_that_only_long_texts_have(spark):
    """Texts of over a hundredth of all passages are alike in their bytes; they differ in their last third, or in length."""
    plain = lambda n: "Plain text, a sentence. " * n
    texts = {i: plain(12_000) + "$$ 4711 ||| " * 12_000 if i % 2 else plain(24_000 if i % 4 else 40) for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in texts], "doc_id long, quality int")
    rows = {r.doc_id: r.predicted for r in quality.classify(docs, labels).collect()}
    assert rows == {i: 1 - i % 2 for i in texts}


# 2


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3 * sizes[s] for s in over}


def test_mixing(spark, texts):
    rows = queries.op2_mixing(spark, SF).collect()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        assert r.size == len(words(texts[r.doc_id])) and 0 <= r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    want = plain_targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(want[source[r.doc_id]]) and r.source_size == sizes[source[r.doc_id]]
    for s in sizes:
        reach = {0}
        for r in rows:
            if source[r.doc_id] == s:
                reach |= {x + r.size for x in reach}
        rounds = int(want[s] // sizes[s])
        assert abs(taken[s] - want[s]) <= min(abs(x + rounds * sizes[s] - want[s]) for x in reach) + 1
    assert sorted(rows) == sorted(queries.op2_mixing(spark, SF).collect())


@pytest.mark.parametrize("seed", range(20))
def test_subset_sum_is_as_near_as_can_be(seed):
    draw = random.Random(seed)
    lengths = np.array(draw.sample(range(1, 30), 5))
    copies = np.array([draw.randint(0, 3) for _ in lengths])
    budget = draw.randint(1, 80)
    reach = {0}
    for size, n in zip(lengths, copies, strict=True):
        reach = {r + k * int(size) for r in reach for k in range(n + 1)}
    take = mixing.subset_sum(lengths, copies, budget)
    assert (take <= copies).all() and abs(int((take * lengths).sum()) - budget) == min(abs(r - budget) for r in reach)


def test_mixing_deals_frequent_lengths(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANK_ROWS", 7)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 300, "hot").otherwise("b").alias("source"))
    got = {r.source: r.n for r in mixing.mix(docs).groupBy("doc.source").agg(F.sum(F.col("size") * F.col("repeats")).alias("n")).collect()}
    assert got == {"b": 400 * 3 // 3, "hot": 800} or abs(got["b"] - 400) <= 3 and abs(got["hot"] - 800) <= 3


def test_mixing_awkward(awkward, empty):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == len(awkward_rows()) and all(0 <= r.repeats <= 3 for r in rows)
    assert mixing.mixed_documents(awkward).columns == awkward.columns
    assert mixing.mix(empty).count() == 0


# 3


def test_html_text_of_the_tables(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op3_html_text(spark, SF).collect():
        article = pages[r.page_id].split("<article>")[1].split("</article>")[0].replace("<br>", " ").replace("<b>", "").replace("</b>", "")
        want = "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", article)) if t)
        assert (r.text, r.n_chars) == (want, len(want))


def test_html_marginals_are_exact():
    """Sum-product against the sum over all labellings of a small tree."""
    model = html_text.default_model()
    nodes = html_text.parse("<div class=ad><p>Buy now</p></div><article><p>Some words here.</p></article>")
    weights = np.zeros((len(nodes), 2))
    for labels in np.ndindex(*[2] * len(nodes)):
        p = model.root[labels[0]]
        for i, n in enumerate(nodes):
            p *= model._local(n)[labels[i]] * (model._edge[model._joint(n)][labels[n.parent]][labels[i]] if i else 1)
        for i, y in enumerate(labels):
            weights[i, y] += p
    assert np.allclose(model.marginals(nodes), weights[:, 1] / weights.sum(axis=1))


def test_html_leaves_the_rest_out():
    page = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><header class="site"><a href=/>Home</a></header><nav><ul><li><a href=1>News</a><li><a href=2>Sport</a></ul></nav>
      <div class="cookie-notice"><p>We use cookies.</p></div><main><article><h1>A  title &amp; more</h1><p>First paragraph of the story, with <a href=3>a link</a> in it and more words after that.</p>
      <aside class="related"><ul><li><a href=4>Other story</a></li></ul></aside><p>Second&nbsp;paragraph,<br>on two lines, with enough words to be one.</p></article>
      <section class="comments"><h3>Comments</h3><p>I do not agree with this at all, says a reader.</p></section></main><form><p>Subscribe to us</p></form><footer>&copy; 2024 Someone</footer></body></html>"""
    assert html_text.main_text(page, html_text.default_model()) == "A title & more\nFirst paragraph of the story, with a link in it and more words after that.\nSecond paragraph, on two lines, with enough words to be one."


STORY = "The council voted on the plan late on Tuesday, after two hours of debate in a full room."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>x</title><meta charset=utf-8><body><article><p>{STORY}</p></article></body></html>",
        f"<html><head><title>x</title><article><p>{STORY}</p></article>",
        f"<body><div><button class=menu>Menu</div><article><p>{STORY}</p></article><div><button>Send</button></div></body>",
        f"<body><button>Menu<article><p>{STORY}</p></article></body>",
        f"<body><select><option>One<option>Two<article><p>{STORY}</p></article><button>Send</button></body>",
        f"<body><noscript>Turn on scripts<article><p>{STORY}</p></article></body>",
        f"<body><svg><text>Logo</text><article><p>{STORY}</p></article></body>",
        f"<body><template>Row<article><p>{STORY}</p></article></body>",
        f"<body><article><p>{STORY[:30]}<button>Share <b>it</b></button>{STORY[30:]}</p></article></body>",
        f"<body><button><div>Menu</div></button><article><p>{STORY}</p></article></body>",
    ],
)
def test_html_unclosed_elements_keep_the_story(page):
    assert html_text.main_text(page, html_text.default_model()) == STORY


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><div title=don't><p>{STORY}</p></div><p class='x'>{STORY}</p></article>", f"{STORY}\n{STORY}"),
        (f"<article><a title=\"x > y\" href = 'a>b'>{STORY}</a> <i data-a=b\"c>{STORY}</i></article>", f"{STORY} {STORY}"),
        (f"<article><h1>A day</h1><p>{STORY}</p><ul><li>one</li><li>two</li></ul><p>{STORY}</p></article>", f"A day\n{STORY}\none\ntwo\n{STORY}"),
        (f"<article><p>{STORY}</p><p><a href=x>{STORY}</a></p><p><a href=x>More here</a></p></article>", f"{STORY}\n{STORY}\nMore here"),
        (f"<article><h1>A day</h1><p>{STORY}</p></article><div id=x9><h3>3 Comments</h3><p>{STORY}</p><p>I don't agree.</p></div>", f"A day\n{STORY}"),
        (f"<main><article><h1>A day</h1><p>{STORY}</p></article><div id=x9><div><b>Ann</b> says:<p>{STORY}</p></div><div><b>Bob</b> says:<p>No.</p></div></div></main>", f"A day\n{STORY}"),
    ],
)
def test_html_of_pages_off_the_common_layouts(page, text):
    assert html_text.main_text(page, html_text.default_model()) == text


SECOND = "It passed by a single vote, and the mayor said that it would be signed at once."


@pytest.mark.parametrize("name", ["post tag-politics", "post category-notice", "post meta", "tag-politics", "post", "x1", "comment-policy", "sponsored", "tags", "newsletter", "related", "alert", "post comments-open has-sidebar", "post-12 post type-post status-publish hentry category-sports tag-ads"])
def test_html_articles_keep_their_text_whatever_their_name(name):
    for body, text in ((f"<p>{STORY}</p>", STORY), (f"<h1>A day</h1><p>{STORY}</p><p>{SECOND}</p>", f"A day\n{STORY}\n{SECOND}")):
        assert html_text.main_text(f'<nav><a href=/>Home</a></nav><article class="{name}">{body}</article><footer>&copy; Someone</footer>', html_text.default_model()) == text
        assert html_text.main_text(f'<article class="{name}">{body}</article>', html_text.default_model()) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div class='legal-text'>{STORY} {SECOND}</div>", f"{STORY} {SECOND}"),
        (f"<div class='print'><p>{STORY}</p></div>", STORY),
        (f"<div class='tag-politics'><p>{STORY}</p></div>", STORY),
        (f"<article><p>{STORY}</p><section class='more-text'><p>{SECOND}</p></section></article>", f"{STORY}\n{SECOND}"),
        ("<article><p>First things.</p><h2>Comments</h2><p>Second.</p></article>", "First things.\nComments\nSecond."),
        (f"<article><p>{STORY}</p><h2>Related work</h2><p>{SECOND}</p></article>", f"{STORY}\nRelated work\n{SECOND}"),
        ("<article><p>Comments on the ruling were few.</p></article>", "Comments on the ruling were few."),
        (f"<!--><article><p>{STORY}</p></article>", STORY),
        (f"<!---><article><p>{STORY}</p></article>", STORY),
        (f"<!-- <p>old</p> --!><article><p>{STORY}</p></article><!-- a -- b > c -->", STORY),
        ("<article><p>one <b>two</b></p><p>three<br>four</p><p>fi<wbr>ve</p><pre>six\n seven</pre><p>eight<script>x()</script> nine</p></article>", "one two\nthree four\nfive\nsix seven\neight nine"),
        ("<article><h1>Title</h1><p>Tiny</p></article>", "Title\nTiny"),
        ("<article><h1>Share</h1><p>Yes.</p></article>", "Share\nYes."),
        (f"<div class='sponsored'><p>{SECOND}</p></div><article><p>{STORY}</p></article>", STORY),
        (f"<article><p>{STORY}</p><div class='post-tags'><a href=1>x</a> <a href=2>y</a></div></article><div class='related-posts'><h3>Related posts</h3><ul><li><a href=x>Other</a></li></ul></div>", STORY),
        (f"<div id='main'><div class='share'>Share this</div><p>{STORY}</p></div>", STORY),
        ("<nav><ul><li><a href=1>A</a><li><a href=2>B</a></ul></nav><div class=ad>Buy now at the shop.</div><form><p>Send</p></form><footer>&copy; Someone</footer>", ""),
    ],
)
def test_html_of_ordinary_names_headings_and_comments(page, text):
    assert html_text.main_text(page, html_text.default_model()) == text


def test_html_unfinished_tags_take_linear_time():
    assert html_text.main_text(f"<article><p>{STORY}</p></article><a " + 'x="1" ' * 50_000, html_text.default_model()).startswith(STORY)


def test_html_formulas_and_objects_stay():
    page = f"<article><p>{STORY} It is <math><mi>a</mi><mo>=</mo><mi>b</mi></math> here.</p><object data=x><p>{STORY}</p></object><p>{STORY}</p></article>"
    assert html_text.main_text(page, html_text.default_model()) == f"{STORY} It is a=b here.\n{STORY}\n{STORY}"


def test_html_held_out_labels():
    """Of the runs of drawn pages that the model hasn't seen: how many of its own are content, and of content its own."""
    model, draw, seen = html_text.default_model(), random.Random(77), collections.Counter()
    for _ in range(400):
        nodes = html_text.parse(html_text.labelled_page(draw))
        found = {id(n) for n in html_text.chosen(nodes, model)}
        seen.update((id(n) in found, n.gold != 0) for n in nodes if n.tag[0] == "#")
    assert seen[True, True] / (seen[True, True] + seen[True, False]) > 0.99 and seen[True, True] / (seen[True, True] + seen[False, True]) > 0.99


def test_html_awkward(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (None, "u", "plain text only, no tags at all here."), (5, "u", "<p>x" * 3000), (5, "u", "<!-- <p>never ends"), (6, "u", "<a <b <<p>broken</p> & &#x41; &bogus;")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_text.extract(pages).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got) and got[0].text == "" and got[3].text.startswith("plain")
    assert html_text.extract(pages.limit(0)).count() == 0


# 4


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def check_warc(rows, pages, least=0):
    first = {}
    for k, v in sorted(pages.items()):
        first.setdefault(v, k)
    for r in rows:
        data = pages[r.page_id]
        repeat = len(data) >= least and first[data] != r.page_id
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (len(data), digest(data), "revisit" if repeat else "response", first[data] if repeat else None)


def test_warc_of_the_tables(spark):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op4_warc(spark, SF).collect()
    assert len(rows) == len(pages)
    check_warc(rows, pages)


@pytest.mark.parametrize("least", [0, 10])
def test_warc_revisits(spark, least):
    rows = [(4, "http://a b/\n", "<p>same page</p>"), (2, None, "<p>same page</p>"), (9, "u", "<p>same page</p>"), (5, "u", None), (6, "u", ""), (7, "u", "x\r\n\r\ny"), (8, "ü", "ß" * 50000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = warc.roundtrip(pages, min_revisit_bytes=least).collect()
    assert len(got) == len(rows)
    check_warc(got, {k: (h or "").encode() for k, _, h in rows}, least)
    assert warc.roundtrip(pages.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "u", "x"), (None, "v", "x"), (1, "w", "y"), (1, "w", "y"), (None, "w", "y")], "page_id long, url string, html string")
    assert sorted((r.page_id is None, r.record_type, r.refers_to or 0) for r in warc.roundtrip(nulls).collect()) == [(False, "response", 0), (False, "response", 0), (True, "response", 0), (True, "response", 0), (True, "revisit", 1)]


@pytest.mark.parametrize("version", [1, 2])
def test_warc_refers_to_pages_with_odd_urls(spark, version):
    """The page that others revisit has a URL with white space, of "-", none, or none at all, in archives of both versions."""
    odd = ["http://a b/", "-", None, "", "\u3000x\t", " ", "http://e.example/\u0085"]
    rows = [(10 * i + k, url if k == 1 else "http://plain/", f"<p>{i}</p>") for i, url in enumerate(odd) for k in (1, 2, 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.roundtrip(pages, version=version).collect()
    assert len(got) == len(rows)
    check_warc(got, {k: h.encode() for k, _, h in rows})


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    head = warc.arc_head("x.arc", version, "20240101000000")
    data = head + warc.arc_record("http://e.example/a", b"HTTP/1.1 200 OK\r\n\r\nbody\nwith lines\n", version, "20240101000000", "x.arc", len(head)) + warc.arc_record("u", b"", version, "20240101000000", "x.arc", 0)
    got = list(warc.parse_arc(data))
    assert [r["block"] for r in got] == [b"HTTP/1.1 200 OK\r\n\r\nbody\nwith lines\n", b""] and got[0]["URL"] == "http://e.example/a"
    for bad in (data[:-3], data.replace(b"text/html", b"text html", 1)):
        with pytest.raises(ValueError):
            list(warc.parse_arc(bad))


def test_warc_checks_bite():
    record = warc.warc_record("response", "<urn:x>", "2024-01-01T00:00:00Z", "u", b"block")
    assert list(warc.parse_warc(warc._member(record)))[0][1] == b"block"
    with pytest.raises(ValueError):
        list(warc.parse_warc(warc._member(record.replace(b"block\r\n", b"blocc\r\n"))))


# 5


def check_packing(rows, texts, size=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_MODEL)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    total = 0
    for k, t in texts.items():
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        want = [(i, i * size, len(ids[i * size : (i + 1) * size]), zlib.crc32(ids[i * size : (i + 1) * size].tobytes())) for i in range(-(-len(ids) // size))]
        assert sorted(by_doc[k]) == want
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence), -(-total // size)


def test_packing(spark, texts):
    used, least = check_packing(queries.op5_packing(spark, SF).collect(), texts)
    assert used <= least + 1


def test_packing_in_rounds(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    used, least = check_packing(packing.pack(docs, WORD_MODEL, group_items=25).collect(), texts)
    assert used <= 1.1 * least


def test_packing_awkward(spark, awkward, empty):
    rows = packing.pack(awkward.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), WORD_MODEL, size=64)
    check_packing(rows.collect(), {r[0]: r[1] for r in awkward_rows() if r[0] is not None}, 64)
    assert packing.pack(awkward, WORD_MODEL).filter("doc_id IS NULL").count() == 2
    assert packing.pack(empty, WORD_MODEL).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma, delta!")], "doc_id long, text string")
    packed = packing.pack(docs, WORD_MODEL)
    ids = packing.sequences(packed, packing.pieces(docs, WORD_MODEL, with_ids=True)).collect()
    assert len(ids) == 1 and len(ids[0]["ids"]) == 4 * packed.agg(F.sum("length")).first()[0]


def test_word_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, words = Tokenizer.from_file(WORD_MODEL), packing._WordIds.of(WORD_MODEL)
    for t in ["It's a don't, x.. y., z,, <|endoftext|>. <|ENDOFTEXT|> a<|endoftext|>, 12.5, a1, É. é, ß. ΑΣ ΣΑΣ, 'S 'll, I'LL. they'd.", "", "\x1c\x85 a b, c　d. e f", "Á, á.", "İ. i, ﬁ ﬂ.", "don.t a.b, .a ,a . , .. ,, -. ÀÉÎ!! ÿ%% ×× ÷ ª º µ a_b _ ^ `x` [a] {b}~ \\ / a/b ß$$ \x00 \x7f \xad a\xadb"]:
        assert np.frombuffer(words.encode(t.encode()), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


# 6


def test_token_counts(spark, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for r in queries.op6_token_counts(spark, SF).collect():
        n = len(model.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_token_counts_awkward(awkward, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rows = token_counts.token_counts(awkward, PIECE_MODEL).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(model.encode(r[1] or "")) for r in awkward_rows())
    assert token_counts.token_counts(empty, PIECE_MODEL).count() == 0
    counts = token_counts.WordCounts(token_counts.load_ranks(PIECE_MODEL))
    for t in ["  a  b ", "\n\n a", "ﬁ ① Å", "\t x", "<s> hi </s>", "▁x ▁▁", "　x y\xa0z", " ", "     " * 9, "aaaaaaaaaaaaaaaa", "!!!!????....", "😀 é", "<0x41>"]:
        assert token_counts.count_text(t, counts) == len(model.encode(t)), t


# 7


def plain_repeats(texts, least=50):
    seen, out = {}, set()
    cut = {k: (t or "").encode().split() for k, t in texts.items()}
    for k, w in cut.items():
        for i in range(len(w) - least + 1):
            g = tuple(w[i : i + least])
            seen[g] = k if seen.get(g, k) == k else -1
    for k, w in cut.items():
        spans = []
        for i in range(len(w) - least + 1):
            if seen[tuple(w[i : i + least])] == -1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + least
                else:
                    spans.append([i, i + least])
        out |= {(k, a, b, b - a) for a, b in spans}
    return out


@pytest.mark.parametrize("setting", [{}, {"TOGETHER": 5}, {"BROADCAST_RUNS": -1}])
def test_repeated_passages(spark, texts, monkeypatch, setting):
    for k, v in setting.items():
        monkeypatch.setattr(suffix_dedup, k, v)
    got = {tuple(r) for r in queries.op7_suffix_dedup(spark, SF).collect()}
    assert got == plain_repeats(texts)


def test_repeated_passages_confounded(spark):
    """Short passages that many share, each with longer ones that few share, on either side."""
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    core = [word() for _ in range(35)]
    before, after = [[word() for _ in range(30)] for _ in range(4)], [[word() for _ in range(30)] for _ in range(4)]
    texts = {}
    for i in range(60):
        b, a = draw.choice(before)[draw.randint(0, 30) :], draw.choice(after)[: draw.randint(0, 30)]
        texts[i] = " ".join([word() for _ in range(draw.randint(0, 40))] + b + core + a + [word() for _ in range(draw.randint(0, 40))])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {tuple(r) for r in suffix_dedup.repeated_passages(docs).collect()} == plain_repeats(texts)


def test_repeated_passages_awkward(awkward, empty):
    got = {(r.doc_id, r.start, r.stop) for r in suffix_dedup.repeated_passages(awkward).collect()}
    assert got == {(6, 0, 12000), (7, 0, 12000)}
    assert suffix_dedup.repeated_passages(empty).count() == 0


# 8


def test_media(spark, texts):
    for r in queries.op8_media(spark, SF).collect():
        data = texts[r.doc_id].encode()
        padded = data + b" " * (max(1, -(-len(data) // 192)) * 192 - len(data))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    data = np.random.default_rng(kind).integers(0, 256, 192 * 9, np.uint8).tobytes()
    png = media.to_png(data, kind)
    assert media.from_png(png) == data
    for at in (1, 20, len(png) // 2, len(png) - 6):
        with pytest.raises((ValueError, zlib.error)):
            media.from_png(png[:at] + bytes([png[at] ^ 1]) + png[at + 1 :])


def test_png_mixed_filters():
    rows = np.random.default_rng(3).integers(0, 256, (10, 192), np.uint8)
    kinds = np.array([2, 2, 1, 0, 4, 3, 3, 2, 1, 4], np.uint8)
    filtered = np.stack([media.filter_rows(rows, int(k))[i] for i, k in enumerate(kinds)])
    assert (media.unfilter(filtered, kinds) == rows).all()


def test_stored_images_use_several_filters(spark):
    """Prose keeps filter none; ramps and repeated rows don't. All read back as they were."""
    ramp = "".join(chr(33 + i // 3 % 90) for i in range(192))
    repeated = "".join(random.Random(1).choice("abcdefghij") for _ in range(192)) * 6
    texts = ["Plain prose that says nothing much, once more. " * 9, ramp * 2 + repeated, "x" * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = set()
    for r in media.encode_media(docs).collect():
        at = r.media.index(b"IDAT")
        size = int.from_bytes(r.media[at - 4 : at], "big")
        kinds |= set(zlib.decompress(r.media[at + 4 : at + 4 + size])[:: media.ROW + 1])
    assert kinds == {0, 1, 2}
    back = {r.doc_id: r.payload for r in media.decode_media(media.encode_media(docs), with_payload=True).collect()}
    assert all(bytes(back[i]) == media.pad(t.encode()) for i, t in enumerate(texts))


def test_low_frequency_hash_is_near_for_near_images():
    data = np.random.default_rng(8).integers(0, 256, 192 * 64, np.uint8)
    near = data.copy()
    near[::97] ^= 1
    bits = lambda x: np.unpackbits(np.frombuffer(media.low_frequency_hash(x.tobytes()), np.uint8))
    assert (bits(data) != bits(near)).sum() <= 4 < (bits(data) != bits(data[::-1].copy())).sum()


def test_media_awkward(awkward, empty):
    rows = media.media_features(awkward).collect()
    assert len(rows) == len(awkward_rows()) and len({r.feature for r in rows if r.n_bytes == 0}) == 1
    assert media.media_features(empty).count() == 0


# 9


def plain_components(texts):
    sets = {}
    for k, t in texts.items():
        w = words(ascii_lower(t))
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(k, len(sets[k]), find(k), find(k) == k) for k in texts}


def test_near_dedup(spark, texts):
    assert {tuple(r) for r in queries.op9_near_dedup(spark, SF).collect()} == plain_components(texts)


def test_near_dedup_of_a_large_family(spark):
    """Many near copies of one text, close to the threshold, with exact copies among them."""
    draw = random.Random(6)
    base = [f"w{draw.randint(0, 9999)}" for _ in range(150)]
    texts = {}
    for i in range(150):
        copy = list(base)
        for _ in range(draw.choice([0, 0, 1, 2, 3, 4, 5])):
            copy[draw.randrange(150)] = f"x{draw.randint(0, 9999)}"
        texts[i] = " ".join(copy).upper() if i % 7 == 0 else "\n".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {tuple(r) for r in near_dedup.near_components(docs).collect()} == plain_components(texts)


def templated(draw, count, shared, own, families=0):
    """Texts of shared words and own ones; the last families of them have two near copies each."""
    template = [f"t{draw.randint(0, 99999)}" for _ in range(shared)]
    texts = [[*template[:20], *[f"u{draw.randint(0, 10**9)}" for _ in range(own)], *template[20:]] for _ in range(count)]
    for t in texts[len(texts) - families :]:
        for k in (2, 3):
            texts.append([*t[:-k], *[f"c{draw.randint(0, 10**9)}" for _ in range(k)]])
    return {i: " ".join(t) for i, t in enumerate(texts)}


def test_near_dedup_of_templated_texts(spark, monkeypatch):
    """Texts with similarity 0.5 by a template share bands but no rare shingles; near copies among them do."""
    made = templated(random.Random(8), 150, 400, 195, families=12)
    docs = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    asked, compared = [], near_dedup._pairs
    monkeypatch.setattr(near_dedup, "_pairs", lambda *a: asked.append(compared(*a)) or asked[-1])
    monkeypatch.setattr(near_dedup, "DIRECT", 4)
    assert {tuple(r) for r in near_dedup.near_components(docs).collect()} == plain_components(made)
    assert len(asked) == 2 and sum(a.count() for a in asked) <= 4 * len(made)


@pytest.mark.parametrize("seed", range(3))
def test_rare_shingles_bring_all_near_sets_together(spark, monkeypatch, seed):
    """Every pair at 0.75 or more shares a chosen shingle, over sets of all kinds of overlap."""
    monkeypatch.setattr(near_dedup, "DIRECT", 0)
    draw = random.Random(seed)
    base = [[f"w{draw.randint(0, 40)}" for _ in range(60)] for _ in range(3)]
    made = {}
    for i in range(90):
        t = list(draw.choice(base))
        for _ in range(draw.choice([0, 1, 1, 2, 3, 4])):
            t[draw.randrange(len(t))] = f"x{draw.randint(0, 30)}"
        made[i] = " ".join(t[: draw.choice([60, 60, 58, 52, 45])])
    docs = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    signed = near_dedup.materialise(near_dedup.signatures(docs, "doc_id", "text"), "t").filter("n > 0")
    nodes = near_dedup.materialise(signed.groupBy("node").agg(F.first("n").alias("n"), F.first("node").alias("root"), F.min("id").alias("id")), "t")
    sets = near_dedup.materialise(near_dedup._sets(docs, "doc_id", "text", nodes), "t")
    rare = near_dedup.rare_shingles(nodes.drop("id"), sets)
    met = {(bytes(r.a), bytes(r.b)) for r in rare.select("key", F.col("node").alias("a")).join(rare.select("key", F.col("node").alias("b")), "key").filter("a < b").select("a", "b").distinct().collect()}
    grams = {bytes(r.node): set(np.frombuffer(r.grams, np.uint64).tolist()) for r in sets.select("node", "grams").collect()}
    near = {(a, b) for a in grams for b in grams if a < b and 4 * len(grams[a] & grams[b]) >= 3 * len(grams[a] | grams[b])}
    assert near and near <= met
    assert {tuple(r) for r in near_dedup.near_components(docs).collect()} == plain_components(made)


def test_parity_never_refuses_a_near_pair():
    draw = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(draw.integers(0, 1 << 63, draw.integers(5, 400)).astype(np.uint64))
        b = np.unique(np.concatenate([a[draw.random(len(a)) < 0.9], draw.integers(0, 1 << 63, 3).astype(np.uint64)]))
        differ = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in near_dedup.parity(a) ^ near_dedup.parity(b))
        assert differ <= len(np.setxor1d(a, b))


def test_components_of_chains(spark):
    key = lambda i: i.to_bytes(4, "big")
    edges = [(key(i), key(i + 1)) for i in range(60)] + [(key(100 + i), key(200)) for i in range(30)]
    got = {bytes(r.node): bytes(r.root) for r in near_dedup.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert all(got[key(i)] == key(0) for i in range(61)) and got[key(200)] == key(100) and len(got) == 92


def test_near_dedup_awkward(awkward, empty):
    rows = near_dedup.near_components(awkward).collect()
    assert len(rows) == len(awkward_rows())
    by = collections.defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.n_shingles, r.component_id, r.kept))
    assert by[0] == {(0, 0, True)} and by[2] == {(0, 2, True)} and by[5] == {(1, 4, False)} and {c for _, c, _ in by[7]} == {6} and by[3] == {(1, 3, True)}
    assert near_dedup.near_components(empty).count() == 0
    assert near_dedup.drop_near_duplicates(awkward).columns == awkward.columns


@pytest.mark.parametrize(("k", "ids"), [(1, (1, 2)), (5, (1, 2)), (200, (1, 2)), (5, (None, None)), (200, (None, 2)), (40, (7, 7))])
def test_near_dedup_of_repeated_rows(spark, k, ids):
    """k rows each of two near texts and one of another give 2k + 1 results, whatever their ids."""
    base = [f"w{i}" for i in range(100)]
    one, two = " ".join(base), " ".join([*base[:-1], "x"])
    rows = [(ids[0], one)] * k + [(ids[1], two)] * k + [(9, "alone here with some other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    least = min((i for i in ids if i is not None), default=None)
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_components(docs).collect())
    want = collections.Counter()
    for doc in ids:
        want[doc, 96, least, doc == least] += k
    assert got == want + collections.Counter([(9, 2, 9, True)])
    left = near_dedup.drop_near_duplicates(docs).collect()
    assert len(left) == 2 and (9, "alone here with some other words") in {tuple(r) for r in left}


def test_near_dedup_links_rows_without_ids(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(None, " ".join(base)), (7, " ".join([*base[:-1], "x"])), (None, " ".join([*base[:-2], "y", "z"])), (8, "alone here with some other words")]
    got = near_dedup.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got) == [(0, 7, False), (0, 7, False), (7, 7, True), (8, 8, True)]


def test_near_dedup_drops_the_rows_judged(spark):
    base = [f"w{i}" for i in range(100)]
    near = lambda k, tail="": " ".join([*base[:-k], *[f"{tail}x{j}" for j in range(k)]])
    other = lambda tag: " ".join(f"{tag}{i}" for i in range(60))

    def left(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
        return sorted((r[0] or 0, r[1]) for r in near_dedup.drop_near_duplicates(docs).collect())

    # A near copy without an id goes; unrelated rows without ids stay, rows without words too.
    rows = [(7, near(1), "a"), (None, near(2), "b"), (None, other("p"), "c"), (None, other("q"), "d"), (None, "", "e"), (None, None, "f")]
    assert left(rows[:5]) == sorted([(7, near(1)), (0, other("p")), (0, other("q")), (0, "")])
    assert near_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")).count() == 5
    # An id with two texts loses only the near copy.
    assert left([(7, near(1), "a"), (9, near(2), "b"), (9, other("p"), "c")]) == sorted([(7, near(1)), (9, other("p"))])
    # Of copies that all have no id, or one id, one stays.
    got = left([(None, near(1), "a"), (None, near(2), "b"), (None, near(1), "c"), (3, other("p"), "d")])
    assert len(got) == 2 and (3, other("p")) in got
    assert len(left([(5, near(1), "a"), (5, near(2), "b"), (5, near(1).upper(), "c"), (6, near(1), "d")])) == 1
    # One id in two components: each keeps a row.
    assert left([(5, near(1), "a"), (5, other("p"), "b"), (8, other("p"), "c"), (9, near(2), "d")]) == sorted([(5, near(1)), (5, other("p"))])


# 10


def test_exact_dedup_equals_sql(spark):
    assert_same(queries.op10_exact_dedup(spark, SF), connect(SF), queries.ORACLE_SQL["op10_exact_dedup"])


@pytest.mark.parametrize("hash_of", [exact_dedup.content_hash, lambda c: F.substring(F.unhex(F.md5(c)), 1, 0)])
def test_exact_dedup_awkward(awkward, empty, hash_of):
    """The second hash is the same for all texts: bytes still tell them apart."""
    rows = exact_dedup.exact_dedup(awkward, hash_of=hash_of).collect()
    want = collections.defaultdict(list)
    for r in awkward_rows():
        want[ascii_lower(r[1])].append(r[0])
    assert len(rows) == len(awkward_rows())
    sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in want.items()}
    kept = collections.Counter()
    for r in rows:
        ids = [i for i in sha[r.text_sha256] if i is not None]
        assert (r.group_size, r.keep_id) == (len(sha[r.text_sha256]), max(ids, default=None))
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1} and len(kept) == len(want)
    stay = exact_dedup.deduplicate(awkward, hash_of=hash_of)
    assert stay.columns == awkward.columns and stay.count() == len(want)
    assert exact_dedup.exact_dedup(empty, hash_of=hash_of).count() == 0


def test_exact_dedup_keeps_the_smallest_if_asked(awkward):
    assert {r.keep_id for r in exact_dedup.exact_dedup(awkward, keep="min").collect() if r.doc_id in (4, 5)} == {4}


# The pipeline


def plain_score(model, text):
    """One document by loops over its passages: gated attention, then the weighted passage's score."""
    w, hidden, logits = model.w, [], []
    for x in np.asarray(quality.encode((text or "").encode()), float):
        h = np.tanh((x - model.mean) / model.scale @ w["E"] + w["e"])
        gate = 1 / (1 + np.exp(-(h @ w["U"])))
        hidden.append(h)
        logits.append(float(sum(np.tanh(h @ w["V"]) * gate * w["a"])))
    share = [np.exp(v - max(logits)) for v in logits]
    z = sum(p / sum(share) * h for p, h in zip(share, hidden, strict=True))
    return 1 / (1 + np.exp(-(z @ w["c"] + w["d"][0])))


def test_pipeline(spark, texts):
    """Each stage's rows against a plain version on what the stage before it has kept."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    row_of = {r.doc_id: tuple(r) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    stages, seen = [], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = corpus_pipeline.materialise(stage(spark, seen, SF), "test-stage")
        assert seen.columns == docs.columns, name
        rows = [tuple(r) for r in seen.collect()]
        assert all(r == row_of[r[docs.columns.index("doc_id")]] for r in rows), name
        stages.append(collections.Counter(r[docs.columns.index("doc_id")] for r in rows))

    good, single, apart, mixed = stages
    scores = {k: plain_score(model, t) for k, t in texts.items()}
    assert all(abs(v - quality.ACCEPT) > 1e-6 for v in scores.values())
    assert good == collections.Counter(k for k, v in scores.items() if v >= quality.ACCEPT)
    last = {ascii_lower(texts[k]): k for k in sorted(good)}
    assert single == collections.Counter(last.values())
    assert apart == collections.Counter(k for k, _, _, kept in plain_components({k: texts[k] for k in single}) if kept)

    sizes, taken = collections.Counter(), collections.Counter()
    for k in apart:
        sizes[source[k]] += len(words(texts[k]))
        taken[source[k]] += mixed[k] * len(words(texts[k]))
    want = plain_targets(sizes)
    assert set(mixed) <= set(apart) and max(mixed.values()) <= 3
    for s in sizes:
        reach = {0}
        for k in apart:
            if source[k] == s:
                reach |= {x + len(words(texts[k])) for x in reach}
        whole = int(want[s] // sizes[s]) * sizes[s]
        assert abs(taken[s] - want[s]) <= min(abs(x + whole - want[s]) for x in reach) + 1

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_MODEL)
    pieces, total = collections.Counter(), 0
    for k, copies in mixed.items():
        ids = np.array(tokenizer.encode(texts[k] or "", add_special_tokens=False).ids + [0], "<u4")
        total += copies * len(ids)
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            pieces[k, start // 2048, start, len(part), zlib.crc32(part.tobytes())] += copies
    packed = corpus_pipeline.run(spark, SF).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    places = collections.defaultdict(list)
    for r in packed:
        places[r.sequence_id].append((r.offset, r.length))
    for inside in places.values():
        ends = [0]
        for offset, length in sorted(inside):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
    assert len(places) <= -(-total // 2048) + 1


def test_queries_leave_nothing_out():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert isinstance(pd.__version__, str)
