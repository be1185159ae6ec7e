"""Shards, exact search and page wrappers against plain versions."""

import json
import math
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF, SF_SMALL
from verification.compare import difference, duck, oracle_rows
from wattloom.llm import pages, queries, shards, topk

# --- shards -------------------------------------------------------------------------------------


def check_shards(found, texts, n):
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == sorted(
        (repr(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in texts
    )
    by_shard = {}
    for r in found:
        assert 0 <= r["shard"] < n
        by_shard.setdefault(r["shard"], []).append(r)
    for own in by_shard.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    rank = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)
    order = [rank(r) for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order), "contiguous"
    total, largest = sum(r["size"] for r in found), max(r["size"] for r in found)
    for shard in range(n):
        assert abs(sum(r["size"] for r in by_shard.get(shard, [])) - total / n) <= largest


def test_shards_of_documents(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    found = queries.queries()["op5_byte_shards"](spark, SF_SMALL).collect()
    check_shards(found, texts, 40)
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}


def test_shards_of_odd_rows(spark):
    texts = [(1, None), (2, ""), (3, "é" * 100_000), *[(4, "same")] * 300, (None, "none"), (5, "x"), (5, "y")]
    docs = spark.createDataFrame([(d, t, 1, "s") for d, t in texts], "doc_id bigint, text string, size int, shard string")
    check_shards(shards.shard_documents(docs, 7).collect(), texts, 7)
    assert shards.shard_documents(docs.limit(0)).count() == 0


# --- search -------------------------------------------------------------------------------------


def test_top_k_matches_sql(spark):
    columns, expected = oracle_rows(duck(SF), entry.oracle_sql()["op10_exact_top_k"])
    assert difference(queries.queries()["op10_exact_top_k"](spark, SF), columns, expected) is None


def plain_top_k(vectors, k):
    found = []
    for q, a in vectors.items():
        if q % 20:
            continue
        scored = [
            (-sum(math.floor(64 * x) * math.floor(64 * y) for x, y in zip(a, b, strict=True)), c)
            for c, b in vectors.items()
            if c != q and len(a) == len(b)
        ]
        found += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(found)


@pytest.mark.parametrize("blocks", [(4096, 2048), (16, 3)])
def test_top_k_with_ties_and_odd_vectors(spark, blocks):
    draw = np.random.default_rng(8)
    vectors = {i: [float(x) for x in draw.integers(-2, 3, 24) / 8] for i in range(160)}
    vectors |= {200 + i: [0.25] * 24 for i in range(60)} | {400: [1e17] * 24, 420: [], 421: [], 440: [1.0, 2.0]}
    bad = [(500, None), (520, [None] + [1.0] * 23), (540, [float("nan")] * 24), (560, [float("inf")] * 24), (None, [1.0] * 24)]
    rows = [*vectors.items(), (0, vectors[0]), *bad]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, score int, rank int")
    ints = topk.integer_vectors(df)
    sane = {i: v for i, v in vectors.items() if i != 400}
    found = topk.top_k(ints.filter("vec_id <> 400"), F.col("vec_id") % 20 == 0, 20, *blocks)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()) == plain_top_k(sane, 20)
    assert topk.top_k(ints.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_large_numbers_are_summed_exactly():
    ids, big = np.arange(3), float(2**30)
    rows = np.array([[big, 1.0], [big, 2.0], [big, 3.0]])
    q, c, s = topk.best_of(rows[:1], ids[:1], rows, ids, 2)
    assert [(int(a), int(b), int(x)) for a, b, x in zip(q, c, s, strict=True)] == [(0, 2, 2**60 + 3), (0, 1, 2**60 + 2)]


def test_pruning_keeps_the_best():
    draw = np.random.default_rng(2)
    candidates = np.floor(64 * draw.normal(size=(3000, 64)) * draw.gamma(1, 1, (3000, 1)))
    ids = draw.permutation(3000)
    q, c, s = topk.best_of(candidates[:9], ids[:9], candidates, ids, 20)
    for n in range(9):
        scores = candidates @ candidates[n]
        want = sorted((-x, i) for x, i in zip(scores, ids, strict=True) if i != ids[n])[:20]
        assert [(-x, i) for x, i in zip(s[20 * n : 20 * n + 20], c[20 * n : 20 * n + 20], strict=True)] == want


DIGITS = str.maketrans("0123456789", "abcdefghij")

# --- pages --------------------------------------------------------------------------------------

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<div id="cookie-notice">We use cookies</div><header><h1>Site</h1></header>
<div class="menu"><ul><li><a href=x>Home</a><li><a>About</a></ul></div>
<article><h1>Title &amp; more</h1><!-- <p>no</p> --><p>First <b>bold</b>
  text<p>Second<br>line&nbsp;<a href="y">link</a>.<ul><li>one<li>two</ul><div class="advert">Buy</div>
<span class="share">tweet</span><form><input><button>Go</button></form><script>if(a<b){document.write("<p>x</p>")}</script>
<table><tr><td>c1<td>c2</table><section class="comments"><p>nice</p></section></article>
<aside>side</aside><footer>foot</footer></body></html>"""
FULL_TEXT = "Title & more\nFirst bold text\nSecond line link.\none\ntwo\nc1\nc2"


def plain(body, n):
    extra = "".join(f"<p>{body} {i}" for i in range(n))
    return f"<body><div class=x1>Site name</div><div class=x2><p>{body}</p>{extra}</div><div class=x3>&copy; us</div>"


PAGES = [
    (1, "https://Full.example/a", FULL, FULL_TEXT),
    (2, "https://full.example:80/b?c", FULL.replace("First", "Other"), FULL_TEXT.replace("First", "Other")),
    (3, "http://plain.example/1", plain("alpha beta", 0), "alpha beta"),
    (4, "http://plain.example/2", plain("gamma", 2), "gamma\ngamma 0\ngamma 1"),
    (5, "http://plain.example/3", plain("delta &lt;x&gt;", 1), "delta <x>\ndelta <x> 0"),
    (6, None, None, ""), (7, "nonsense", "", ""), (8, "http://one.example/", "just text < here", "just text < here"),
    (9, "http://long.example/", "<article>" + "<p>para graph" * 20_000, "\n".join(["para graph"] * 20_000)),
    (9, "http://long.example/", "<article>" + "<p>para graph" * 20_000, "\n".join(["para graph"] * 20_000)),
]


def test_pages(spark):
    rows = [(i, u, h, "text", "w") for i, u, h, _ in PAGES]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, wrapper string")
    found = pages.main_texts(df).collect()
    assert sorted((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in found if r["page_id"] != 6) == sorted(
        (i, u, t, len(t)) for i, u, _, t in PAGES if i != 6
    )
    assert [(r["url"], r["text"], r["n_chars"]) for r in found if r["page_id"] == 6] == [(None, "", 0)]
    assert pages.main_texts(df.limit(0)).count() == 0


def test_given_pages_hold_no_boilerplate(spark):
    given = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    for r in queries.queries()["op9_page_wrappers"](spark, SF_SMALL).collect():
        inside = given[r["page_id"]].split("<article>")[1].split("</article>")[0]
        for sign, to in (("<br>", " "), ("<b>", ""), ("</b>", "")):
            inside = inside.replace(sign, to)
        for tag in ("<h1>", "</h1>", "<p>", "</p>"):
            inside = inside.replace(tag, "\n")
        import html

        want = [" ".join(html.unescape(x).split()) for x in inside.split("\n")]
        assert r["text"] == "\n".join(x for x in want if x)


def test_wrappers_find_groups_and_options():
    whole = None
    for body, n in (("a", 0), ("b", 3), ("c", 1)):
        whole = pages.folded(whole, pages.page_wrapper(plain(body, n)))
    parts = whole["items"][0][3]
    shapes = {p[0]: p for p in parts}
    assert shapes["div:x2"][3][0][:3] == ["p:", 1, 2], "paragraphs are a repeated group"
    assert pages.main_slots(whole) == ["body:/div:x2/p:"], "what never changes is the template"
    lone = pages.align(whole["items"], pages.page_wrapper("<body><div class=x2><p>d</p></div>")["items"])
    assert [p[1] for p in lone[0][3]] == [0, 1, 0], "what a page lacks is optional"


def texts_of(bodies):
    """The texts of pages of one host."""
    whole = None
    for body in bodies:
        whole = pages.folded(whole, pages.page_wrapper(body))
    verdicts = pages.judged(whole["items"])
    return [pages.extract(body, verdicts) for body in bodies]


def test_alignment_tells_template_within_articles():
    page = "<article><h1>Title {0}</h1><div><p>Body {0}</p>{1}</div><p>Read more from us</p></article>"
    own = [page.format(n, f"<ul><li>only {n}</ul>" * (n == 2)) for n in range(4)]
    assert texts_of(own) == [f"Title {n}\nBody {n}" + "\nonly 2" * (n == 2) for n in range(4)]
    # Both have one tag path; only the alignment tells them apart.
    same = [f"<article><p>Body {n}</p><ul><li>item {n}</ul><p>Read more from us</p></article>" for n in range(3)]
    assert texts_of(same) == [f"Body {n}\nitem {n}" for n in range(3)]
    # Two pages don't tell, nor do pages that are the same throughout.
    assert texts_of(own[:2])[0] == "Title 0\nBody 0\nRead more from us"
    assert texts_of(own[:1] * 4)[0] == "Title 0\nBody 0\nRead more from us"


def test_pages_without_the_article_of_others_keep_their_text():
    own = [f"<body><article><p>A {n}</p></article><div class=x>site</div>" for n in range(3)]
    other = [f"<body><div class=content><p>B {n}</p></div><div class=x>site</div>" for n in range(3)]
    third = [f"<body><div class=y><p>C {n}</p></div><div class=x>site</div>" for n in range(3)]
    assert texts_of(own + other + third) == [f"{k} {n}" for k in "ABC" for n in range(3)]


def test_names_of_containers_are_hints():
    for said in ("page no-sidebar", "layout has-sidebar", "content-with-header", "grid widget-area", "comments-open"):
        own = [f"<div class='{said}'><article><p>A {n}</p></article><div class=share>tweet</div></div>" for n in range(2)]
        assert texts_of(own) == ["A 0", "A 1"], said
    assert texts_of([f"<main class='comments-open'><p>A {n}</p></main>" for n in range(2)]) == ["A 0", "A 1"]
    named = [f"<article><p>A {n}</p><div class=notice>{{}}</div><div class=comments>so {n}</div></article>" for n in range(3)]
    assert texts_of([x.format("all the same") for x in named]) == ["A 0", "A 1", "A 2"]
    assert texts_of([x.format(f"differs {n}") for n, x in enumerate(named)]) == [f"A {n}\ndiffers {n}" for n in range(3)]


def text_of(page):
    return texts_of([page])[0]


def test_places_come_from_the_page_itself():
    # In lower case this letter is two characters.
    assert text_of("\u0130" * 60 + "<script>var x = '<p>';</SCRIPT ><p>one</p><p>two</p>").split("\n")[1:] == ["one", "two"]
    assert text_of("<p>a</p><script>x</scriptx></script><p>b</p><style>never closed <p>c") == "a\nb"


def test_deep_nesting():
    for levels in (1_000, 5_000):
        page = "<div>" * levels + "<nav><ul><li>menu</li></ul></nav>deep <p>text</p><aside>side</aside>" + "</div>" * levels + "<p>after"
        assert text_of(page) == "deep\ntext\nafter"
    article = "<article>" + "<div class=content>" * 500 + "<p>deep</p><form>go</form>" + "</div>" * 500 + "</article><p>out"
    assert text_of(article) == "deep"
    assert text_of("<x>t" * 50_000) == "\n".join("t" * 50_000)


@pytest.mark.parametrize(
    "page",
    ["a<" * 500_000, '<a "' * 250_000, "<!" * 500_000, "<a " + "x" * 1_000_000, "<p>x<b '" * 100_000, "<a \"<b'" * 100_000],
    ids=["open", "quote", "declaration", "attribute", "paragraphs", "quotes"],
)
def test_a_million_characters_of_broken_markup(page):
    start = time.monotonic()
    found = text_of(page)
    assert time.monotonic() - start < 30
    # Of quotes that close a later tag's quote, the text between is part of a tag.
    assert found[:1] == {"<!": "", "<p": "x"}.get(page[:2], "a" if page[0] == "a" else "<")


def test_tags_that_never_end_are_text():
    assert text_of("<p>a</p><p>1 <b 'x<p>b</p>") == "a\n1 <b 'x\nb"


@pytest.mark.parametrize(
    "named",
    [lambda i: f"id=post{i}", lambda i: f"class=post{i}", lambda i: f"class=css-{i}k{i}z", lambda i: f"class='{str(i).translate(DIGITS)}'"],
    ids=["id", "number", "hash", "word"],
)
def test_pages_of_a_host_with_names_of_their_own(named):
    page = "<div class=top>Site</div><div {0}><p>Text {1}</p><p>more {1}</p></div><p class=more>Read more from us</p>"
    start = time.monotonic()
    whole = None
    for n in range(5_000):
        whole = pages.folded(whole, pages.page_wrapper(page.format(named(n), n)))
    verdicts = pages.judged(whole["items"])
    for n in (0, 70, 4_999):
        assert pages.extract(page.format(named(n), n), verdicts) == f"Text {n}\nmore {n}"
    assert len(json.dumps(whole)) < 100_000
    assert time.monotonic() - start < 30


def test_long_lists_without_order_keep_all_text():
    kinds = ("<p>{}</p>", "<h2>{}</h2>", "<ul><li>{}</ul>", "<div>{}</div>")
    page = "".join(kinds[i * i * 7 // 5 % 4].format(f"t{i}") for i in range(5_000))
    other = "".join(kinds[i * i * 3 // 7 % 4].format(f"s{i}") for i in range(5_000))
    found = texts_of([f"<article>{x}</article>" for x in (page, other)])
    assert [x.split("\n") for x in found] == [[f"{k}{i}" for i in range(5_000)] for k in "ts"]
