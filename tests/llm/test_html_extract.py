import html
import re

import pytest

from doorstep.llm import html_extract as h

NOISE = "<header><p>Site name and a motto of many words here</p></header><nav><ul><li><a href='/'>Home page of ours</a></li><li>About</li></ul></nav>"
AFTER = "<section id='comments'><p>Reader one says a lot about this and that, on and on and on.</p></section><footer>&copy; all rights reserved by somebody or other</footer>"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T words</title><style>p{{}}</style><script>var a='<p>x</p>';</script></head><body>{NOISE}{body}{AFTER}</body>"


CASES = {
    "<article><h1>One</h1><p>Two <b>bo</b>ld &amp; <i>three</i>.<br>Four<p>five\n six</article>": "One\n\nTwo bold & three. Four\n\nfive six",
    "<article><p>only</p></article>": "only",
    "<div class='post-content'><p>first words here</p><div class='ad'>buy it</div><p>last &lt;words&gt;</p></div>": "first words here\n\nlast <words>",
    "<main><p>a a a a</p><form><p>Name</p><input></form><aside>side words</aside><p>b b b b</p></main>": "a a a a\n\nb b b b",
    "<article><header><h1>Head line</h1></header><p>text</p><!-- <p>hidden</p> --><p>tail</p></article>": "Head line\n\ntext\n\ntail",
    "<article><p>x < y and 2 > 1 &#x41;&eacute;&nbsp;z</p></article>": "x < y and 2 > 1 Aé z",
    "<article><ul><li>one item<li>two items</ul><table><tr><td>c1</td><td>c2</td></tr></table></article>": "one item\n\ntwo items\n\nc1 c2",
    "<div class='cookie-notice'>We use many cookies on this site of ours, agree?</div><article><p>short</p></article>": "short",
}


@pytest.mark.parametrize("body", CASES)
def test_main_text(body):
    assert h.main_text(page(body)) == CASES[body]


def brute_run(scores):
    best, found = 0.0, (0, 0)
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            if sum(scores[i:j]) > best + 1e-12:
                best, found = sum(scores[i:j]), (i, j)
    return best


def test_best_run_by_brute_force():
    weights = h.Weights()
    for body in CASES:
        parts = list(h.stretches(page(body)))
        scores = [weights.tag(p) if p.text is None else p.words * weights.word(p.place, p.aside) for p in parts]
        a, b = h.best_run(parts, weights)
        assert sum(scores[a:b]) == pytest.approx(brute_run(scores))


def test_given_pages_by_their_article(spark, small):
    got = h.extract(spark.read.parquet(f"{small}/pages.parquet")).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [re.sub(r"<[^>]+>", " ", b) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)
        assert r.text == want and r.n_chars == len(want) and r.url == pages[r.page_id].url


def test_edges(spark):
    rows = [(1, None, None), (1, "u", ""), (None, "u", "<p>" * 3000 + "deep"), (2, "u", "plain text only"), (3, "u", "<script>unclosed " * 3), (4, "u", "<article>" + "<p>word</p>" * 20000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as place")
    got = {(r.page_id, r.url): r for r in h.extract(df).collect()}
    assert [got[k].text for k in [(1, None), (1, "u"), (None, "u"), (2, "u"), (3, "u")]] == ["", "", "deep", "plain text only", ""]
    assert got[(4, "u")].n_chars == 20000 * 6 - 2
    assert h.extract(df.limit(0)).count() == 0


ARTICLE = "<h1>Head line</h1><p>first words here</p>"
NAMED = [
    f"<body class='single has-sidebar'><article>{ARTICLE}</article>",
    f"<body class='comments-open no-sidebar'><main>{ARTICLE}</main>",
    f"<html class='menu'><body id='widget'><main class='share'>{ARTICLE}</main>",
    f"<article class='post comment-enabled'>{ARTICLE}</article>",
    f"<div class='sidebar'><div class='widget'><article class='comment'>{ARTICLE}</article></div></div>",
    f"<div id='menu-page-content'>{ARTICLE}</div>",
    f"<div class='no-sidebar with-menu'>{ARTICLE}</div>",
    "<article><header class='entry-header'><h1>Head line</h1></header><p>first words here</p></article>",
    "<main><div class='page-header'><h1>Head line</h1></div><p>first words here</p></main>",
    f"<main>{ARTICLE}<div id='comments'><article><p>a reader says</p></article></div><p class='site-ad-2'>buy</p></main>",
]


@pytest.mark.parametrize("body", NAMED)
def test_names_that_tell_of_the_page_leave_out_nothing(body):
    assert h.main_text(body) == "Head line\n\nfirst words here"


def test_every_place_counts_however_many_there_are(spark, monkeypatch):
    """Many sites, each with places of its own: all are weighed as they were counted."""
    rows = [
        (k, f"u{k}", f"<div class='x{k}'>{'out ' * 9}</div><article><p class='y{k}'>in side</p></article>")
        for k in range(40)
    ]
    rows += [(None, None, None), (3, "again", rows[3][2]), (50, "bare", "<div class='x7'>out out</div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole = sorted(h.extract(df).collect(), key=str)
    monkeypatch.setattr(h, "PLACES", 5)
    assert sorted(h.extract(df).collect(), key=str) == whole and len(whole) == 43
    assert {r.text for r in whole if (r.page_id or 50) < 40} == {"in side"}
