"""Main text of pages: hand-made pages, and the suffix array against plain counting."""

import math
from collections import defaultdict

import numpy as np
import pytest

from entity360.llm import html_extract
from entity360.llm.html_blocks import blocks
from entity360.llm.html_extract import RUN, covered, extract, repeated_runs
from entity360.llm.queries import QUERIES
from tests.llm.cases import FOLDER

PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style>
<script>var t = "</p><article>";</script></head><body><header>Site</header><nav><a href=x>Menu</a></nav>
<!-- <p>no</p> --><article><header><h1>A &amp;amp; B</h1></header><p>One <b>two</b>
 three&nbsp;four<br>five<p>Six<div class="ad-box">Buy</div><aside>Side</aside><ul><li>x<li>y</ul>
<form>Name <input></form><div id="comments"><p>First!</p></div></article><footer>&copy; Foot</footer>"""


def test_an_article_is_freed_of_its_frame():
    text = "\n\n".join(b.text for b in blocks(PAGE) if b.place == "article")
    assert text == "A &amp; B\n\nOne two three four five\n\nSix\n\nx\n\ny"


def test_broken_markup_does_not_crash():
    for page in ("", "<", "<p", "<p class='x", "</p></p>", "<script>", "<!-- ", "a < b & c &bogus; &#0;", "<p>x" * 500):
        blocks(page)
    assert [b.text for b in blocks("a < b & c")] == ["a < b & c"]


def test_runs_equal_plain_counting():
    random = np.random.default_rng(2)
    streams = [random.integers(0, 4, random.integers(0, 60)).astype(np.uint64) for _ in range(12)]
    runs, pages = repeated_runs(streams)
    plain = defaultdict(set)
    for k, s in enumerate(streams):
        for i in range(len(s) - RUN + 1):
            plain[tuple(s[i : i + RUN])].add(k)
    assert sorted(pages.tolist()) == sorted(len(x) for x in plain.values())
    again = np.sort(runs[pages >= 2])
    for s in streams:
        want = np.zeros(len(s), bool)
        for i in range(len(s) - RUN + 1):
            if len(plain[tuple(s[i : i + RUN])]) >= 2:
                want[i : i + RUN] = True
        assert np.array_equal(covered(s, again), want)


def _site(n):
    head = "<div>Welcome to our site and all of its many fine pages today</div>"
    foot = "<div>Copyright by the owners of this site, all rights are reserved</div>"
    story = "<div>Story {k} begins{k} here{k} and{k}</div><div>goes{k} on{k} until its end{k}</div>"
    return [f"<html><body>{head}{story.format(k=k)}{foot}</body>" for k in range(n)]


def test_what_a_host_repeats_goes_where_there_is_no_article(spark):
    rows = [(k, f"http://host/{k}", p) for k, p in enumerate(_site(6))]
    rows += [(100, "http://host/0", rows[0][2]), (7, None, None), (8, "x", ""), (None, "http://o/", "<p>Alone")]
    rows += [(9, "http://host/9", "<nav>Menu</nav><article>Text</article>")]
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id bigint, url string, html string, host string, key int")
    got = [(r.id, r.text) for r in extract(pages).collect()]
    assert len(got) == len(rows)
    found = dict(got)
    for k in range(6):
        assert found[k] == f"Story {k} begins{k} here{k} and{k}\n\ngoes{k} on{k} until its end{k}"
    assert found[100] == found[0] and found[7] == found[8] == "" and found[None] == "Alone"
    assert found[9] == "Text"
    assert extract(pages.limit(0)).count() == 0


def test_query_returns_every_page_with_its_article(spark):
    rows = {r.page_id: r for r in QUERIES["op2_html_extraction"](spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    texts = {" ".join(t.text.split()) for t in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert set(rows) == {p.page_id for p in pages}
    for p in pages:
        row = rows[p.page_id]
        assert row.url == p.url and row.n_chars == len(row.text)
        assert " ".join(row.text.split("\n\n")[1:]) in texts


def _texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.id: r.text for r in extract(pages).collect()}


def test_copies_and_shared_passages_without_an_article_are_kept(spark):
    page = "<div>The whole text of a page that stands at more than one address here</div>"
    quote = "to be or not to be that is the question"
    rows = [(k, f"http://copies/{k}", page) for k in range(4)]
    rows += [(10 + k, f"http://quotes/{k}", f"<div>Page{k} says {quote} and{k} ends{k}</div>") for k in range(2)]
    rows += [(20 + k, f"http://host/{k}", p) for k, p in enumerate(_site(8))]
    rows += [(30 + k, f"http://host/q{k}", f"<div>Own{k} word{k}</div><div>{quote}</div>") for k in range(3)]
    found = _texts(spark, rows)
    assert {found[k] for k in range(4)} == {page[5:-6]}
    assert [found[10 + k] for k in range(2)] == [f"Page{k} says {quote} and{k} ends{k}" for k in range(2)]
    assert [found[20 + k] for k in range(8)] == [f"Story {k} begins{k} here{k} and{k}\n\ngoes{k} on{k} until its end{k}" for k in range(8)]
    assert [found[30 + k] for k in range(3)] == [f"Own{k} word{k}\n\n{quote}" for k in range(3)]


def test_what_a_host_repeats_goes_from_its_articles_too(spark):
    notice = "<div>Get our weekly letter with all the best new stories for free</div>"
    rows = [(k, f"http://host/{k}", f"<nav>n{k}</nav><main><p>Story{k} of{k} this{k} page{k}</p>{notice}</main>") for k in range(4)]
    rows += [(9, "http://host/copy", rows[0][2].replace("n0", "other frame"))]
    article = "<article>One article that is the same at each of its many addresses</article>"
    rows += [(20 + k, f"http://copies/{k}", f"<nav>Menu{k}</nav>{article}") for k in range(4)]
    found = _texts(spark, rows)
    assert [found[k] for k in (0, 1, 2, 3, 9)] == [f"Story{k} of{k} this{k} page{k}" for k in (0, 1, 2, 3, 0)]
    assert {found[20 + k] for k in range(4)} == {article[9:-10]}


def test_a_frame_word_around_an_article_does_not_lose_it():
    story = "<article><p>The story</p><div class=comments>No</div></article>"
    more = "<div class=related><article>Teaser</article></div><div id=comments><article class=comment>First</article></div>"
    for page in (
        f'<body class="has-sidebar">{story}{more}',
        f'<body class="sidebar widget">{story}{more}',
        f'<div class="page no-comments">{story}{more}</div>',
        f'<div class="fixed-header"><div id="sidebar-left">{story}</div>{more}</div>',
        f"<form action=x><nav>Menu</nav>{story}{more}</form>",
        f'<div class="menu-open"><form><nav>Menu</nav>{story}<footer>Foot</footer></form></div>',
        '<main class="sidebar-left"><p>The story</p></main>',
        '<div class="banner"><div itemprop="articleBody">The story</div></div>',
    ):
        assert [b.text for b in blocks(page) if b.place == "article"] == ["The story"], page
    bare = "<p>A story that stands in no article</p>"
    for page in (f'<body class="has-sidebar widget">{bare}', f'<div class="no-comments">{bare}', f"<form><nav>M</nav>{bare}</form>"):
        assert [b.text for b in blocks(page) if b.place == "other"] == [bare[3:-4]], page
    page = f"<div>{bare}</div><div id=comments><article>First</article></div><nav><article>No</article></nav>"
    assert [(b.place, b.text) for b in blocks(page)] == [("other", bare[3:-4]), ("frame", "First"), ("frame", "No")]


@pytest.mark.parametrize("batch_tokens, list_bytes", [(10**6, 1 << 25), (60, 1 << 25), (60, 0)])
def test_batches_and_parts_do_not_change_what_is_boilerplate(spark, monkeypatch, batch_tokens, list_bytes):
    monkeypatch.setattr(html_extract, "BATCH_TOKENS", batch_tokens)
    random = np.random.default_rng(4)
    lines = [" ".join(f"l{k}w{j}" for j in range(10)) for k in range(6)]
    rows = []
    for site, n in (("a", 40), ("b", 7), ("c", 2)):
        for k in range(n):
            shown = [x for i, x in enumerate(lines) if random.random() < (i + 1) / 7]
            shown.insert(random.integers(len(shown) + 1), f"own{site}{k} word")
            rows.append((len(rows), f"http://{site}/{k}", "".join(f"<p>{x}</p>" for x in shown)))
    rows += [(len(rows) + i, f"http://a/again{i}", rows[0][2]) for i in range(30)]

    windows = {i: [w[j : j + RUN] for j in range(len(w) - RUN + 1)] for i, _, p in rows for w in [p[3:-4].replace("</p><p>", " ").split()]}
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.id: r.text for r in extract(pages, list_bytes=list_bytes).collect()}
    for site in "abc":
        ids = [i for i, url, _ in rows if url.startswith(f"http://{site}/")]
        on = defaultdict(set)
        for i in ids:
            for w in windows[i]:
                on[tuple(w)].add(rows[i][2])
        least = max(3, math.ceil(len({rows[i][2] for i in ids}) / 2))
        for i in ids:
            words = rows[i][2][3:-4].replace("</p><p>", " ").split()
            mask = np.zeros(len(words), bool)
            for j, w in enumerate(windows[i]):
                if len(on[tuple(w)]) >= least:
                    mask[j : j + RUN] = True
            assert found[i] == html_extract.unique_text(blocks(rows[i][2]), mask)


def test_tokens_are_packed_without_loss():
    codes = html_extract.all_tokens(blocks("<p>some words and ßome more"))
    assert len(codes) == 5 and np.array_equal(html_extract.unpacked(html_extract.packed(codes)), codes)
    assert len(html_extract.unpacked(b"")) == 0 and html_extract.packed(codes[:0]) == b""
