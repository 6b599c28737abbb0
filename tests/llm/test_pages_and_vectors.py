"""Page text and nearest neighbours."""

import html as markup
import math
import re

import numpy as np
import pytest

from snapdiff.llm import QUERIES, html_text, neighbours
from snapdiff.llm.html_text import main_text


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html><head><title>t</title></head></html>", ""), ("just text &amp; more", "just text & more"),
    ("<p>a<p>b <b>c</b><br>d", "a\nb c d"), ("<p title=\"a>b\">q</p> &lt;x&gt; &eacute &am", "q\n<x> é &am"),
    ("<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>One  two\n three.</p><p>x</p></article><footer>f</footer>", "Title\nOne two three.\nx"),
    ("<div class='comments'><p>A reader says hello there</p></div><main><p>The text of the page is this</p></main>", "The text of the page is this"),
    ("<article><p>Body text that is long enough</p><form><p>Join us</p></form><aside>See also</aside><p>End.</p></article>", "Body text that is long enough\nEnd."),
    ("<script>var t='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<div id='sidebar'>menu of many words here</div><div><p>Text one here.</p><p>Text two here.</p></div>", "Text one here.\nText two here."),
    ("<div class='page with-sidebar'><div class=content><p>Kept text of it.</p><p>More.</p></div><div class='SidebarBox'>other words</div></div>", "Kept text of it.\nMore."),
    ("<div class=header><p>Site name and slogan</p></div><div class=post><div class=post-header><h1>T</h1></div><p>The post itself.</p></div>", "T\nThe post itself."),
    ("<div class=commentlist><p>all there is</p></div>", "all there is"), ("<div class='ad'>Buy</div><p>Read</p><div class=adContainer>Buy</div>", "Read"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a\nb\nc"), ("<div>" * 3000 + "deep", "deep"), ("<p>one</p><p>cut of", "one\ncut of"),
])
def test_main_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<body><form id=aspnetForm><nav>Home</nav><article><h1>T</h1><p>All of the text.</p></article><select><option>x</select></form></body>", "T\nAll of the text."),
    ("<body><form><div><p>A text without an article element.</p><p>More of it.</p></div><button>Go</button></form><p>Foot</p></body>", "A text without an article element.\nMore of it."),
    ("<dialog><article><p>Short.</p></article></dialog><p>Some words that stand outside of it</p>", "Short."),
    ("<object><menu><main><p>Inner text.</p></main></menu></object>", "Inner text."),
    ("<main><p>The text of the page is this</p></main><dialog><article><p>Not this</p></article></dialog>", "The text of the page is this"),
    ("<aside><p>all there is</p><button>Go</button></aside>", "all there is"),
])
def test_named_parts_that_hold_the_page(page, text):
    assert text in main_text(page) and not any(w in main_text(page) for w in ("Home", "Go", "Not this"))


@pytest.mark.parametrize("page", ["<" * 30_000, "<a " * 30_000, "<b \"" * 20_000, "</x>" * 30_000, "<p " * 9 + ">" * 30_000])
def test_malformed_pages_end(page):
    assert isinstance(main_text(page), str)


def test_densities_follow_links():
    """A block of links is less dense than one of text with as many characters."""
    page = html_text.Page("<div><ul>" + "<li><a href=/>some linked words</a>" * 5 + "</ul><section>" + "<p>some plain words</p>" * 5 + "</section></div>")
    density, total = page.densities()
    at = {n: i for i, n in enumerate(page.names)}
    assert total[at["section"]] > total[at["ul"]] and density[at["section"]] > density[at["ul"]]


def test_pages_of_a_table(spark, sf_small):
    """The article as its markup shows it; the pages' articles are plain headings and paragraphs."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_small}/pages.parquet").collect()}
    rows = QUERIES["op8_html_text"][0](spark, sf_small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        blocks = (" ".join(markup.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:h1|p)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_pages(spark):
    rows = [(1, None, None, "x"), (1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, "v", "", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(repr, map(tuple, html_text.extract(frame).collect())))
    assert got == sorted(map(repr, [(1, None, "", 0), (1, "u", "a", 1), (1, "u", "a", 1), (None, "v", "", 0)]))
    assert html_text.extract(frame.limit(0)).count() == 0


def plain_nearest(vectors, query, nearest):
    own = np.array(vectors[query])
    scores = sorted((math.sqrt(((own - np.array(v)) ** 2).sum()), i) for i, v in vectors.items() if i != query)
    return scores[:nearest]


def test_neighbours_of_a_table(spark, sf_small):
    """Small tables are one part of the first graph, so nothing is missed."""
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()}
    rows = QUERIES["op7_neighbours"][0](spark, sf_small).orderBy("query_id", "rank").collect()
    for query in (i for i in vectors if i % 100 == 0):
        got = [(r.rank, r.vec_id, r.score) for r in rows if r.query_id == query]
        want = plain_nearest(vectors, query, 10)
        assert [(n + 1, i) for n, (_, i) in enumerate(want)] == [(n, i) for n, i, _ in got]
        assert all(s == pytest.approx(w, rel=1e-12) for (w, _), (_, _, s) in zip(want, got))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = {0: [1.0, 0.0], 1: [1.0, 0.0], 2: [1.0, 0.0], 100: [0.0, 2.0], 7: [3.0, 4.0]}
    rows = [(i, v, 1) for i, v in good.items()] + [
        (200, None, 1), (300, [0.0, 0.0], 1), (400, [nan, 1.0], 1), (500, [inf, 1.0], 1), (600, [None, 1.0], 1), (None, [1.0, 1.0], 1), (7, [3.0, 4.0], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = neighbours.nearest_neighbours(frame).orderBy("query_id", "rank").collect()
    for query in (0, 100):
        assert [(r.score, r.vec_id) for r in got if r.query_id == query] == plain_nearest(good, query, 10)
    assert {r.query_id for r in got} == {0, 100}
    assert neighbours.nearest_neighbours(frame.limit(0)).count() == 0


def test_recall_of_the_graph(spark, monkeypatch):
    """Parts much smaller than the table, so that turns and search have to find the rest."""
    for name, value in {"LEAF": 64, "DEGREE": 16, "REVERSE": 8, "FIRST": 8, "TREES": 3, "BEAM": 64, "EXPAND": 32}.items():
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16))
    x[500:900] = x[7] + 0.05 * rng.normal(size=(400, 16))  # a dense group
    x[900:1000] = x[11]                                     # one very common vector
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = neighbours.nearest_neighbours(frame).collect()
    vectors = dict(enumerate(x))
    hits = 0
    for query in range(0, 1500, 100):
        got = {r.vec_id for r in rows if r.query_id == query}
        hits += len(got & {i for _, i in plain_nearest(vectors, query, 10)})
    assert hits / 150 >= 0.9


def test_neighbours_of_large_and_small_components(spark):
    """Components past half precision, and past single precision, still give the right lists."""
    for unit in (1e5, 1e300, 1e-300):
        rows = [(n, [unit * (n + 1), unit * 1e-5 * n]) for n in range(300)]
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = {(r.query_id, r["rank"]): r.vec_id for r in neighbours.nearest_neighbours(frame, nearest=20).collect()}
        want = {q: [n for _, n in sorted((abs(n - q), n) for n in range(300) if n != q)][:20] for q in (0, 100, 200)}
        hit = sum(got.get((q, k + 1)) == n for q, near in want.items() for k, n in enumerate(near))
        assert len(got) == 60 and (unit != 1e5 or hit == 60)
