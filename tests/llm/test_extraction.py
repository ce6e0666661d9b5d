"""Operator 11: known pages, independent extraction of the given tables, votes against plain counting, edge cases."""

import re
from collections import Counter, defaultdict
from html import unescape

import pytest
from pyspark.sql import functions as F

from weekcast.llm import extraction
from weekcast.llm.pagetree import Page, choose, loosen
from weekcast.llm.queries import op11_html_extraction

SF = "/root/testdata/sf0.001"
STORY = "".join(f"<p>Sentence number {k} of the story, with <b>bold</b> words &amp; a <a href='/x'>link</a> inside of it.</p>" for k in range(5))
TOLD = " ".join(f"Sentence number {k} of the story, with bold words & a link inside of it." for k in range(5))
TALK = "".join(f"<div class='c7'><p>Reader {k} says at great length that all of this is wrong, and why that is so, and goes on.</p></div>" for k in range(30))


def best(html):
    page = Page(html)
    path = page.best()
    return page.text(path) if path else ""


@pytest.mark.parametrize(("html", "text"), [
    ("", ""), ("   ", ""), ("<nav><a href=1>x</a></nav>", ""), ("plain &lt;text&gt;&nbsp;here", "plain <text> here"),
    (f"<header><h1>Site</h1></header><main><article><h1>Head</h1>{STORY}</article></main><aside><p>Other things to read, many of them.</p></aside><footer>f</footer>", f"Head {TOLD}"),
    (f"<body><div id=menu><a href=1>a</a></div><div class=x1>{STORY}</div><div class=cookie-notice>We use cookies, and a lot of them, on all pages.</div></body>", TOLD),
    (f"<article>{STORY}<form><label>Name</label><input></form><div class='ad'>Buy this now</div><section class='comments'>{TALK}</section></article>", TOLD),
    (f"<body class='has-sidebar'><div class='sidebar-right'><div class=entry>{STORY}</div><div class=sidebar><p>Side words, quite long in themselves.</p></div></div>", TOLD),
    (f"<body><form id=all><div id=content><h1>Head</h1>{STORY}</div></form></body>", f"Head {TOLD}"),
    (f"<body><div class=page><h1>Head</h1><div class=text>{STORY}</div></div><div class=footer>foot</div>", f"Head {TOLD}"),
    (f"<body><h1>Head</h1>{STORY}<ul><li><a href=1>Home</a><li><a href=2>News</a></ul>", f"Head {TOLD}"),
    ("<article><p>wo<b>r</b>d<br>line<p>two\n\t three<ul><li>four<li>five</ul>six <span class=ad>no</span>seven</article>", "word line two three four five six seven"),
    ("<p>a < b <!-- <p>no</p> --> <!odd> </> <?x y?> &#233;&eacute;&#x1F600;</p><script>if (a<b) '</p>'</script><style>p{}</style><p title='a>b'>end", "a < b éé😀 end"),
    ("<body><div class=post><p>one two three<script>never closed", "one two three"),
    ("<table><tr><td class=menu><a href=1>m</a><td class=main><p>Some words in a cell.</table>", "Some words in a cell."),
])
def test_known_pages(html, text):
    assert best(html) == text


def test_given_pages(spark):
    """The given pages keep everything in one article; taken out here by regular expressions."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op11_html_extraction(spark, SF)
    assert got.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    rows = got.collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1)>|<br>", " ", inner))).split())
        assert r.n_chars == len(r.text)


def plain(rows):
    """The whole operator on one machine: rows of (url, html)."""
    def host(url):
        m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", url or "")
        return m[1].lower() if m else ""

    strict, loose, sizes = defaultdict(Counter), defaultdict(Counter), Counter(host(u) for u, _ in rows)
    for u, h in rows:
        path = Page(h or "").best()
        if host(u) and path:
            strict[host(u)][path] += 1
            loose[host(u)][loosen(path)] += 1
    out = []
    for u, h in rows:
        page, at = Page(h or ""), host(u)
        won = [sorted((p for p, n in kind[at].items() if n >= 2 and 50 * n >= sizes[at]), key=lambda p: (-kind[at][p], p)) for kind in (strict, loose)]
        path = choose(page, *won, strict[at])
        out.append(page.text(path) if path else "")
    return out


@pytest.fixture(scope="module")
def corpus():
    page = lambda n, body: f"<html><body><div class='top'><a href=1>Home</a></div>{body}<div class='end'>Made by us, {n}</div></body></html>"
    rows = [("http://News.example.com/a", page(k, f"<div class='story'>{STORY}<p>Page {k} ends.</p></div>")) for k in range(12)]
    rows += [("https://news.example.com:8080/b?x", page(k, f"<div class='story'><p>Short piece {k}, but the one that counts.</p></div><div class='talk'>{TALK}</div>")) for k in range(3)]
    rows += [(f"http://u@blog.example.org/{k}", page(k, f"<div class='post-{k}'>{STORY}</div><div class='w-{k}'><p>Also on this blog, some more words.</p></div>")) for k in range(8)]
    rows += [("http://blog.example.org/x", page(9, f"<div class='post-77'><p>Short post, the one that counts.</p></div><div class='talk'>{TALK}</div>"))]
    rows += [(None, page(1, f"<div class='solo'>{STORY}</div>")), ("not a url", f"<p>{TOLD}"), ("http:///x", ""), (None, None), ("http://news.example.com/z", None), ("", "<nav>x</nav>")]
    return rows + rows[:2]


def test_consensus(spark, corpus):
    """Pages on which the comments are longer than the story follow their host; all as on one machine."""
    docs = spark.createDataFrame(list(corpus), "url string, html string").withColumn("page_id", F.monotonically_increasing_id()).repartition(5)
    got = sorted((r.url or "", r.text) for r in extraction.extract(docs).collect())
    want = [(u or "", t) for (u, _), t in zip(corpus, plain(corpus), strict=True)]
    assert got == sorted(want)
    short = [t for _, t in got if t.startswith("Short")]
    assert len(short) == 4 and not any("Reader" in t for t in short)
    assert "Reader" in best(corpus[12][1]) and "Reader" in best(corpus[23][1])          # alone they would fail


def test_edges(spark, corpus):
    rows = spark.createDataFrame(list(corpus), "url string, html string")
    names = ["text", "n_chars", "host", "__host", "__votes", "strict", "loose", "path", "n", "pages", "__PAGES"]
    extra = rows.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)], F.create_map(F.lit("a"), F.lit(1)).alias("map"), F.current_timestamp().alias("when"))
    got = extraction.extract(extra)
    assert set(got.columns) == {"url", *names, "map", "when"}
    assert sorted(r.text for r in got.collect()) == sorted(plain(corpus)) and {r["__host"] for r in got.collect()} == {3}
    assert extraction.extract(rows.limit(0)).collect() == []
