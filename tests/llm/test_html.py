"""Template deduction: classes, slots and texts against plain versions, hostile pages."""

import re
import time
from collections import Counter, defaultdict

import pytest

from tidemark.llm import htmltext
from tidemark.llm.common import table

PAGES = "page_id long, url string, html string"
SF001 = "/root/testdata/sf0.001"


def host(url):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", url or "")
    return m[1].lower() if m else ""


def plain_vectors(rows):
    """``host -> (pages, {token: ((parent, step), {page: count}, {page: characters})})``, one page at a time."""
    hosts = defaultdict(lambda: (set(), {}))
    for url, html in rows:
        page = htmltext.Page(html or "")
        key = page.key()
        if not key:
            continue
        pages, tokens = hosts[host(url)]
        pages.add(key)
        found = [(0, 0, "", 1, sum(len(b.text) for b in page.blocks)), *htmltext.page_tokens(page)]
        for token, parent, step, n, chars in found:
            _, counts, sizes = tokens.setdefault(token, ((parent, step), {}, {}))
            counts[key] = max(counts.get(key, 0), n)
            sizes[key] = max(sizes.get(key, 0), chars)
    return hosts


def plain_templates(rows):
    out = {}
    for name, (pages, tokens) in plain_vectors(rows).items():
        frequent = [(t, *place, len(counts), sum(counts.values()), sum(sizes.values()), str(sorted(counts.items())))
                    for t, (place, counts, sizes) in tokens.items()
                    if 2 * len(counts) >= len(pages) and (not t or place[1] or len(counts) >= 4)]
        out[name] = htmltext.template_of(frequent)
    return out


def plain_texts(rows):
    found = plain_templates(rows)
    slots = [found.get(host(url), (None, [])) for url, _ in rows]
    return [htmltext.extract(html, slot, frozenset(texts)) for (_, html), (slot, texts) in zip(rows, slots)]


MADE = (
    [("http://a.org/x", f"<nav>Menu {i % 3}</nav><div><h1>T {i}</h1><p>Body {i} of this page</p><p class=more>Read more</p></div>") for i in range(9)]
    + [("http://b.org", None), ("http://b.org", ""), (None, "<p>No url"), (None, "<p>No url"), ("B.ORG", "x")]
    + [("https://C.org:80/", f"<main><p>Shared</p><p>Own {i}</p></main>") for i in range(3)])


@pytest.mark.parametrize("made", [True, False])
def test_classes_and_texts(spark, made):
    """Classes are the sets of tokens with equal occurrence vectors; templates and texts equal a plain version's."""
    if made:
        pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(MADE)], PAGES)
    else:
        pages = table(spark, SF001, "pages")
    rows = [(r.url, r.html) for r in pages.orderBy("page_id").collect()]
    classes = htmltext.occurrence_classes(pages)
    got = defaultdict(set)
    for r in classes.collect():
        got[r.host, r.class_id].add(r.token)
    want = defaultdict(set)
    for name, (seen, tokens) in plain_vectors(rows).items():
        for t, ((_, step), counts, _) in tokens.items():
            if 2 * len(counts) >= len(seen) and (not t or step or len(counts) >= 4):
                want[name, str(sorted(counts.items()))].add(t)
    assert Counter((k[0], frozenset(v)) for k, v in got.items()) == Counter((k[0], frozenset(v)) for k, v in want.items())
    found = {r.host: (r.slot, r.texts) for r in htmltext.templates(classes).collect()}
    assert found == plain_templates(rows)
    assert [r.text for r in htmltext.extract_text(pages).orderBy("page_id").collect()] == plain_texts(rows)


def test_slots_without_names(monkeypatch):
    """With the lists of names emptied the deduced slot is still the article of the test pages (some 40 a host)."""
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.1/pages.parquet").to_pylist()
    rows = [(p["url"], p["html"]) for p in pages]
    hinted = plain_texts(rows)
    for name in ("FURNITURE", "FURNITURE_WORDS", "MAIN"):
        monkeypatch.setattr(htmltext, name, frozenset())
    assert plain_texts(rows) == hinted


ONE_PAGE = [
    ('<div class="content no-sidebar"><p>Main text here</p></div>', "Main text here"),
    ('<div id="layout-with-sidebar"><article><p>Art text</p></article></div>', "Art text"),
    ('<article><p>One <span class="ad">x</span> two</p></article>', "One two"),
    ('<article><p>One <span class="ad">x <em>y</em><br>z</span>two<span class=notice>n</p><p>three</article>', "One two\nthree"),
    ('<article><p>Lead</p><section id="search-algorithms"><p>A</p></section><h2 id="related-work">R</h2><div class="share-price-table">S</div></article>',
     "Lead\nA\nR\nS"),
    ('<article><p>Main article text</p><article class="comment"><p>reader says</p></article></article>', "Main article text"),
    ('<div><article class="related"><p>Rel</p></article><div class="body"><p>The main text of the page</p></div></div>', "The main text of the page"),
    ('<main><article><h1>T</h1><p>x y</p></article><section class="comment-list"><p>c</p></section><div class="cookie-notice">k</div></main>', "T\nx y"),
    ('<div class=wrapper><div class=main-content><h1>T</h1><div class=entry><p>Some long text of the entry</p></div><div>By me</div></div></div>',
     "T\nSome long text of the entry\nBy me"),
    ('<div class="site-footer">f</div><div class="siteFooter">g</div><p>text &amp; more', "text & more"),
    ("just text", "just text"), ("", ""), ("<nav>only a menu</nav>", ""),
]


@pytest.mark.parametrize("html,text", ONE_PAGE)
def test_one_page(html, text):
    assert plain_texts([("http://a.org", html)]) == [text]


def test_text_of_an_author_is_kept():
    """A paragraph many articles share is no template; one that comes exactly as often as an element is."""
    three = [("http://a.org", f"<article><p>Shared by all.</p><p>Own {i}</p></article>") for i in range(3)]
    assert plain_texts(three) == [f"Shared by all.\nOwn {i}" for i in range(3)]
    many = [("http://a.org", f"<article>{'<p>A quote.</p>' if i % 3 else ''}<p>Own {i}</p>{'<div class=x>Sign up</div>' if i % 4 else ''}</article>")
            for i in range(24)]
    assert plain_texts(many) == [("A quote.\n" if i % 3 else "") + f"Own {i}" for i in range(24)]


def test_two_layouts():
    """Pages of another layout than the host's give their own main text."""
    rows = [("http://a.org", f"<div class=text><p>{'Long text ' * 20}{i}</p></div><div class=x>x{i}</div>") for i in range(8)]
    rows.append(("http://a.org", "<article><p>The one article of this host</p></article>"))
    rows.append(("http://a.org", "<table><tr><td>Nothing but<td>a table</table>"))
    got = plain_texts(rows)
    assert got[3] == "Long text " * 20 + "3" and got[8:] == ["The one article of this host", "Nothing but\na table"]


def test_deep_and_long_pages():
    """20,000 nested elements, unclosed and stray tags take seconds together, and lose no text."""
    start = time.time()
    deep = 20_000
    assert plain_texts([("http://a.org", "<div>" * deep + "text" + "</div>" * deep)]) == ["text"]
    assert htmltext.extract("<x><h1>" * deep + "text") == "text"
    assert htmltext.extract("<x>" * deep + "a</b></q>" * deep) == "a" * deep
    assert htmltext.extract("<span class=ad>" * deep + "a" + "</span>" * deep + "z") == "z"
    long = "\n".join(f"line {i}" for i in range(100_000))
    assert len(htmltext.extract("<p>" + long.replace("\n", "<p>")).split("\n")) == 100_000
    assert time.time() - start < 60


def test_other_columns_stay(spark):
    """Columns named like helpers stay, text and n_chars are replaced; an empty table gives an empty table."""
    pages = spark.createDataFrame([(1, "http://a.org", "<p>x</p>", "h", "t", "p", "s", "old", 2**60)],
                                  PAGES + ", _host string, _texts string, _part string, slot string, Text string, big long")
    r = htmltext.extract_text(pages).first().asDict()
    assert r == dict(page_id=1, url="http://a.org", html="<p>x</p>", _host="h", _texts="t", _part="p", slot="s", big=2**60, text="x", n_chars=1)
    assert htmltext.extract_text(pages.limit(0)).count() == 0
