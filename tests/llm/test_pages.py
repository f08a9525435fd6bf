"""Main text of pages."""

import random
import time

import pytest

from wavemeld.llm.html_extract import extract_pages, extract_text

ARTICLE = ("The house is on the hill and it was built by the people of the town in the year that the river rose over "
           "its banks and took the old bridge with it.")


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("   ", ""), ("<p>Hi", ""),
    (f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{ARTICLE}<p>Short.</article><footer>c</footer>",
     f"Title\n{ARTICLE}\nShort."),
    (f"<article><p>a &amp; b &lt;c&gt; &#233; {ARTICLE}</p><script>var t='</p>';</script><style>p{{}}</style></article>",
     f"a & b <c> é {ARTICLE}"),
    (f"<div class='cookie-notice'>{ARTICLE}</div><div id=comments><p>{ARTICLE}</p></div><p>{ARTICLE}</p>", ARTICLE),
    (f"<div><p>{ARTICLE}</p><p>So it goes.</p><p>{ARTICLE}</p></div><form>{ARTICLE}</form>",
     f"{ARTICLE}\nSo it goes.\n{ARTICLE}"),
    (f"<main><p>{ARTICLE}</p><aside>{ARTICLE}</aside><ul><li><a href=x>Some other story of the day</a></ul></main>",
     f"{ARTICLE}\nSome other story of the day"),
    ("<article><p>one\n\n  two\t<b>three</b><br>four</p></article>", "one two three four"),
    (f"<article><p>{ARTICLE}</p><p>broken off &am", f"{ARTICLE}\nbroken off &am"),
    ("<article><p>Only this.</p></article>", "Only this."),
    # Declarations that mean nothing in a page.
    (f"<article><p>a<![xyz[ b ]]> c {ARTICLE}</p></article>", f"a c {ARTICLE}"),
    (f"<!DOCTYPE html><![if IE]><article><p>{ARTICLE}<![endif]></p><![CDATA[x]]></article><![", ARTICLE),
    # Wrappers that say what they have.
    (f"<div class='content has-sidebar'><article><p>{ARTICLE}</p></article></div>", ARTICLE),
    (f"<div id='page' class='sticky-header'><p>{ARTICLE}</p><p>{ARTICLE}</p></div>", f"{ARTICLE}\n{ARTICLE}"),
    (f"<div class='page-header'><p>Latest news</p><main><p>{ARTICLE}</p></main></div>", ARTICLE),
    (f"<form id=all><nav>Home</nav><main><p>{ARTICLE}</p></main></form>", ARTICLE),
    (f"<article><div class='social science'>{ARTICLE}</div></article>", ARTICLE),
    (f"<article><header class='entry-header'><h1>Title</h1></header><p>{ARTICLE}</p></article>", f"Title\n{ARTICLE}"),
    # Page parts and strangers, also inside of articles.
    (f"<div class='site-header'>{ARTICLE}</div><p>{ARTICLE} Yes.</p>", f"{ARTICLE} Yes."),
    (f"<article><p>{ARTICLE}</p><div class='ad'>{ARTICLE}</div><div class='ad-box top'>{ARTICLE}</div></article>", ARTICLE),
    (f"<article><p>{ARTICLE}</p></article><div id='comments'><article class='comment'><p>{ARTICLE}</p></article></div>",
     ARTICLE),
    (f"<article><p>{ARTICLE}</p></article><aside><article><p>{ARTICLE}</p></article></aside>", ARTICLE),
    (f"<article><p>{ARTICLE}</p><section class='comments-area'><p>{ARTICLE}</p></section></article>", ARTICLE),
    # Short pages, and letters without stop words.
    ("<p>Le chat est sur la table.</p><p>Accueil</p>", "Le chat est sur la table."),
    ("<div><p>" + "Дом стоит на холме у реки. " * 6 + "</p></div>", ("Дом стоит на холме у реки. " * 6).strip()),
    ("<div><p>" + "山上有一座古老的房子，人们建造了它。" * 6 + "</p></div>", "山上有一座古老的房子，人们建造了它。" * 6),
    ("<ul><li>Home<li>News<li>Sport</ul>", ""),
])
def test_pages(html, text):
    assert extract_text(html) == text


def test_table_of_pages(spark):
    rows = [(1, "u", f"<article><p>{ARTICLE}</p></article>", "x"), (1, "u", None, "x"), (None, None, "<p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in extract_pages(df).collect()), key=repr)
    assert got == sorted([(1, "u", ARTICLE, len(ARTICLE)), (1, "u", "", 0), (None, None, "", 0)], key=repr)
    assert extract_pages(df.filter("false")).count() == 0


@pytest.mark.parametrize("part", ["<b>", "<div>", "<p><b>", "<li><div>", "</span>", "<td><p><b>", "<div></b>", "<ul><li>", "<![x[",
                                  "<!--", "</", "<a href='", "&#", "<p class='a b'>", "<table><tr><td>"])
def test_time_is_linear(part):
    """Many elements that nothing closes, and scraps of markup."""
    start = time.perf_counter()
    extract_text("<p><td>" + "<b>" * 3000 + part * 12_000 + "<div></div>" * 3000 + ARTICLE)
    assert time.perf_counter() - start < 3


def test_no_page_is_an_error():
    rng = random.Random(8)
    scraps = ["<", ">", "<!", "<![", "<![CDATA[", "]]>", "<!--", "-->", "</", "<?", "&", "&#x", "&amp", "<p", "<p>", "</p>", "<a b='",
              "'", '"', "=", "<script>", "</script", "<article>", "<li>", "</ul>", "x", " ", "\x00", "é", "<!doctype", "<svg/>", "[", "]"]
    for _ in range(4000):
        assert isinstance(extract_text("".join(rng.choices(scraps, k=rng.randint(1, 25)))), str)
