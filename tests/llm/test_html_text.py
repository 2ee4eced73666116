"""Main text of pages against hand-made expectations."""

import re
import time
from html import escape, unescape

import pytest

from histora.llm.html_text import extract_main_text, main_text, page_texts

P1 = "The council met on Tuesday to discuss the new bridge over the river, and most members were in favour of it."
P2 = "Costs are put at four million, half of which the state would pay; work could begin in spring."
P3 = "Short end."


def body(inner):
    return f"<!DOCTYPE html><html><head><title>Site</title><style>p{{x:y}}</style></head><body>{inner}</body></html>"


def blocks(*parts):
    return "\n\n".join(parts)


NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">Sport</a></li></ul></nav>'
FOOT = "<footer>&copy; 2024 Example News &middot; All rights reserved, no part may be copied.</footer>"

CASES = {
    "article": (f"{NAV}<article><h1>A bridge</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p></article>{FOOT}", ("A bridge", P1, P2, P3)),
    "one short paragraph": (f"{NAV}<article><p>{P3}</p></article><div>{P1}</div>{FOOT}", (P3,)),
    "unclosed paragraphs": (f"{NAV}<article><h1>A bridge</h1><p><b>{P1}<br><p>{P2}<p>{P3}</article>{FOOT}", ("A bridge", P1, P2, P3)),
    "cut off": (f"{NAV}<article><h1>A bridge</h1><p>{P1}</p><p>{P2} <a href='x", ("A bridge", P1, P2)),
    "divs with class names": (
        f'<div id="header"><h1>Example News</h1></div><div class="menu"><a href="1">Home</a> <a href="2">News</a></div>'
        f'<div id="content"><h2>A bridge</h2><p>{P1}</p><p>{P2}</p></div><div class="sidebar"><p>{P1} {P2}</p></div>'
        f'<div id="footer">{P2}</div>',
        ("A bridge", P1, P2),
    ),
    "no names at all": (
        f'<div><a href="1">Home</a> <a href="2">News</a> <a href="3">Sport</a> <a href="4">Culture</a></div>'
        f'<div><h2>A bridge</h2><p>{P1}</p><p>{P2}</p><p>{P1}</p></div><div><a href="5">Imprint</a> <a href="6">Contact us</a></div>',
        ("A bridge", P1, P2, P1),
    ),
    "two sections": (
        f'<div><a href="1">Home</a> <a href="2">News</a> <a href="3">Sport</a> <a href="4">Culture</a></div>'
        f"<div><section><p>{P1}</p><p>{P2}</p></section><section><p>{P2}</p><p>{P1}</p></section></div>",
        (P1, P2, P2, P1),
    ),
    "notices, adverts, forms, comments": (
        f'<div class="cookie-notice"><p>{P1}</p></div><div role="alert">{P2}</div><main><article><header><h1>A bridge</h1>'
        f'<p class="byline">By Ann</p></header><p>{P1}</p><div class="ad-slot">{P2}</div><aside>{P2}</aside>'
        f'<form action="/s"><p>{P1}</p><input name=q><button>Send</button></form><p>{P2}</p><footer>Filed under roads</footer></article>'
        f'<section id="comments"><h2>Comments</h2><article class="comment"><p>{P1} {P1}</p></article><p>{P2}</p></section></main>{FOOT}',
        ("A bridge", P1, P2),
    ),
    "layout names around the article": (
        f'<div class="layout with-sidebar"><div class="page-header-wide sidebar-left"><article class="post tag-social"><p>{P1}</p><p>{P2}</p>'
        f'</article></div><div class="widget-area"><p>{P1}</p></div></div>',
        (P1, P2),
    ),
    "form around the page": (
        f'<form method="post"><div class="nav"><a href="1">Home</a></div><div><h1>A bridge</h1><p>{P1}</p><p>{P2}</p></div></form>',
        ("A bridge", P1, P2),
    ),
    "scripts and comments with markup": (
        f'<article><p>{P1}</p><script>var a = "</p><p>no</p>"; if (1 < 2) x();</script><!-- <p>no</p> --><!----><!-->'
        f"<style>p::after{{content:'<p>no'}}</style><noscript>Turn on scripts</noscript><p>{P2}</p><svg><text>no</text><path d='m'/></svg>"
        f"<textarea><p>no</p></textarea></article>",
        (P1, P2),
    ),
    "references": (
        "<article><p>a&amp;b &lt;c&gt; &#65;&#x42; &eacute;&nbsp;&notit; &bogus; &amp &am AT&T 1 < 2 <3</p></article>",
        ("a&b <c> AB é ¬it; &bogus; & &am AT&T 1 < 2 <3",),
    ),
    "white space and inline elements": (
        "<article><p> one\n\t two<b>th</b>ree <a href=x>four</a>,\r\nfive<br>six </p><ul><li>a<li>b<ul><li>c</ul></ul>"
        "<table><tr><td>x<td>y<tr><th>z</table><pre> k \n l </pre>tail</article>",
        ("one two" + "three four, five six", "a", "b", "c", "x y", "z", "k l", "tail"),
    ),
    "attributes with brackets": (
        f"""<article><p title="a > b" data-x='<p>' class=intro lang = en>{P1}</p><p title=">{P2}</p></article>""",
        (P1, P2),
    ),
    "misnested": (f"<article><b><p>{P1}</b> {P3}</p><i>{P2}</article>", (f"{P1} {P3}", P2)),
    "hidden": (f'<article><p hidden>{P1}</p><div style="display: none">{P1}</div><div aria-hidden="true">x</div><p>{P2}</p></article>', (P2,)),
    "text without elements": (P1, (P1,)),
    "nothing but a menu": (NAV, ()),
}


@pytest.mark.parametrize("name", CASES)
def test_case(name):
    inner, want = CASES[name]
    html = body(inner) if name != "cut off" else f"<html><body>{inner}"
    assert main_text(html) == blocks(*want)


def test_all_pages_of_the_test_table(spark, folder):
    """Every page has its text in an article of a heading and paragraphs."""
    rows = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r.page_id: r for r in page_texts(rows).collect()}
    assert len(got) == rows.count()
    for r in rows.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        want = blocks(*filter(None, parts))
        assert (got[r.page_id].url, got[r.page_id].text, got[r.page_id].n_chars) == (r.url, want, len(want))


def test_odd_rows(spark):
    long = body("<article>" + f"<p>{escape(P1)}</p>" * 5000 + "</article>")
    pages = [None, "", "   ", "<", "<p", "</", "&", "<!--", "\x00", long, body(CASES["article"][0])]
    rows = [(i, "u", h, 0, "x") for i, h in enumerate(pages)] + [(None, None, "<p>a</p>", None, None), (1, "u", "", 0, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = page_texts(df).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[0] == texts[1] == texts[2] == "" and texts[None] == "a" and texts[3] == "<"
    assert texts[9].count(P1) == 5000
    assert extract_main_text(df).columns == df.columns
    assert page_texts(df.where("false")).collect() == []


@pytest.mark.parametrize("unit", ["<div>", "<p><b>", "<ul><li>", "<table><tr><td>", "<form>", "<a href=x>", "<p><button>", '<a x="', "<b></i>", "<header>"])
def test_time_grows_with_the_page(unit):
    def seconds(n):
        start = time.perf_counter()
        main_text(unit * n)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(40_000) < 40 * max(seconds(4_000), 0.02)
