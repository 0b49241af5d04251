"""Main-text extraction: layouts of another hand than the training pages, time and memory on unkind pages."""

import time
import tracemalloc

import pytest

from foliant.llm import html
from foliant.llm.common import portions

ONE = "The council voted on Tuesday to rebuild the old stone bridge, which was closed after the spring floods damaged two of its piers."
TWO = "Work is to begin in early autumn; the engineers expect that traffic can return within eighteen months, if the weather holds."
THREE = "Residents had asked for a footpath beside the road, and the new design has one on either side of the carriageway."
LINKS = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("Home", "World", "Business", "Sport", "Weather"))

#: (html, main text).  Layouts as blogs, papers, manuals and old pages have them.
LAYOUTS = {
    "news": (f"""<!doctype html><html lang=en><head><meta charset=utf-8><title>Bridge</title><script>var a="<p>no</p>";</script></head><body>
        <div id="masthead" class="site-masthead"><span>The Daily Example</span></div><ul class="nav-primary">{LINKS}</ul>
        <div role="main"><article><h1>Old bridge to be rebuilt</h1><p>{ONE}</p><div class="ad-slot">Buy shoes now</div><p>{TWO}</p><p>{THREE}</p></article></div>
        <div class="related-links"><h4>Related</h4><ul>{LINKS}</ul></div><div id="footer">Copyright 2024 Example Media. All rights reserved.</div></body></html>""",
        ["Old bridge to be rebuilt", ONE, TWO, THREE]),
    "blog": (f"""<body class="home"><header class="top"><h2><a href="/">My garden notes</a></h2></header><nav><a href=/>Home</a> <a href=/about>About</a></nav>
        <main><section class="post-content"><h1>Stone and water</h1><p>{ONE}<p>{TWO}<blockquote><p>{THREE}</blockquote></section>
        <section id="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>Lovely to read, thank you for this.</p></div><div class="comment"><b>Bob</b><p>I remember the old bridge well.</p></div></section></main>
        <aside class="widget"><h3>About me</h3><p>I write about gardens.</p></aside><footer>&copy; me</footer>""", ["Stone and water", ONE, TWO, THREE]),
    "old": (f"""<HTML><HEAD><TITLE>Bridge</TITLE><BODY BGCOLOR=white><TABLE WIDTH=100% class="navbar"><TR><TD><A HREF=a.htm>Index</A> | <A HREF=b.htm>Maps</A> | <A HREF=c.htm>Mail</A></TABLE>
        <DIV CLASS=content><H1>Notes on a bridge</H2><P>{ONE}<P>{TWO}<P>{THREE}</DIV></BODY></HTML>""", ["Notes on a bridge", ONE, TWO, THREE]),
    "manual": (f"""<div class="toolbar"><form action=/search><input name=q><button>Search<div class=x></form></div><div class="content"><h2>Rebuilding</h2><p>{ONE}</p><ul><li>{TWO}</li><li>{THREE}</li></ul><pre>stone  --fix</pre></div>
        <div class="pagination"><a href=1>1</a> <a href=2>2</a> <a href=3>3</a></div><div class="cookie-banner"><p>We use cookies to make this site work better.</p><button>Accept</button></div>""",
        ["Rebuilding", ONE, TWO, THREE, "stone --fix"]),
    "custom": (f"""<app-root><site-nav class="menu">{LINKS}</site-nav><article><title-card><h1>Old bridge</h1></title-card><p>{ONE}</p><noscript><p>{TWO}</p></noscript><p>{THREE}</p></article>
        <newsletter-form class="newsletter"><form><label>Get our letter</label><input></form></newsletter-form></app-root>""", ["Old bridge", ONE, TWO, THREE]),
    "open head": (f"<head><title>T</title><meta name=x><h1>Old bridge</h1><p>{ONE}<p>{TWO}<p>{THREE}",
    ["Old bridge", ONE, TWO, THREE]),
}


def trim(lines):
    return [" ".join(x.split()) for x in lines]


def test_other_layouts():
    got = [t.split("\n") for t in html.texts([h for h, _ in LAYOUTS.values()], html.model())]
    hits = lost = extra = 0
    for own, (_, want) in zip(got, LAYOUTS.values()):
        hits += sum(x in own for x in want)
        lost += sum(x not in own for x in want)
        extra += sum(x not in want for x in own)
    assert lost == 0 and extra <= 2 and hits == sum(len(w) for _, w in LAYOUTS.values())


@pytest.mark.parametrize(("page", "want"), [
    ("<head><title>T</title><meta><h1>Head</h1><p>Body", ["Head", "Body"]),
    ("<article><button>Share<p>one</p><p>two</p></article>", ["one", "two"]),
    ("<button><div>Share</div></button><p>one</p>", ["one"]),
    ("<p>one</p><title-card>two</title-card><p>three", ["one", "two", "three"]),
    ("<p>a</p><noscript>no <b>x</b></noscript><xmp><b>raw</b> &amp;</xmp><p>z", ["a", "no x", "<b>raw</b> &amp;", "z"]),
    ("<p>one <title>two<p>three", ["one two", "three"]),
    ("<p>one<textarea>two</textarea><p>three", ["one", "three"]),
    ("<p title=it's>text <b title=\"it's > x\">b</b> c", ["text b c"]),
    ("<p>if a<b then c<d; &lt;e", ["if a<b then c<d; <e"]),
    ("a</br>b<h1>t</h2>x <a href=/x/>link</a>", ["a b", "t", "x link"]),
    ("<svg><title>q</title><text>no</text></svg>one<svg/>two<svg><path><p>three", ["onetwo", "three"]),
    ("<video src=x><p>one<object><p>two", ["one", "two"]),
    ("<select><option>a<option>b</select>one<select><option>c<p>two", ["one", "two"]),
    ("<!-->one<!--->two<!-- no --!>three<!-- no", ["onetwothree"]),
    ("<p>&#" + "9" * 6000 + ";x &amp; y", ["�x & y"]),
    ("<plaintext><b>all</b> of it", ["<b>all</b> of it"]),
])
def test_markup(page, want):
    assert [t for _, t in html.parse(page).segments] == want


@pytest.mark.parametrize("unit", ["<a", "i<n ", '<a x="', '<a x=">" ', "<a '", "<div>", "<b></i>", "<!--", "<svg>",
    "<button>", "<title>", "<object>", "<p>x", "<table><td>", "<li>x<ul>", "<a =", "<select>",
                                  "<i><div>", "<tr><td><p>", "</", "<a href=/>", "&#99999999999999999999", "<script>",
                                  "<textarea>"])
@pytest.mark.parametrize("tail", ["", ">", "<p>x</p>", '"> </button></select>'])
def test_time_is_linear(unit, tail):
    def took(n):
        best = 9.0
        for _ in range(2):
            began = time.perf_counter()
            html.parse(unit * n + tail)
            best = min(best, time.perf_counter() - began)
        return best

    small, large = took(2_000), took(16_000)
    assert large < 0.05 or large < 24 * small


def test_large_pages_are_held_a_few_at_a_time():
    pages = ["<article>" + "<p>some words, here</p>" * 45_000 + "</article>"] * 6  # of about 1 MB
    sizes = [len(p) for p in pages]
    assert [n for _, n in portions(sizes, html.BATCH_BYTES)] == [2, 2, 2] and list(portions([], 9)) == []
    assert [n for _, n in portions([5] * 500, 1 << 20)] == [200, 200, 100] and [n for _,
        n in portions([9, 9], 8)] == [1, 1]
    trees = html.model()
    tracemalloc.start()
    got = [t for at, n in portions(sizes, html.BATCH_BYTES) for t in html.texts(pages[at : at + n], trees)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(got)) == 1 and got[0].count("\n") == 44_999 and peak < 250 << 20
