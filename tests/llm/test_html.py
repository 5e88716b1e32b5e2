"""Main text of pages: regions, references, broken markup, wrappers per host."""

import html
import itertools
import json
import random
import re

import pytest

from obsflow.llm.html import expression, extract_text, main_text, merge, read_page, wrappers
from tests.conftest import SF01

PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="home sidebar-left">
<header id="top"><a href="/">Site</a></header><div class="cookie-notice">We use cookies</div>
<nav><ul><li>Home<li>News</ul></nav><main><article class="post"><header><h1>T &amp; t</h1></header>
<p>One <b>bold</b>&nbsp;two<p>Three<br>four &lt;b&gt;<div class=ad>Buy</div><ul><li>a<li>b</ul>
<!-- <p>no</p> --><section class="commentList"><p>nice</p></section><script>var a="<p>x</p>";</script>
<table><tr><td>c1<td>c2<tr><td>c3</table><pre>  x
  y </pre><div style="display: none">hid</div></article><aside>side</aside></main>
<form><p>Mail</p></form><div class="newsletter">Sub</div><footer>f</footer></body></html>"""


def test_regions():
    assert main_text(read_page(PAGE)[0]).split("\n") == [
        "T & t", "One bold two", "Three four <b>", "a", "b", "c1", "c2", "c3", "x y"]


@pytest.mark.parametrize("page,want", [
    ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<article><p>x</p><p>cut <a hre", "x\ncut"),
    ("<article>a < b &lt; &amp c &#x41;&#10;d</article>", "a < b < & c A d"), ("<body><main><h1>h</h1>t</main>z", "h\nt"),
    ("<div class='entry-content'><p>in</p></div><p>out</p>", "in"), ("<article><nav>n</nav></article>", ""),
    ("<script>var x = '<article>no</article>'", ""), ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
    ("<article><p title=\"a>b\">q</p></article>", "q"), ("</p></div>ok", "ok"),
])
def test_pages(page, want):
    assert main_text(read_page(page)[0]) == want


@pytest.mark.parametrize("page,want", [
    ("<html class=modal-ad><body class='comments-open sidebar'><article><p>x</p></article></body>", "x"),
    ("<article class='post comments-open'><p>x</p></article>", "x"), ("<main id=related-form><p>x</p></main>", "x"),
    *((f"<div class='{name}'><p>a</p><div class=menu>m</div><{tag}><p>x</p></{tag.split()[0]}></div><div class=sidebar>s</div>", "x")
      for name in ("content-sidebar-wrap", "no-sidebar", "sidebar", "long-form-body", "comments", "header")
      for tag in ("article", "main", "div role=main")),
    ("<div class=long-form-body><p>x</p></div><div class=my-sidebar>s</div><div class=adBox>t</div>", "x"),
    ("<div class='hentry comments-open'><p>x</p></div><div id=commentList>c</div>", "x"),
    ("<div class=sidebar><div class=ads>t</div><div hidden><article>h</article></div>s</div><p>x</p>", "x"),
    ("<article><p>x</p><div class=comments><article>c</article></div></article>", "x"),
])
def test_names_never_leave_out_the_article(page, want):
    assert main_text(read_page(page)[0]) == want


def test_deep_and_long_pages():
    assert main_text(read_page("<div>" * 5000 + "deep" + "</div>" * 5000)[0]) == "deep"
    assert len(main_text(read_page("<article>" + "<p>par</p>" * 50_000)[0])) == 4 * 50_000 - 1
    assert main_text(read_page("<article><a href=\"" * 3000)[0]) == ""


def test_alignment_gives_optional_and_repeated_groups():
    pages = ["<h1>a</h1><p>x</p><p>y</p><i>k</i>", "<h1>b</h1><div class=ad>z</div><p>x</p>",
             "<h1>c</h1><h2>s</h2><p>1</p><h2>t</h2><p>2</p>"]
    trees = [read_page(p)[1] for p in pages]
    two = merge(trees[0], trees[1])
    assert re.fullmatch(r"<page>'\w+'<h1>#</h1>\(<div\.ad>'\w+'</div>\)\?\(<p>#</p>\)\+</page>", expression(two))
    assert "(<h2>#</h2><p>#</p>)+" in expression(trees[2])


def run(spark, rows):
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string")
    return {r.page_id: (r.url, r.text, r.n_chars) for r in extract_text(df.repartition(3)).collect()}


def test_constants_of_a_host_go_where_nothing_names_the_article(spark):
    page = lambda i: (f"<body><div class=alpha>Welcome to our place</div><div class=beta><p>Story number {i} goes on.</p>"  # noqa: E731
                      f"<p>It ends é {i}.</p></div><div class=gamma><a href=q>All the links {i}</a></div></body>")
    rows = [(i, f"http://U@Site.com:80/{i}", page(i)) for i in range(5)] + [(9, None, None), (10, "bad url", "t"), (11, "http://e/", "")]
    got = run(spark, rows)
    for i in range(5):
        text = f"Story number {i} goes on.\nIt ends é {i}."
        assert got[i] == (f"http://U@Site.com:80/{i}", text, len(text))
    assert got[9] == (None, "", 0) and got[10][1] == "t" and got[11] == ("http://e/", "", 0)


def test_copies_of_a_page_keep_their_text(spark):
    page = "<div>Top</div><div class=a><p>One story.</p></div><div><a href=q>{}</a></div><div class=ad>{}</div>"
    lone = "<section>Lone</section><section class=b>Text</section>"
    rows = [(i, f"http://copies.com/{i}", page.format(f"link {i}", f"ad {i}")) for i in range(40)]
    rows += [(100 + i, None, page.format("", "")) for i in range(2)]
    # copies beside another page: what only the copies have stays, what both have is the template
    rows += [(200 + i, "http://mixed.com", lone) for i in range(3)] + [(210, "http://mixed.com", page.format("", ""))]
    rows += [(300 + i, "http://site.com", page.format("", "").replace("One", f"{min(i, 1)}")) for i in range(6)]
    got = run(spark, rows)
    assert {got[i][1] for i in (*range(40), 100, 101, 210)} == {"Top\nOne story."}
    assert {got[i][1] for i in range(200, 203)} == {"Lone\nText"}
    assert [got[300 + i][1] for i in range(6)] == ["0 story."] + ["1 story."] * 5


@pytest.mark.parametrize("box", ["article", "main", "div class=entry-content"])
def test_constants_of_a_host_go_inside_the_article(spark, box):
    page = lambda h, s, n="Read us daily.": (f"<body><div>{h}</div><{box}><h1>T {h}</h1><div class=motto>{n}</div><p>{s} one</p>"  # noqa: E731
                                             f"<p>{s} two</p></{box.split()[0]}></body>")
    rows = [(i, "http://a.com", page(i, f"Story {i}")) for i in range(4)] + [(9, "http://a.com", None)]  # the template's motto
    rows += [(10, "http://one.com", page(1, "Lone")), (11, "http://b.com", page(1, "Copy")), (12, "http://b.com", page(1, "Copy"))]
    rows += [(20 + i, "http://c.com", page(i, f"S {i}", f"Motto {i}")) for i in range(3)]  # differs: no constant
    rows += [(30 + i, "http://d.com", f"<div>{i}</div><{box}><h1>Same</h1><p>Copy</p><i>{i // 2}</i></{box.split()[0]}>") for i in range(4)]
    rows += [(40, "http://e.com", page(1, "A")), (41, "http://e.com", page(2, "B")),  # not in all articles: stays
             (42, "http://e.com", page(3, "C").replace("<div class=motto>Read us daily.</div>", ""))]
    got = {i: r[1].split("\n") for i, r in run(spark, rows).items()}
    for i in range(4):
        assert got[i] == [f"T {i}", f"Story {i} one", f"Story {i} two"]
    assert got[10] == ["T 1", "Read us daily.", "Lone one", "Lone two"] and got[9] == [""]
    assert got[11] == got[12] == ["T 1", "Read us daily.", "Copy one", "Copy two"]
    assert got[21] == ["T 1", "Motto 1", "S 1 one", "S 1 two"]
    assert [got[30 + i] for i in range(4)] == [["Same", "Copy", f"{i // 2}"] for i in range(4)]
    assert got[40][:2] == ["T 1", "Read us daily."] and got[42] == ["T 3", "C one", "C two"]


def mixed_pages(n, seed=5):
    """Pages without a URL and with little in common: every one has its own choice among many labels."""
    r = random.Random(seed)
    names = ["".join(x) for x in itertools.product("bcdfgh", "aeiou", "klmnp")]
    own = lambda i: "".join(f"<section class={c}><div class={r.choice(names)}><p>{c} {i}</p></div></section>"
                            for c in r.sample(names, 20))
    return [(i, None, f"<body><div class=top>Top line</div>{own(i)}<div class=end>Story {i}</div></body>") for i in range(n)]


def test_mixed_pages_of_one_host_grow_no_common_wrapper(spark):
    rows = mixed_pages(2000)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    learned = wrappers(pages).collect()
    assert sum(r.pages for r in learned) == 2000 and {r.host for r in learned} == {""}
    one = max(len(json.dumps(read_page(h)[1])) for _, _, h in rows[:100])
    assert max(len(r.wrapper) for r in learned) < 40 * one and sum(len(r.wrapper) for r in learned) < 2000 * one
    got = run(spark, rows)
    for i, _, page in rows:  # the line that all pages have goes, whatever their shapes
        assert got[i][1].split("\n") == [x for x in re.findall(r">([^<>]+)<", page) if x != "Top line"]


def test_a_constant_must_hold_in_all_shapes_of_a_host(spark):
    """Two shapes, aligned apart: what both have with the same text goes, what differs between them stays."""
    page = lambda kind, i, note: (f"<body><div class=top>Top</div><div class=note>{note}</div>"
                                  + "".join(f"<div class={kind}{c}>{kind} {c} {i}</div>" for c in "abcdefgh") + "</body>")
    rows = [(i, "http://a.com", page("x", i, "One")) for i in range(4)] + [(10 + i, "http://a.com", page("y", i, "Two")) for i in range(4)]
    got = run(spark, rows)
    for i in range(4):
        assert got[i][1].split("\n") == ["One"] + [f"x {c} {i}" for c in "abcdefgh"]
        assert got[10 + i][1].split("\n") == ["Two"] + [f"y {c} {i}" for c in "abcdefgh"]


def test_tables_without_rows(spark):
    assert run(spark, []) == {}


def test_test_pages(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    learned = wrappers(pages).collect()
    assert sum(r.pages for r in learned) == pages.count() and len({(r.host, r.shape) for r in learned}) == len(learned)
    assert all("(<p>#</p>)+" in expression(json.loads(r.wrapper)) for r in learned if r.pages > 3)
    text = {r.page_id: r.html for r in pages.collect()}
    for r in extract_text(pages).collect():
        body = text[r.page_id].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split())
                 for x in re.split(r"</?p>|</?h1>", body)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)
