"""Main text of pages: hand-made sites and the given ones."""

import html
import re
import time

from helpers import SF

from tapeloom.llm import queries, webtext

PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body><header><a href=/>Home</a> Site name</header><nav><ul><li><a>One</a></ul></nav>
<div id=cookie-banner>We use cookies and more cookies for everything you do on this site, accept them all please.</div>
<div class="layout l{n}"><div class="post-{n} content"><h1>Title {n}</h1><p>First &amp; <b>bold</b>
 paragraph, with a <a href=x>link</a>.<p>Second &#233; paragraph <i>here</i><ul><li>item a<li>item b</ul></div>
<aside>Read also: something else that is long enough to be counted as text of its own right</aside><div class=comments><p>A very long comment by a reader, longer than the article itself, {filler}</p></div></div>
<script>var x = "<p>no</p>";</script><form>Name <input></form><!-- <p>hidden</p> --><footer>&copy; Us</footer></body></html>"""
WANT = "Title {n}\nFirst & bold paragraph, with a link.\nSecond é paragraph here\nitem a\nitem b"


def page(n):
    return PAGE.format(n=n, filler="word " * 200)


def test_blocks_of_a_page():
    assert webtext.text_at(webtext.Page(page(7)), []) == WANT.format(n=7)
    assert webtext.Page("").blocks == [] and webtext.text_at(webtext.Page("a<b>c"), []) == "ac"
    assert webtext.text_at(webtext.Page("<p>x <!-- open"), []) == "x"
    assert webtext.text_at(webtext.Page("<p>1 &lt; 2<script>if (a</b) x"), []) == "1 < 2"


def test_hosts_agree_on_a_path(spark):
    odd = "<html><body><div class=\"layout l9\"><div class=\"post-9 content\"><p>Tiny.</p></div><div class=links><p>" + "Elsewhere there is much more text. " * 9 + "</p></div></div></body></html>"
    rows = [(k, f"http://a.example/{k}", page(k)) for k in range(9)] + [(9, "http://a.example/9", odd), (10, None, None), (11, "http://b.example/x", ""), (12, "http://a.example/12", "<html><body><main><p>Another layout altogether.</p></main></body></html>"), (0, "http://a.example/0", page(0))]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, path string")
    for settings in (webtext.Settings(), webtext.Settings(broadcast_hosts=0)):
        got = sorted((r.page_id, r.text, r.n_chars) for r in webtext.extract(df, settings).collect())
        texts = {i: t for i, t, _ in got}
        assert all(texts[k] == WANT.format(n=k) for k in range(9)) and len(got) == len(rows) and all(len(t) == n for _, t, n in got)
        assert texts[9] == "Tiny." and texts[10] == texts[11] == "" and texts[12] == "Another layout altogether."
    assert webtext.extract(df.limit(0)).count() == 0


def test_headings_and_leads_beside_sections_stay():
    prose = "A sentence of the main text that is long enough to be taken for prose by anybody who reads it. "
    sections = "".join(f"<section><h2>Part {k}</h2><p>{prose * 3}</p></section>" for k in range(4))
    got = webtext.text_at(webtext.Page(f"<body><article><h1>Title</h1><p>Lead.</p>{sections}</article><div><a href=x>{prose}</a></div></body>"), []).split("\n")
    assert got[:3] == ["Title", "Lead.", "Part 0"] and len(got) == 10
    table = "<table>" + f"<tr><td>{prose * 2}</td></tr>" * 3 + "</table>"
    got = webtext.text_at(webtext.Page(f"<body><div class=story><p>Lead: {prose}</p>{table}</div><div class=x>Short note</div></body>"), []).split("\n")
    assert got[0].startswith("Lead:") and len(got) == 4


STORY = "A sentence of the story that is long enough to be taken for prose by anybody who reads it. "


def read(body):
    return webtext.text_at(webtext.Page(f"<html><body>{body}</body></html>"), []).split("\n")


def test_names_of_wrappers_and_topics_do_not_exclude():
    for name in ("page with-sidebar", "content no-sidebar", "has-banner", "layout--sidebar-left no-comments", "related-work", "share-price", "notice-of-motion text"):
        assert read(f'<div class="{name}"><h1>Title</h1><p>{STORY}</p></div>') == ["Title", STORY.strip()], name
        assert read(f'<article><h1>Title</h1><p>{STORY}</p><div class="{name}"><p>Short.</p></div></article>') == ["Title", STORY.strip(), "Short."], name
    for name in ("cookie-banner", "cookieBanner", "site-header", "main-nav", "left-sidebar", "comments", "post-comments", "ad-300x250", "share_buttons", "newsletter-signup-box"):
        assert read(f'<div class="{name}"><p>{STORY * 3}</p></div><div class=story><h1>Title</h1><p>{STORY}</p></div>') == ["Title", STORY.strip()], name


def test_a_name_never_takes_the_article_or_all_text():
    assert read(f'<div class="sidebar"><h1>Title</h1><p>{STORY * 3}</p><div class=comments><p>{STORY}</p></div></div><p>Short.</p>')[:2] == ["Title", (STORY * 3).strip()]
    assert read(f"<div class=widget><p>{STORY}</p></div>") == [STORY.strip()]
    assert read(f"<div class=site-header><h1>Site</h1></div><div><p>{STORY}</p></div>") == [STORY.strip()]
    assert read(f"<nav><h1>Menu</h1>{STORY * 9}</nav><p>Text.</p>") == ["Text."]


def test_headings_and_short_blocks_beside_the_story_stay():
    assert read(f"<h1>Title</h1><div class=story><p>{STORY}</p></div>") == ["Title", STORY.strip()]
    assert read(f"<h1>Title</h1><p>By somebody</p><div class=story><p>{STORY}</p></div>") == ["Title", "By somebody", STORY.strip()]
    assert read("<div>First line.</div><div>Second line, which is longer.</div><div>Third.</div>") == ["First line.", "Second line, which is longer.", "Third."]
    poem = [f"line {k} of a poem" for k in range(12)]
    assert read("<h2>Poem</h2><div class=poem>" + "".join(f"<div>{x}</div>" for x in poem) + "</div>") == ["Poem", *poem]
    cells = [f"cell {k}" for k in range(9)]
    table = "<table>" + "".join("<tr>" + "".join(f"<td>{x}</td>" for x in cells[k : k + 3]) + "</tr>" for k in (0, 3, 6)) + "</table>"
    assert read(f"<div class=wrap><div class=story><h1>Title</h1><p>{STORY}</p>{table}<p>{STORY}</p></div></div>") == ["Title", STORY.strip(), *cells, STORY.strip()]


def test_two_templates_on_one_host(spark):
    def text(k):
        return f"Sentence {k} of the main text of a page. " * 9

    first = [(k, f"http://t.example/{k}", f"<body><div class=box><p>{text(k)}</p></div></body>") for k in range(6)]
    second = [(k, f"http://t.example/{k}", f"<body><div class=box><p>Box.</p></div><div class=story><p>{text(k)}</p></div></body>") for k in range(6, 10)]
    got = webtext.extract(spark.createDataFrame(first + second, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {k: text(k).strip() for k in range(10)}


def test_query_on_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in queries.op5_html_text(spark, SF).collect()}
    assert set(got) == set(pages)
    for i, h in pages.items():
        parts = re.split(r"</?(?:p|h1|br)>", re.search(r"<article>(.*?)</article>", h, re.S)[1])
        clean = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts)
        assert got[i] == "\n".join(x for x in clean if x)


def test_deep_and_broken_pages_take_no_longer_than_their_length():
    texts = ["<div>" * 100_000 + "x", "<div>t " * 20_000, "<p>" + "<span>" * 100_000 + "</p>" * 100_000, "<a b " * 200_000, "<script " * 100_000, '<a "' * 200_000, "<!" * 300_000, "<li><div>" + "<span>" * 50_000 + "<li></li>" * 50_000]
    began = time.process_time()
    got = [webtext.text_at(webtext.Page(t), []) for t in texts]
    assert got[0] == "x" and got[1] == "\n".join(["t"] * 20_000) and time.process_time() - began < 60
    assert webtext.text_at(webtext.Page("<p>a <b x <i>c</i> <a href='1>2'>d</a"), []) == "a c d"
