import re
import time

import duckdb
import pytest

from plumbline.llm import html_text as H

PARA = "First &amp; long paragraph of text, with some words; and it goes on. Indeed it does."


def page(article, around=""):
    return f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=/>Home</a></nav>{article}{around}<footer>&copy; me</footer></body></html>"


def test_article_without_furniture():
    text = H.main_text(page(f"<header>Site</header><article><h1>Head</h1><p><b>{PARA}<br><p>Short.</p><script>x('</p>')</script></article>", "<aside>side words, and more.</aside>"))
    assert text == "Head\n" + PARA.replace("&amp;", "&") + "\nShort."


def test_container_found_by_ratios():
    side = "<div class=sidebar><p>Some sidebar text, with words. Many words.</p></div>"
    comments = "<div class='comments'><p>I agree, great post! It was very nice, I liked it, and so did others.</p></div>"
    links = "<ul>" + "<li><a href=x>link text</a></li>" * 8 + "</ul>"
    body = f"<div id=w><div class=text><h2>Head</h2><p>{PARA}<p>{PARA}<ul><li>one</li></ul></div>{links}{side}{comments}</div><div class='cookie-notice'>We use cookies.</div><form><p>Name</p></form>"
    assert H.main_text(page(body)).split("\n") == ["Head", PARA.replace("&amp;", "&"), PARA.replace("&amp;", "&"), "one"]


def test_broken_and_empty_pages():
    assert H.main_text("") == "" and H.main_text("<p") == "" and H.main_text("<script>never closed") == ""
    assert H.main_text("plain  text") == "plain text"
    assert H.main_text("<p>a<p>b &lt;c&gt; &nbsp;d</div></span>") == "a\nb <c> d"


def test_ratios_decide_without_article_tags():
    menu = "<ul>" + "<li><a href=x>Some link</a></li>" * 6 + "</ul>"
    p = f"<body><div>{menu}</div><div>Buy now.</div><div><h1>Head</h1><p>{PARA}</p><p>{PARA} {PARA}</p><p>Short.</p></div><div>&copy; me, 2020</div></body>"
    text = PARA.replace("&amp;", "&")
    want = f"Head\n{text}\n{text} {text}\nShort."
    assert H.main_text(p) == want
    assert H.main_text(f"<form>{p}</form>") == want  # a page in a form as a whole
    blocks, _ = H.blocks_of(p)
    assert [b.text for b, yes in zip(blocks, H.select(blocks)[0], strict=True) if yes and b.linked] == []


def test_path_ratios_by_hand():
    """Two paths, five blocks: ratios per path, smoothed by 1-2-1, fused, against the mean over characters."""
    blocks, _ = H.blocks_of("<div><p>aaaa aaaa, bbbb.</p><p>cc cc cc cc cc cc.</p></div><ul><li>x</li><li>y</li><li>z</li></ul>")
    lengths, points = [16, 18, 1, 1, 1], [2, 1, 0, 0, 0]
    text, point = [17, 17, 1, 1, 1], [1.5, 1.5, 0, 0, 0]
    soft = lambda x: [(x[max(i - 1, 0)] + 2 * x[i] + x[min(i + 1, 4)]) / 4 for i in range(5)]
    assert [len(b.text) for b in blocks] == lengths and sum(points) == 3
    for got, (t, q) in zip(H.select(blocks), ((soft(text), soft(point)), (text, point)), strict=True):
        fused = [a * (1 + b) for a, b in zip(t, q, strict=True)]
        bar = H.THRESHOLD * sum(f * n for f, n in zip(fused, lengths, strict=True)) / sum(lengths)
        assert got == [f >= bar for f in fused]


def test_named_parts_of_an_article_stay():
    p = page(f"<article><p>{PARA}</p><section class='discussion'><h2>Discussion</h2><p>{PARA}</p></section><div class='comments'><p>{PARA}</p></div></article>")
    assert H.main_text(p).split("\n") == [PARA.replace("&amp;", "&"), "Discussion", PARA.replace("&amp;", "&")]


def test_elements_never_closed_drop_nothing_else():
    for tag in ("svg", "math", "noscript", "template", "iframe", "textarea", "canvas", "audio", "video", "select", "object", "button"):
        assert H.main_text(f"<article><p>before</p><{tag} x=y><p>after</p>") == "before\nafter"
        assert H.main_text(f"<article><p>before</p><{tag}>gone</{tag}><p>after</p>") == "before\nafter"
        assert H.main_text(f"<article><p>before</p><{tag}><p>after</p><{tag}>gone</{tag}>") == "before\nafter"


def test_hostile_pages_take_linear_time():
    begin = time.time()
    for p in ("<a " * 50000, "<div>" * 20000 + "x", "<" * 100000, "</b>" * 50000, "<p>x" * 20000, "<!--" * 30000, "<option>x" * 64000, "<svg>" * 50000, "<p>x<a href=y>y</a>" * 20000):
        H.main_text(p)
    assert time.time() - begin < 30
    begin = time.time()
    H.main_text("<option>" * 64000)
    assert time.time() - begin < 3


def test_table(spark):
    rows = [(1, "u", page(f"<article><p>{PARA}</p></article>")), (2, None, None), (None, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    got = sorted(H.extract(df).collect(), key=lambda r: str(r.page_id))
    want = PARA.replace("&amp;", "&")
    assert [tuple(r) for r in got] == [(1, "u", want, len(want)), (2, None, "", 0), (None, "v", "", 0)]
    assert H.extract(df.limit(0)).count() == 0


LONG = "This is a long paragraph with words, and some more words; it goes on. Indeed it does, yes."


@pytest.mark.parametrize(
    "html, want",
    [
        (f'<article class="post {{}}"><h1>T</h1><p>{LONG}</p><p>{LONG}</p></article><div class="x"><p>See also.</p></div>', ["T", LONG, LONG]),
        (f'<div class="post {{}}"><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><div class="x"><p>See also.</p></div>', ["T", LONG, LONG]),
        (f'<div class="sidebar {{}}"><article><h1>T</h1><p>{LONG}</p><p>{LONG}</p></article></div><div class="x"><p>See also.</p></div>', ["T", LONG, LONG]),
    ],
)
@pytest.mark.parametrize("names", ["has-share", "comments-open", "no-sidebar", "with-ads", "has-share no-sidebar comments-open"])
def test_names_dont_sink_the_article(html, want, names):
    assert H.main_text(html.format(names)).split("\n") == want


def test_page_in_a_form_keeps_its_heading():
    assert H.main_text(f"<body><form><div><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div></form>").split("\n") == ["T", LONG, LONG]


@pytest.mark.parametrize("name", ["promo-effects", "related"])
def test_paragraphs_like_their_neighbours_stay(name):
    assert H.main_text(f'<article><p>{LONG}</p><section class="{name}"><p>{LONG}</p></section><p>{LONG}</p></article>').split("\n") == [LONG] * 3


def test_links_amid_paragraphs_stay():
    links = "".join(f"<li><a href={i}>reference {i}</a></li>" for i in range(4))
    assert H.main_text(f"<article><p>{LONG}</p><ul>{links}</ul><p>{LONG}</p></article>").split("\n") == [LONG, *(f"reference {i}" for i in range(4)), LONG]


def as_div(page, tags="article|main"):
    return re.sub(rf"(</?)({tags})\b", r"\1div", page)


@pytest.mark.parametrize(
    "change, equal",
    [
        (lambda h: h, 2500),
        (as_div, 2497),
        (lambda h: re.sub(' class="[^"]*"', "", as_div(h, "article|main|nav|footer|aside|header")), 1890),
        (lambda h: h.replace("<article>", '<article class="post has-share no-sidebar comments-open with-ads">'), 2500),
        (lambda h: as_div(h.replace("<article>", '<article class="post has-share no-sidebar comments-open with-ads">')), 2497),
    ],
    ids=["as given", "article as div", "no names", "noise", "noise on div"],
)
def test_all_pages_against_their_articles(change, equal):
    """How many pages of the largest table give just the article's own blocks (the figures of the README)."""
    pages = [h for (h,) in duckdb.sql("select html from '/root/testdata/sf0.1/pages.parquet'").fetchall()]
    own = [re.search("<article>(.*?)(</article>|<footer>)", h, re.S)[1] for h in pages]
    want = ["\n".join(b.text for b in H.blocks_of(x)[0]) for x in own]
    assert sum(H.main_text(change(h)) == w for h, w in zip(pages, want, strict=True)) >= equal
