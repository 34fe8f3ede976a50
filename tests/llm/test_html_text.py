import html
import re

import pytest
from pyspark.sql import types as T

from strata.llm import html_text, queries
from tests.llm.conftest import SF


def article(page):
    """The text of the article element, by regular expressions."""
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split())
              for b in re.split(r"</?(?:p|h\d)>", body))
    return "\n".join(b for b in blocks if b)


def test_every_page_against_its_article(spark, small):
    got = queries.op2_html_extraction(spark, SF).toPandas().set_index("page_id")
    assert len(got) == len(small["pages"])
    for page_id, page in zip(small["pages"].page_id, small["pages"].html):
        assert got.text[page_id] == article(page)
        assert got.n_chars[page_id] == len(got.text[page_id])


def test_without_article_element():
    long = "A sentence with enough words to be content, and some more of them. " * 4
    page = (f"<html><body><div id='top-menu'><a>Home</a><a>News</a></div><div class='sidebar'><p>{long}</p></div>"
            f"<div id=c><h1>Title</h1><p>{long}<p>Short.<p>{long}</div>"
            f"<form><p>{long}</p></form><div class='comments'><p>{long}</p></div><footer>{long}</footer></body></html>")
    text = html_text.main_text(page)
    assert text == "\n".join(["Title", long.strip(), "Short.", long.strip()])


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("<script>var a = '<p>x</p>';</script>", ""),
    ("<p>a &amp; b&nbsp;&#233;\n\t c", "a & b é c"), ("plain", "plain"),
    ("<article><header><h1>H</h1></header><p>x<br>y</p><aside>no</aside><p>z</article>", "H\nx y\nz"),
    ("<article><p>a</p><section class='post-comments'><p>b</p></section></article>", "a"),
    ("<![foo]><p>x</p></div></p>", "x"), ("<article><p>u</b></i><p hidden>v<p>w", "u\nw"),
])
def test_cases(page, text):
    assert html_text.main_text(page) == text


def test_long_and_odd_tables(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("html", T.StringType()), T.StructField("text", T.StringType())])
    long = "<article>" + "<p>some words here and there</p>" * 20_000 + "</article>"
    nested = "<div>" * 3000 + "deep text in many elements"
    df = spark.createDataFrame([(1, None, long, "x"), (None, "u", None, "x"), (1, None, long, "x"), (2, "u", nested, "")], schema)
    got = html_text.extract(df).collect()
    each = len("\n".join(["some words here and there"] * 20_000))
    assert [r.n_chars for r in got] == [each, 0, each, len("deep text in many elements")]
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


def test_gaussian_and_threshold():
    assert html_text.smooth([3.0]) == [3.0]
    assert html_text.smooth([1.0] * 7) == pytest.approx([1.0] * 7)
    assert 1 < html_text.threshold([0.0, 1.0, 9.0, 10.0]) < 9


LONG = " ".join(["A sentence with enough words to be content, and some more of them."] * 4)


@pytest.mark.parametrize("attrs", [
    "class='content with-sidebar'", "id='page' class='no-sidebar'", "class='post has-comments'",
    "class='has-menu main-wrap'", "class='post comments-open'", "class='sidebar'", "id='social'", "class='comments'"])
def test_layout_wrappers_are_not_hidden(attrs):
    for inner in (f"<article><p>{LONG}</p></article>", f"<main><p>{LONG}</p></main>", f"<p>{LONG}</p>"):
        page = f"<html><body><nav>x</nav><div {attrs}>{inner}</div><div class=ad>buy</div></body></html>"
        assert html_text.main_text(page) == LONG


def test_hints_still_hide():
    junk = f"<div class='sidebar'><p>{LONG}</p></div><p class='share'>Share this</p>"
    assert html_text.main_text(f"<body><main><p>{LONG}</p><p>Short.</p><p>{LONG}</p></main>{junk}</body>") == f"{LONG}\nShort.\n{LONG}"
    thread = f"<div id='comments'>{f'<article class=comment><p>{LONG}</p></article>' * 9}</div>"
    assert html_text.main_text(f"<body><article><p>{LONG}</p></article>{thread}</body>") == LONG
    assert html_text.main_text(f"<article><p>{LONG}</p><div class=related><article>Teaser</article></div></article>") == LONG
    assert html_text.main_text(f"<article class='commentary comments-open'><p>{LONG}</p></article>") == LONG


def test_nothing_left_takes_all_lines():
    page = "<div class=menu>one two</div><div class=share>six ten</div><div class=ad>two six</div>"
    assert html_text.main_text(page) == "one two\nsix ten\ntwo six"
    assert html_text.main_text("<nav>one</nav><div role=search>two</div>") == ""


def test_region_holds_all_articles_and_sections():
    def para(k):
        return f"<p>{LONG} {k}</p>"

    def lines(*which):
        return "\n".join(f"{LONG} {k}" for k in which)

    links = "<ul>" + "<li><a>x</a></li>" * 8 + "</ul>"
    two = f"<article>{para(1)}{para(2)}{para(3)}</article><article>{para(4)}{para(5)}</article>"
    for holder in ("main", "div"):
        page = f"<body>{links}<{holder}>{two}</{holder}>{links}</body>"
        assert html_text.main_text(page) == lines(1, 2, 3, 4, 5)
        page = f"<body>{links}<{holder}>{para(0)}<article>{para(1)}{para(2)}{para(3)}</article>{para(4)}</{holder}>{links}</body>"
        assert html_text.main_text(page) == lines(0, 1, 2, 3, 4)
    three = f"<div>{two}</div><article>{para(6)}</article>"
    assert html_text.main_text(f"<body>{links}<div>{three}</div>{links}</body>") == lines(1, 2, 3, 4, 5, 6)
    most = f"<article>{para(1)}{para(2)}{para(3)}{para(4) * 4}</article>{para(5)}"
    assert html_text.main_text(f"<body>{links}<main>{most}</main>{links}</body>") == lines(1, 2, 3, 4, 4, 4, 4)


def renamed(page, *tags):
    for tag in tags:
        page = page.replace(f"<{tag}>", "<div>").replace(f"</{tag}>", "</div>")
    return page


def test_article_is_found_without_its_tag(small):
    """Brute force: the article's lines, cut out of the page before its tag is renamed."""
    for page in small["pages"].html:
        assert html_text.main_text(renamed(page, "article")) == article(page)


def test_clustering_alone_finds_the_article(small, monkeypatch):
    """No tag, class or role tells anything: menu, advert, article and footer are all plain divs."""
    bare = [renamed(p, "article", "nav", "footer").replace('<div class="ad">', "<div>") for p in small["pages"].html]
    want = [article(p).split("\n") for p in small["pages"].html]

    def outcome():
        got = [html_text.main_text(p).split("\n") for p in bare]
        assert all(set(w) <= set(g) for w, g in zip(want, got))
        return sum(len(g) - len(w) for w, g in zip(want, got)), sum(w == g for w, g in zip(want, got))

    added, exact = outcome()
    assert exact >= 0.85 * len(bare)
    monkeypatch.setattr(html_text, "threshold", lambda values, rounds=20: -1.0)
    assert outcome()[0] > 2 * added


@pytest.mark.parametrize("inner", [
    f"<section class='related-work'><p>{LONG}</p></section>", f"<div class='alert'><p>{LONG}</p></div>",
    "<ul class='menu'><li>Soup</li><li>Steak</li></ul>", "<table class='ads-data'><tr><td>1</td><td>2</td></tr></table>",
    f"<div class='notice notice-box'><p>{LONG}</p></div>", "<p>Hi.</p>", "<ul><li><a href=x>One</a></li></ul>"])
def test_true_content_inside_the_region_stays(inner):
    want = [x for x in re.split(r"<[^>]*>", inner) if x]
    for holder in ("article", "main", "div"):
        page = f"<body><nav>x</nav><{holder}>{inner}<p>{LONG} 1</p><p>{LONG} 2</p></{holder}><div class=ad>buy</div></body>"
        assert html_text.main_text(page).split("\n") == [*want, f"{LONG} 1", f"{LONG} 2"]


@pytest.mark.parametrize("junk", [
    "<ul class='menu'><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul>", "<div class='ad-box'>Buy now</div>",
    "<p class='share-links'>Share this</p>", "<div class='related'><p>Teaser</p></div>", f"<div class='sidebar'><p>{LONG}</p></div>",
    f"<div class='comments'><p>{LONG}</p></div>", "<div class='alert alert-top'>Cookies!</div>", f"<form><p>{LONG}</p></form>"])
def test_boilerplate_inside_the_region_goes(junk):
    for holder in ("article", "main", "div"):
        page = f"<body><{holder}><p>{LONG} 1</p>{junk}<p>{LONG} 2</p></{holder}></body>"
        assert html_text.main_text(page) == f"{LONG} 1\n{LONG} 2"


@pytest.mark.parametrize("page, text", [
    ("<p>a &amp; b<p>c", "a & b\nc"), ("<table><tr><td>a<td>b</table>", "a\nb"),
    (f"<p>Hi.</p><p>{LONG} 1</p><p>{LONG} 2</p><p>Bye.</p>", f"Hi.\n{LONG} 1\n{LONG} 2\nBye."),
    (f"<ul><li><a href=x>Home</a><li><a href=y>News</a></ul><h1>T</h1><p>{LONG}</p><p>{LONG}</p>", f"T\n{LONG}\n{LONG}")])
def test_pages_without_a_group(page, text):
    assert html_text.main_text(page) == text
