"""Parts of an article that cuts by share, by links or by tag would drop."""

import pytest
from test_pages_and_chats import LONG

from larder.llm import html


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><div><p>{LONG * 30}</p></div><div><p>{LONG}</p></div>", f"{LONG * 30}\n{LONG}"),
        (f"<body><div><p>{LONG}</p><p><a href='x'>a linked line</a> of it</p><p>{LONG}</p></div>", f"{LONG}\na linked line of it\n{LONG}"),
        (f"<article><p>{LONG}</p><figure><img src=x><figcaption>A caption.</figcaption></figure><p>end</p></article>", f"{LONG}\nA caption.\nend"),
        (f"<body><div><ul><li><a href='/'>Home</a><li><a href='/b'>B</a></ul></div><div><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
        (f"<nav><figcaption>menu</figcaption></nav><article><p>{LONG}</p></article>", LONG),
    ],
)
def test_nothing_of_the_article_goes(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><div class='content with-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<body><div class='site no-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<body><div class='post category-social-science layout--sidebar-left'><p>{LONG}</p></div>", LONG),
        (f"<article><header class='entry-header'><h1>T</h1></header><p>{LONG}</p></article><article class='comment'><p>{LONG} No.</p></article>", f"T\n{LONG}"),
        (f"<header><h1>Site</h1></header><div id='siteHeader'>{LONG}</div><div class='cookie-notice sticky'>{LONG}</div><main><h1>T</h1><p>{LONG}</p></main>", f"T\n{LONG}"),
        (f"<div class='widget-area'><article><p>{LONG}</p></article></div><div class='comment-list'><article><p>{LONG} I say.</p></article></div>", LONG),
        (f"<article><p>{LONG}</p><div class='sidebar-left'>menu</div><div class='socialShare'>share</div><div class='related-posts'>see</div><p>end</p></article>", f"{LONG}\nend"),
        (f"<body><div><p>{LONG}</b></p></td><span>{LONG}</div><p>{LONG}", f"{LONG}\n{LONG}\n{LONG}"),
    ],
)
def test_names_are_whole(page, text):
    assert html.main_text(page) == text


def test_deep_pages_take_linear_time():
    import time

    begun = time.time()
    n = 50_000
    assert html.main_text("<div>x" * n) == "\n".join(["x"] * n)
    assert html.main_text("<b>" * n + "<p>x</i></span></td>" * n + f"<p>{LONG}") .endswith(LONG)
    assert time.time() - begun < 30


def test_main_text_over_all_pages(spark, small):
    """The article's own text of every page of the smallest table, by a plain pattern over its only article."""
    import html as std
    import re

    from larder.llm.queries import op10_main_text

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in op10_main_text(spark, small).collect()}
    assert got.keys() == pages.keys()
    exact = articles = 0
    for k, page in pages.items():
        inside = re.findall(r"<article[^>]*>(.*?)</article>", page or "", re.S)
        assert got[k]["n_chars"] == len(got[k]["text"])
        if len(inside) == 1:
            articles += 1
            words = std.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inside[0]))).split()
            exact += words == got[k]["text"].split()
    assert articles > 0 and exact / articles > 0.99
