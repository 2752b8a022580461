"""Pages whose names and regions mislead: what must come back, and what must not."""

import time

import pytest

from larder.llm.html import main_text, named

P = "This paragraph of the article is long enough to be taken for prose, with commas, words and a full stop at its end."
Q = "Another paragraph follows here, and it too says something at length that a reader of the page would like to read."
JUNK = "Subscribe now and save, this offer is for new readers only and ends soon."
BODY = f"<p>{P}</p><p>{Q}</p><p>{P}</p><p>{Q}</p><p>{P}</p>"
TEXT = "\n".join([P, Q, P, Q, P])
NAV = "<nav><a href='/a'>Home</a><a href='/b'>News</a></nav>"


@pytest.mark.parametrize("name", ["search", "legal", "notice", "social", "share", "modal", "banner story", "related content", "promoted post", "header main"])
def test_a_wrapper_with_a_misleading_name_is_no_junk(name):
    assert main_text(f"<body>{NAV}<div class='{name}'><h1>Title</h1>{BODY}</div><footer>Imprint</footer></body>") == "Title\n" + TEXT


@pytest.mark.parametrize("tag", ["form id='aspnetForm'", "form", "div class='modal'><form"])
def test_a_form_around_the_page(tag):
    page = f"<body><{tag}>{NAV}<div id='c'>{BODY}</div><div class='sidebar'><p>{JUNK}</p></div><select><option>x</select></form></body>"
    assert main_text(page) == TEXT


def test_a_form_in_an_article_is_one():
    assert main_text(f"<article>{BODY}<form><label>Your address</label><input><p>{JUNK}</p></form></article>") == TEXT


NAMES = ["comment-body", "ads-300x250", "advert-inline", "sponsored-message", "share-tools", "cookie-consent-v2", "related-stories", "newsletter-cta", "promo-card"]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("around", ["article", "div"])
def test_named_parts_within_an_article(name, around):
    assert main_text(f"<body>{NAV}<{around}>{BODY}<div class='{name}'><p>{JUNK}</p><p>{JUNK}</p></div><p>{Q}</p></{around}></body>") == TEXT + "\n" + Q


def test_a_story_beside_an_article_that_teases():
    page = f"<body>{NAV}<div class='story'><h1>T</h1>{BODY}</div><article class='card'><h2>Other</h2><p>{Q} {Q}</p></article></body>"
    assert main_text(page) == "T\n" + TEXT


def test_an_article_beside_shorter_texts():
    assert main_text(f"<body><div><p>{JUNK}</p></div><article>{BODY}</article><div><p>{Q}</p></div></body>") == TEXT


@pytest.mark.parametrize("page", ["<body><div>{0}</div><div><h2>Sub</h2><p>Short tail line.</p></div></body>", "<body><div><div>{0}</div><section><h2>Sub</h2><p>Short tail line.</p></section></div></body>"])
def test_a_short_section_with_a_heading_stays(page):
    assert main_text(page.format(BODY)) == TEXT + "\nSub\nShort tail line."


def test_a_menu_with_a_heading_goes():
    assert main_text(f"<body><div>{BODY}</div><div><h2>More</h2><p><a href='/x'>Another page of ours</a></p></div></body>") == TEXT


def test_a_page_that_is_but_a_notice_has_no_text():
    assert main_text("<body><div class='cookie-notice'><p>We use cookies.</p></div></body>") == ""


def test_a_sidebar_longer_than_the_text_is_still_one():
    assert main_text(f"<body><div><p>{P}</p><p>{Q}</p></div><div class='sidebar'>{BODY}</div></body>") == f"{P}\n{Q}"


def test_comments_never_hold_the_page():
    assert main_text(f"<body><article><p>{P}</p></article><div id='comments'>{BODY}{BODY}</div></body>") == P
    assert main_text(f"<body><div id='comments'>{BODY}{BODY}</div></body>") == ""


def test_names():
    assert not any(map(named, ("with-sidebar", "no-comments", "category-social-science", "tag-legal", "entry-header", "has-ads", "shareholder", "adaptive")))
    assert all(map(named, (*NAMES, "sidebar-left", "siteHeader", "cookie_notice", "post-comments")))


def test_work_is_linear():
    n = 40_000
    begun = time.time()
    for page in ("<div><h2>a</h2><p>b c" * n, "<div class='search'><div><h2>a</h2><p>b c" * n, f"<div class='modal'><p>{P}" * (n // 20)):
        main_text(page)
    assert time.time() - begun < 30
