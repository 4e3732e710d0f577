"""Page extraction: classes of wrappers, titles beside the article, heads that repeat."""

import time

import pytest

from waymark.llm.pagetext import main_text

PARTS = [
    "The quick river town council met on Monday, and talked about bridges, roads and schools for hours. " * 2,
    "Later, the mayor said that nothing had been decided; a vote will follow in May, perhaps. " * 2,
    "Residents, however, were not amused: they want their bridge, and they want it now. " * 2,
]
BODY = "".join(f"<p>{p}</p>" for p in PARTS)
TEXT = " ".join(" ".join(PARTS).split())
WRAPPERS = """layout no-sidebar|page with-social|has-sidebar|right-sidebar|sidebar-right|comments-open|with-ads|post comments-open has-sidebar|no-comments|without-sidebar|
sidebar-left content-right|layout-sidebar|social|page-with-newsletter|ads-enabled|cookies-active|popup-open|site has-cookie-notice|menu-open|nav-open|no-breadcrumb|with-pagination|
is-search-open|sidebar|widget|no-related|hide-share|promo-active|has-banner|main-with-aside|no-ads no-popup|single-post no-sidebar comments-open""".replace("\n", "").split("|")


@pytest.mark.parametrize("cls", WRAPPERS)
def test_a_wrapper_of_everything_is_no_part(cls):
    pages = (
        f"<html><body><div class='{cls}'><nav><a href=/>Home</a> <a href=/x>News</a></nav><div class=content>{BODY}</div></div></body></html>",
        f"<body><div class='{cls}'>{BODY}</div><footer>Copyright 2020</footer></body>",
        f"<body class='{cls}'><div class='{cls}'><article class='post {cls}'>{BODY}</article></div></body>",
    )
    assert [main_text(p) for p in pages] == [TEXT] * 3


def test_parts_beside_the_article_stay_out():
    comment = "I disagree, strongly, with all of this; bridges are bad. " * 18
    comments = "".join(f"<div class=comment><p>{comment}</p></div>" for _ in range(3))
    assert main_text(f"<body><div class=main-col>{BODY}</div><div class=comments>{comments}</div></body>") == TEXT
    assert main_text(f"<body><div class=sidebar><p>Also, read this, please.</p></div><div class=story>{BODY}</div><div class=related-posts><p>More, much more.</p></div></body>") == TEXT


def test_a_title_in_a_container_of_its_own():
    page = "<body><header><a href=/>Site</a></header><div class=article-header><h1>The bridge</h1></div><div class=article-body>{}</div></body>"
    assert main_text(page.format(BODY)) == f"The bridge {TEXT}"
    # The site's name is in the page's header; of two headings neither is known to be the article's.
    assert main_text(f"<body><header><h1>Site</h1></header><div class=story>{BODY}</div></body>") == TEXT


def test_repeated_heads_cost_no_more_than_other_tags():
    began = time.process_time()
    assert main_text("<head><div>" * 100_000) == ""
    assert time.process_time() - began < 15
