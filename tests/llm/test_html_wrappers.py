"""Wrappers that look like boilerplate around whole articles."""

import pytest

from lossledger.llm import html_content

LONG = "The river rose in the night and the people of the village left their houses before morning came."
ARTICLE = f"<article><h1>Flood</h1><p>{LONG}</p></article>"
WRAPPERS = [
    "<form id=aspnetForm>{}</form>", "<div class='content-sidebar-wrap'>{}</div>", "<div class=has-sidebar>{}</div>",
    "<div id='search-results'>{}</div>", "<div class='widget-area'><div class=no-sidebar>{}</div></div>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_wrapped_content_comes_out(wrapper):
    nav = "<nav><a href=/>Home</a></nav>"
    assert html_content.main_text(f"<body>{wrapper.format(nav + ARTICLE)}</body>", {}) == f"Flood\n{LONG}"
    inner = f"<main>{wrapper.format(ARTICLE)}</main>"
    assert html_content.main_text(inner, {}) == f"Flood\n{LONG}"
    plain = f"<body>{wrapper.format(nav + f'<p>{LONG}<p>Short one.<p>{LONG}')}</body>"
    assert html_content.main_text(plain, {}) == f"{LONG}\nShort one.\n{LONG}"


def test_articles_in_comments_and_short_boxes_stay_out():
    shut = "".join(f"<{e}><article>{LONG}</article></{e.split()[0]}>" for e in ("nav", "footer", "div class=comments"))
    assert html_content.main_text(shut + ARTICLE, {}) == f"Flood\n{LONG}"
    assert html_content.main_text(f"<div class=sidebar>Popular now</div><p>{LONG}</p><form>Mail us</form>", {}) == LONG
    cut = f"<main><p>{LONG}</p><aside><article>See this too</article></aside><div class=ad>Buy {LONG}</div></main>"
    assert html_content.main_text(cut, {}) == LONG
