"""Attributes, slashes and classes as browsers read them, and pages that are open to the end."""

import time

import pytest

from lossledger.llm import html_content

LONG = "The river rose in the night and the people of the village left their houses before morning came."


@pytest.mark.parametrize("page, text", [
    (f"<article><p title=it's>{LONG}</p><p>It's over.</p></article>", f"{LONG}\nIt's over."),
    (f'<article><p title=5">{LONG}</p><p>A 5" pipe</p></article>', f'{LONG}\nA 5" pipe'),
    (f"<article><p>{LONG}</p></article><form action=/search/>Search this site<input></form>", LONG),
    (f"<article><p>{LONG}</p><script src=x />var a = 'code';</script></article>", LONG),
    (f"<article><p class = 'a>b' data-x='\"'>{LONG}</p></article>", LONG),
    (f"<article><p a=\"x > y\" b>{LONG}</p><img src=a/><br/>More.</article>", f"{LONG}\nMore."),
    (f"<div class='post comments-open'><article><p>{LONG}</p></article></div>", LONG),
    (f"<div class='has-comments'><p>{LONG}</p></div>", LONG),
    (f"<div class='respond'><article><p>{LONG}</p></article></div>", LONG),
    (f"<article><p>{LONG}</p></article><div class='comment-list'><article>Nice one</article></div>", LONG),
    (f"<article><p>{LONG}</p><svg/><p>After.</p><svg><text>No</text></svg></article>", f"{LONG}\nAfter."),
    (f"<article><p>{LONG}</p><div/>Inside.</article>", f"{LONG}\nInside."),
    ("<p title=\"never closed <p>text", ""), ("<", "<"), ("a < b", "a < b"), ("</>", "</>"), ("<p =x>y</p>", "y"),
])
def test_pages_as_browsers_read_them(page, text):
    assert html_content.main_text(page, {}) == text


@pytest.mark.parametrize("unit", ["<b></i>", "<b>", "<div>x", "<p>x", "<li>x", "<p a=", "<p a", "<a b='", "</p>", "<!--", "<script>", "<i></b><td>", "x<", "&amp;"])
def test_any_page_takes_linear_time(unit):
    page = unit * (1_000_000 // len(unit))
    started = time.process_time()
    html_content.main_text(page, {})
    assert time.process_time() - started < 20
