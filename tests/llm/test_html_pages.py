"""Pages without article: hyphenated names, long lines of other containers, a page inside a form."""

import pytest

from keelson.llm.html_text import main_text

BODY = [f"Paragraph {i} tells at some length what happened on the {i}th day of the journey, and why it mattered to all." for i in range(1, 8)]
TEXT = " ".join(BODY)
INNER = "".join(f"<p>{p}</p>" for p in BODY)
LONG = "This is a long line that is no part of the text, which a reader would skip without a second look at it, as all do."


def page(inner, before="", after=""):
    return f"<html><body>{before}<div class='story'>{inner}</div>{after}</body></html>"


@pytest.mark.parametrize("furniture", [
    f"<div class='cookie-banner'><p>{LONG}</p></div>",
    f"<div class='comment-list'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>",
    f"<div id='site_footer'><p>{LONG}</p></div>",
    f"<div class='x'><p>{LONG}</p></div>",
])
def test_furniture_behind_the_text_goes(furniture):
    assert main_text(page(INNER, after=furniture)) == TEXT


def test_a_notice_before_the_text_goes():
    assert main_text(page(INNER, before=f"<div class='cookie-notice'><p>{LONG}</p></div>")) == TEXT


def test_a_page_inside_a_form_is_text_and_a_small_form_is_not():
    whole = f"<html><body><form action=/><div class='menu-bar'><a href=/>Home</a></div><div class='c'>{INNER}</div></form></body></html>"
    assert main_text(whole) == TEXT
    assert main_text(page(INNER, after="<form><p>Write to us by this form and we will answer you as soon as we can find the time.</p></form>")) == TEXT
    assert main_text(page(INNER.replace("</p><p>", f"</p><form><div>{LONG}</div></form><p>", 1))) == TEXT


def test_the_text_s_own_parts_stay():
    headed = page(f"<div class='post-header'><h1>A title of the story</h1></div>{INNER}")
    assert main_text(headed) == f"A title of the story {TEXT}"
    wrapped = page("".join(f"<div><p>{p}</p></div>" for p in BODY))
    assert main_text(wrapped) == TEXT
    halves = f"<html><body><div><p>{'</p><p>'.join(BODY[:4])}</p></div><div><p>{'</p><p>'.join(BODY[4:])}</p></div></body></html>"
    assert main_text(halves) == TEXT
    related = page(f"<section id='related-work'>{INNER}</section>")
    assert main_text(related) == TEXT


def test_names_in_parts_do_not_act_inside_an_article():
    assert main_text(f"<body><article><div class='share-price'>{INNER}</div><p>{LONG}</p></article></body>") == f"{TEXT} {LONG}"


def test_empty_and_very_long_pages():
    assert main_text("<form></form>") == main_text("<form><input></form>") == ""
    many = "".join(f"<p>{p}</p>" for p in BODY * 3000)
    assert main_text(page(many, after=f"<div class='site-footer'>{LONG}</div>")) == " ".join(BODY * 3000)
