"""Markup that the tables do not have."""

import pytest

from keptvisit.llm import pages

LINE = "the story of the town is in the news of the day and it was on the road "
GOOD, MORE = (LINE * 4).strip(), ("a " + LINE * 3).strip()


@pytest.mark.parametrize("html", [
    f"<article><a name=top><p>{GOOD}</p><p>{MORE}</p></article>",
    f"<article><p><a href=x>see<p>{GOOD}</p><p>{MORE}</p></article>".replace("see", ""),
    f"<body><form id=aspnet><input name=q><article><p>{GOOD}</p><p>{MORE}</p></article></form></body>",
    f"<form><div><p>{GOOD}</p><p>{MORE}</p></div><button>Send</button></form>",
    f"<nav><a href=/>Home</a> Menu<article><p>{GOOD}</p><p>{MORE}</p></article>",
    f"<div class=sidebar><p>Side</p><article><p>{GOOD}</p><p>{MORE}</p></article>",
    f'<article><p class="advert">{LINE}</p><p>{GOOD}</p><p hidden>{LINE}<p>{MORE}<span class="ad"> Buy <span>now</span> or</span></p></article>',
    f'<div class="comments-container"><p>{GOOD}</p></div><div class="main-menu"><p>{GOOD}</p></div><article><p>{GOOD}</p><p>{MORE}</p></article>',
    f'<div class="page has-sidebar"><article><p>{GOOD}</p><p>{MORE}</p><form><label>Name</label><p>{GOOD}</p></form></article></div>',
    f'<nav><article><p>{LINE}</p></article></nav><article><p>{GOOD}</p><p>{MORE}</p></article>',
])
def test_the_article_and_nothing_else(html):
    assert pages.main_text(html).split("\n") == [GOOD, MORE]


def test_nothing_of_an_article_is_lost():
    html = (f'<article><h1 class="social">Society</h1><p><a href="x">A whole paragraph that is a link</a></p>'
            f'<p>© words by a writer</p><p>{GOOD}</p><ul class="list"><li><a href=y>Next</a></li></ul></article>')
    assert pages.main_text(html).split("\n") == [
        "Society", "A whole paragraph that is a link", "© words by a writer", GOOD]


def test_a_small_form_is_no_text():
    html = f"<div><p>{GOOD}</p><form><p>Subscribe to the newsletter of the town</p><input></form><p>{MORE}</p></div>"
    assert pages.main_text(html).split("\n") == [GOOD, MORE]


def test_links_over_blocks_count():
    card = f'<div><a href="x"><div>{GOOD}</div></a></div>'
    assert pages.main_text(card + f"<div><p>{MORE}</p></div>") == MORE


def test_very_many_unclosed_elements():
    html = "<nav>" * 3000 + f"<article><p>{GOOD}</p></article>" * 50
    assert pages.main_text(html).split("\n") == [GOOD] * 50
