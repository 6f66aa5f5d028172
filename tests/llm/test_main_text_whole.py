"""Main text stays whole: articles beside or inside other text, text around removed boilerplate, wrappers
with boilerplate's names."""

from __future__ import annotations

import pytest

from scdstar.llm.maintext import main_text


def words(n: int, letter: str) -> str:
    return " ".join([letter * 7] * (n // 8))


BODY = "".join(f"<p>{words(400, c)}</p>" for c in "abc")
TEXT = "\n".join(words(400, c) for c in "abc")
CARDS = "".join(f"<article class=card><h3>T{k}</h3><p>{words(100, 't')}</p></article>" for k in range(5))
LINKS = "<ul>" + "".join(f"<li><a href=x>link {k}</a></li>" for k in range(5)) + "</ul>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div id=content>{BODY}</div><div class=cards>{CARDS}</div>", TEXT),
        (f"<div id=content>{BODY}</div><section><article class=comment-body>{words(900, 'z')}</article></section>", TEXT),
        (f"<article class=post>{BODY}</article><div id=comments><article class=comment-body><p>{words(300, 'z')}</p></article></div>", TEXT),
        (f"<div id=content>{BODY}</div><aside><article>{words(900, 'z')}</article></aside>", TEXT),
        (f"<main>{BODY}<div class=related><article>{words(300, 'z')}</article></div><p>End.</p></main><p>out</p>", f"{TEXT}\nEnd."),
        (f"<nav>open<article>{BODY}</article>", TEXT),
        (f"<div><article>{BODY}</article><article>Brief.</article></div>", f"{TEXT}\nBrief."),
    ],
)
def test_articles_are_judged_and_take_nothing_from_others(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div id=content>{BODY}<div class=ad>Buy</div><p>{words(200, 'd')}</p></div>", f"{TEXT}\n{words(200, 'd')}"),
        (f"<body>{BODY}<form>Ask<input></form><p>Short.</p></body>", f"{TEXT}\nShort."),
        (f"<div id=content><p>Lead.</p>{LINKS}{BODY}{LINKS}<ul><li>a<li>b</ul></div>", f"Lead.\n{TEXT}\na\nb"),
        (f"<div id=content>{BODY}<nav>{LINKS}</nav><section><h2>End</h2><p>{words(200, 'd')}</p></section></div>"
         f"<footer>f</footer><div>{words(60, 'x')}</div>", f"{TEXT}\nEnd\n{words(200, 'd')}"),
        (f"<div id=content>{BODY}{CARDS}</div>", TEXT),
    ],
)
def test_what_shares_the_container_stays(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "wrapper",
    [
        "<div id=page class='layout with-sidebar'>", "<div class='no-sidebar'>", "<div class='post share-enabled'>",
        "<div class='search-results'>", "<form id=aspnetForm><input type=hidden><input name=q>",
        "<div class='layout sidebar'>", "<div style='display:none'>",
    ],
)
def test_wrappers_keep_the_body_but_not_what_is_in_them(wrapper):
    inside = f"<nav>Menu</nav>{BODY}<div class=comments><p>{words(2000, 'z')}</p></div><div class=sidebar>{words(100, 's')}</div>"
    assert main_text(f"<body>{wrapper}{inside}</body>") == TEXT


def test_named_parts_go_unless_nothing_else_is_left():
    form = f"<form><label>Name</label><input><label>Mail</label><input>{words(200, 'f')}</form>"
    assert main_text(f"<div>{BODY}</div>{form}") == TEXT
    assert main_text(f"<article>Brief.</article><div class=newsletter>{words(200, 'n')}</div>") == "Brief."
    assert main_text(f"<h1>T</h1><p>Brief.</p><div id=comments>{words(900, 'z')}</div>") == "T\nBrief."
    posts = [words(300, c) for c in "abcd"]
    assert main_text("<h1>Blog</h1>" + "".join(f"<div class='post share'>{p}</div>" for p in posts)) == "\n".join(["Blog", *posts])
    assert main_text(f"<div class=cookie-text>{words(50, 'c')}</div>") == words(50, "c")
    assert main_text("<nav>Menu</nav>") == ""


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>If <math><mi>a</mi><mo>=</mo><mi>b</mi></math> then.</p></article>", "If a=b then."),
        ("<article><p>If <math><semantics><mi>a</mi><annotation encoding=tex>\\a</annotation></semantics></math>.</p></article>", "If a."),
        (f"<article>{BODY}<p class='mt-2 hidden md:block'>Shown.</p></article>", f"{TEXT}\nShown."),
        (f"<article>{BODY}<p hidden>no</p><p style='color:red; display:none'>no</p><p>End.</p></article>", f"{TEXT}\nEnd."),
        (f"<article>{BODY}<section id='discussion'><h2>Discussion</h2><p>{words(200, 'd')}</p></section></article>", f"{TEXT}\nDiscussion\n{words(200, 'd')}"),
        (f"<article>{BODY}<section id='related-work'><h2>Related work</h2><p>{words(200, 'd')}</p></section></article>", f"{TEXT}\nRelated work\n{words(200, 'd')}"),
        (f"<article>{BODY}<section class='related'><a href=x>{words(200, 'd')}</a></section></article>", TEXT),
        (f"<article>{BODY}</article><section class='discussion'><p>{words(200, 'd')}</p></section>", TEXT),
        (f"<div id=content>{BODY}<p><a href=x>Read the whole report</a></p></div>", f"{TEXT}\nRead the whole report"),
        (f"<article>{BODY}</article><ol class='user-responses'><li>{words(300, 'z')}</li></ol>", TEXT),
        (f"<article>{BODY}<div class='reader-feedback'><p>{words(300, 'z')}</p></div></article>", TEXT),
        (f"<article>{BODY}<section class='reviews'><p>{words(300, 'z')}</p></section></article>", TEXT),
        (f"<article>{BODY}<div class='alert'>We use cookies.</div><p>End.</p></article>", f"{TEXT}\nEnd."),
    ],
)
def test_formulas_hidden_parts_sections_and_comments(page, text):
    assert main_text(page) == text


def test_unclosed_markup_of_great_length():
    assert main_text("<article><p>yes</p>" + "<p title='" + "x" * 2_000_000).startswith("yes")
    assert main_text("<article><p>yes</p><div " + "a=1 " * 300_000).startswith("yes")
    assert main_text("<article><p " + "class='a' " * 200_000 + ">yes</p></article>") == "yes"
