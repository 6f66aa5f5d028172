from __future__ import annotations

import numpy as np
import pytest

from scdstar.llm import toxicity
from scdstar.llm.maintext import extract, main_text

from awkward import awkward, docs, labels, none, sentence  # noqa: F401

LONG = "Some words that make a paragraph long enough to surge above the bound of the window, really."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("plain &amp; simple", "plain & simple"),
        (f"<nav>Menu</nav><article><h1>T</h1><p>a  <b>b</b>\n c<p>{LONG}</article><footer>f</footer>", f"T\na b c\n{LONG}"),
        (f"<article><p>{LONG}</p><div class='ad'>Buy</div><p>Of.</p></article><p>outside</p>", f"{LONG}\nOf."),
        (f"<div class='top-nav'><a href=x>Home</a></div><p>{LONG}</p><p>End.</p><div id=comments><p>{LONG}</p></div>", f"{LONG}\nEnd."),
        ("<script>var a='</p>';if(a<b){}</script><style>p{}</style><article><p>x &lt;b&gt; &#233;&eacute;</p>", "x <b> éé"),
        ("<article><!-- <p>no</p> --><p>yes</p><!-- open <p>no</p>", "yes"),
        ("<article><p>one<br>two</p><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "one two\na\nb\nc\nd"),
        ("<article><p title='a>b'>q</p><form><p>ask</p></form><aside>no</aside><p>r</p>", "q\nr"),
        ("<div class=cookie-banner><article><p>still the article</p></article></div>", "still the article"),
        ("<article><p>a</p></section></div><p>b</p></article>", "a\nb"),
        (f"<ul><li><a href=1>{LONG}</a></li></ul><p>{LONG}</p>", LONG),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_long_and_deep_pages():
    many = "".join(f"<p>{LONG} {k}</p>" for k in range(20_000))
    assert main_text(f"<article>{many}</article>").count("\n") == 19_999
    assert main_text("<b>" * 50_000 + "x") == "x"


def test_rows_of_pages(spark):
    rows = [(1, "u", "<article><p>a</p></article>", "t"), (1, None, None, "t"), (None, "u", "<p>é🙂</p>", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = sorted(map(tuple, extract(pages).collect()), key=repr)
    assert found == sorted([(1, "u", "a", 1), (1, None, "", 0), (None, "u", "é🙂", 2)], key=repr)
    assert extract(pages.limit(0)).count() == 0


def test_features_see_through_disguise():
    codes = toxicity.Codes(frozenset({"moron", "vequ*"}), frozenset({"weak"}))

    def of(text):
        return dict(zip(toxicity.NAMES, toxicity.features_of(text, codes)))

    assert set(of(None).values()) == set(of(" \n").values()) == {0.0}
    assert of("a moron here.")["strong_hits"] == of("a MORON, here")["strong_hits"] == 1
    assert of("vequsse vequ")["strong_hits"] == 2 and of("weak word")["weak_hits"] == 1
    for disguised in ("m0r0n", "mooooron", "m o r o n x"):
        assert of(f"one {disguised} two")["strong_hits"] + of(f"one {disguised} two")["undone_hits"] >= 1
    assert of("you are a moron")["near_second_person"] == 0.25
    assert of("you see that there is here a moron")["near_second_person"] == 0


def test_held_out_texts_are_told_apart(spark):
    texts = [
        (k, sentence(k, 40 + k % 50) + (" you grumblefoot zz and blurbing" if k % 5 == 0 else "") + f" {k}")
        for k in range(1500)
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    known = [(k, 1, int(k % 5 == 0)) for k in range(0, 1500) if k % 3]
    found = toxicity.score(docs, labels(spark, known)).select("doc_id", "score").collect()
    assert len(found) == 1500 and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.doc_id % 3 == 0]
    right = np.mean([(r.score >= 0.3) == (r.doc_id % 5 == 0) for r in held])
    assert right > 0.97


def test_awkward_rows_without_or_with_few_labels(spark, docs, none):
    for known, value in (([], 0.5), ([(1, 1, 0), (2, 1, 0)], 0.2), ([(1, 0, 1), (None, 0, 1), (3, 0, None)], 2 / 3)):
        found = toxicity.score(docs, labels(spark, known)).collect()
        assert len(found) == len(awkward()) and {r.score for r in found} == {value}
    assert toxicity.score(none, labels(spark)).count() == 0
