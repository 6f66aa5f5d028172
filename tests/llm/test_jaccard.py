from __future__ import annotations

from collections import defaultdict
from random import Random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from scdstar.llm import contain
from scdstar.llm.contain import contained_items, decontaminate
from scdstar.llm.jaccard import jaccard_classes, keep_one, parts, parts_allow
from scdstar.llm.shingles import shingle_set

from awkward import awkward, docs, none, sentence  # noqa: F401


def grams(text: str | None, size: int) -> frozenset:
    words = (text or "").encode().lower().split()
    width = min(size, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else frozenset()


def brute(rows, size: int, percent: int) -> dict[int, int]:
    """The smallest id that links reach, by comparing all pairs."""
    sets = defaultdict(set)
    for i, t in rows:
        if i is not None:
            sets[i].add(grams(t, size))
    least = {i: i for i in sets}
    links = [
        (a, b) for a in sets for b in sets if a < b and any(
            100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b] if x and y
        )
    ]
    for _ in sets:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return least


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_awkward_rows_link_as_by_brute_force(docs, size, percent):
    expected = brute(awkward(), size, percent)
    found = jaccard_classes(docs, size, percent).collect()
    assert len(found) == len(awkward())
    assert {(r.doc_id, r.component_id) for r in found if r.doc_id is not None} == set(expected.items())
    assert {r.component_id for r in found if r.doc_id is None} == {None}
    assert {r.n_shingles for r in found if r.doc_id in (5, 6, 7)} == {0}


def test_chains_and_hubs_keep_every_link(spark):
    # Each text differs from the next by one word, and from those further off by more.
    words = sentence(1, 120).split()
    rows = [(i, " ".join(["new"] * 0 + words[:i] + [f"changed{i}"] + words[i + 1 :])) for i in range(100)]
    rows += [(1000 + i, " ".join([f"w{j}" if j > i else f"v{j}" for j in range(100)])) for i in range(60)]
    found = jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85)
    assert {r.doc_id: r.component_id for r in found.collect()} == brute(rows, 4, 85)


def test_keep_one_leaves_one_of_each_group_and_rows_without_id(docs):
    """Texts of one id that differ are documents of their own, and all of them stay."""
    kept = keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    # Brute force over texts: numbered by id, ids with several texts after the others.
    several = {i for i, _ in awkward() if len({t for j, t in awkward() if j == i}) > 1} - {None}
    texts = sorted({(i in several, i, t or "") for i, t in awkward() if i is not None})
    expected = {n for n, c in brute([(n, t) for n, (_, _, t) in enumerate(texts)], 5, 80).items() if n == c}
    found = [(r.doc_id, r.text or "") for r in kept.collect() if r.doc_id is not None]
    assert sorted(found) == sorted((texts[n][1], texts[n][2]) for n in expected)
    assert [i for i, _ in found].count(20) == 2
    assert kept.filter("doc_id IS NULL").count() == 2


def test_keep_one_does_not_depend_on_the_order_of_rows(spark):
    first, second, third = sentence(1, 90), sentence(2, 90), sentence(4, 90)
    rows = [(5, first), (5, second), (9, second + " end"), (7, third), (5, first)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id bigint, text string").repartition(3)
        found = sorted((r.doc_id, r.text) for r in keep_one(docs).collect())
        assert found == sorted([(5, first), (9, second + " end"), (7, third)])


def test_empty_table(none):
    assert jaccard_classes(none).count() == 0
    assert keep_one(none).count() == 0


@given(st.sets(st.integers(0, 400), min_size=1), st.sets(st.integers(0, 400), min_size=1))
def test_the_suffix_filter_drops_no_pair_that_links(a, b):
    x, y = (shingle_set(" ".join(f"w{k}" for k in sorted(s)), 1) for s in (a, b))
    both = len(a & b)
    if 100 * both >= 85 * len(a | b):
        assert parts_allow(parts(x).tobytes(), parts(y).tobytes(), len(a), len(b), 85)


def test_containment_by_brute_force(spark, docs):
    items = [
        (1, sentence(1, 40)), (2, sentence(3, 30)), (3, "one"), (4, None), (5, ""), (None, "one"),
        (6, sentence(6, 20) + " something else that is not there at all"), (7, sentence(6, 30) + " tail"),
        (8, sentence(8, 12)), (8, sentence(6, 12)),
    ]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = {
        (d, i) for d, t in awkward() for i, u in items
        if d is not None and i is not None and grams(u, 5)
        and 100 * len(grams(u, 5) & grams(t, 5)) >= 80 * len(grams(u, 5))
    }
    found = contained_items(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected)
    clean = decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    hit = {d for d, _ in expected}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(
        str(d) for d, _ in awkward() if d not in hit
    )


def test_containment_of_empty_tables(spark, docs, none):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    assert contained_items(none, items).count() == 0
    assert contained_items(docs, items.limit(0)).count() == 0


def test_short_items_are_found_inside_longer_documents(spark):
    texts = {1: "see The  quick\nFOX runs over twelve hills and many more of them", 2: "quick fox", 3: "fox quick runs",
             4: "the quick fox runs", 5: "thequick fox runs", 6: sentence(2, 400) + " fox", 7: None, 8: "fox"}
    items = {1: "the quick fox runs", 2: "quick fox", 3: "fox", 4: "quick fox runs over twelve", 5: "runs over many"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    benchmark = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    expected = {
        (d, i) for d, t in texts.items() for i, u in items.items()
        if f" {' '.join(u.lower().split())} " in f" {' '.join((t or '').lower().split())} "
    }
    for exact in (False, True):
        assert {(r.doc_id, r.item_id) for r in contained_items(docs, benchmark, exact=exact).collect()} == expected


def test_signatures_find_what_exact_search_finds_in_each_class(spark, monkeypatch):
    monkeypatch.setattr(contain, "CHUNK", 64)  # candidates of a document in several groups
    random = Random(5)
    words = [f"v{k}" for k in range(30_000)]
    items = [[random.choice(words) for _ in range(n)] for n in (6, 14, 25, 26, 40, 80, 300, 2000) for _ in range(6)]
    documents = []
    for length in (10, 100, 1000, 12_000):
        for item in items:
            kept = list(item)
            for _ in range(random.choice((0, 0, 1, len(item) // 30))):  # near the threshold, on either side
                kept[random.randrange(len(kept))] = "changed"
            at = random.randrange(length)
            filler = [random.choice(words) for _ in range(length)]
            documents.append(" ".join(filler[:at] + kept + filler[at:]))
    docs = spark.createDataFrame(list(enumerate(documents)), "doc_id bigint, text string").repartition(4)
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id bigint, text string")
    sets = [grams(" ".join(i), 5) for i in items]
    expected = set()
    for d, text in enumerate(documents):
        own = grams(text, 5)
        expected |= {(d, i, len(s), len(s & own)) for i, s in enumerate(sets) if 100 * len(s & own) >= 80 * len(s)}
    assert len(expected) > 100 and any(contain.needed(n, 80) for *_, n, _ in expected)
    for exact in (False, True):
        assert {tuple(r) for r in contained_items(docs, benchmark, exact=exact).collect()} == expected


def test_bins_that_items_need():
    assert contain.needed(10, 80) == 0 and contain.needed(1, 80) == 0  # searched exactly
    assert 1 <= contain.needed(30, 80) < contain.needed(100, 80) < contain.needed(1000, 80) < 1000
    grams_ = shingle_set(" ".join(f"u{k}" for k in range(500)), 1)
    first = contain.first_classes(grams_)
    for width in (32, 64, 1024, 1 << 20):
        assert set(contain.signature(grams_, width)) == set(grams_[first <= width])
