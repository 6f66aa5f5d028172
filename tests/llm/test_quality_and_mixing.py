from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from scdstar.llm import mixing, quality
from scdstar.llm.quality import apply_rules, base_statistics, judge

from awkward import awkward, docs, labels, none, sentence  # noqa: F401


def brute(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@pytest.mark.parametrize("bits", [24, 4])
def test_base_statistics_by_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(quality, "POSITION_BITS", bits)  # 4: every text is too long to pack
    texts = [t for _, t in awkward()] + ["a b c a b c a b c", "x y z w x y z", "l1\nl1\n \n \nl2", "a|b <c> #$%"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    found = {r.k: tuple(r[n] for n in NAMES) for r in base_statistics(rows, "k").collect()}
    assert found == {k: brute(t) for k, t in enumerate(texts)}


def planted(n: int = 240):
    """Bad texts have symbols after words, good ones have not."""
    rows = [(k, " ".join(w + ("###" if k % 4 == 0 else "") for w in sentence(k, 60 + k).split())) for k in range(n)]
    return rows, [(k, int(k % 4 != 0), 0) for k in range(0, n, 2)]


def test_rules_find_what_is_planted_and_keep_the_rest(spark):
    rows, known = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    judged, rules = judge(docs, labels(spark, known))
    assert rules and all(rule for rule in rules)
    kept = {r.doc_id for r in judged.filter("kept").collect()}
    passed = {r.doc_id for r in judged.filter("NOT base_failed").collect()}
    assert kept >= {k for k in passed if k % 4} and len(kept) > 100
    assert len([k for k in kept if k % 4 == 0]) <= 3
    assert {r.doc_id for r in apply_rules(docs, rules).collect()} == kept


def test_awkward_rows_and_missing_labels(spark, docs, none):
    for known in ([], [(1, 1, 0)], [(None, 0, 0), (2, None, 1)]):
        judged, rules = judge(docs, labels(spark, known))
        assert rules == [] and judged.count() == len(awkward())
        assert judged.filter("kept = base_failed").count() == 0
        kept = apply_rules(docs, rules)
        assert kept.columns == docs.columns and kept.count() == judged.filter("kept").count()
    judged, rules = judge(none, labels(spark))
    assert judged.count() == 0 and apply_rules(none, rules).count() == 0


def test_rates_meet_the_targets_and_copies_follow_them(spark):
    rows, known = planted(400)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    mixed = mixing.mix(docs, labels(spark, known), {"good": 0.9, "poor": 0.1}).collect()
    tokens = [sum(r.rate * r.n_tokens * r.p[k] for r in mixed) for k in (0, 1)]
    assert tokens[0] / sum(tokens) == pytest.approx(0.9, abs=0.002)
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in mixed)
    assert all(sum(r.p) == pytest.approx(1) for r in mixed)
    good = [r for r in mixed if r.doc_id % 4]
    assert min(r.p[0] for r in good) > 0.8 > 0.2 > max(r.p[0] for r in mixed if r.doc_id % 4 == 0)
    taken = mixing.take(docs, labels(spark, known), {"good": 0.9, "poor": 0.1})
    assert Counter(r.doc_id for r in taken.collect()) == {r.doc_id: r.copies for r in mixed if r.copies}


def test_mixing_of_awkward_rows(spark, docs, none):
    mixed = mixing.mix(docs, labels(spark, [(1, 1, 0), (3, 0, 0), (3, 1, 1), (8, 0, 0)]))
    rows = mixed.collect()
    assert len(rows) == len(awkward())
    assert {r.rate for r in rows if r.n_tokens == 0} == {1.0}
    assert mixing.take(docs, labels(spark)).columns == docs.columns
    assert mixing.mix(none, labels(spark)).count() == 0
    assert mixing.take(none, labels(spark)).count() == 0


@pytest.mark.parametrize("weights", [[0.6, 0.4], [0.02, 0.98], [0.5, 0.2, 0.3], [0.9, 0.05, 0.05]])
def test_rates_reach_the_least_squares_of_brute_force(spark, weights):
    """Projected gradient of numpy on the same problem, run until nothing moves; the optimum is unique
    in the domains' tokens, not in the rates."""
    random = np.random.default_rng(len(weights))
    size = len(weights)
    tokens = random.integers(0, 300, 60)
    posterior = random.dirichlet(np.full(size, 0.3 if size == 3 else 5.0), 60)  # 5: no rates meet 2 %
    rows = [(k, int(t), [float(x) for x in p]) for k, (t, p) in enumerate(zip(tokens, posterior))]
    scored = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, p array<double>")
    rated, off = mixing.fit_rates(scored, weights, 0)
    total = (tokens * posterior[:, 0]).sum() / weights[0]
    matrix = (posterior * tokens[:, None]).T / total / np.array(weights)[:, None]
    scale = np.sqrt(weights)[:, None]
    a, goal = matrix * scale, np.ones(size) * scale[:, 0]
    rate, step = np.ones(60), 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(200_000):
        rate = np.maximum(0, rate - step * a.T @ (a @ rate - goal))
    best = matrix @ rate - 1
    found = {r.doc_id: r for r in rated.collect()}
    assert all(r.rate >= 0 and (r.n_tokens or r.rate == 1) for r in found.values())
    mine = matrix @ np.array([found[k].rate for k in range(60)]) - 1
    assert mine == pytest.approx(off, abs=1e-9)
    assert mine == pytest.approx(best, abs=4e-3)
    far = max(map(abs, best)) > 0.01
    assert far == (max(map(abs, off)) > 0.009) and (far or max(map(abs, off)) <= 1e-3)


def test_posteriors_by_brute_force(spark):
    """Levels and tables of a model counted in Python; tokens are words, not pieces."""
    rows, known = planted(200)
    rows += [(1000, "  "), (1001, "a  b"), (1002, "a\tb c"), (1003, None), (1004, "#" * 9 + " x x x x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    domains = ["good", "poor"]
    labelled = mixing.domain_labels(labels(spark, known))
    lexicons, priors, tables = mixing.train(docs, labelled, domains)
    domain = {r.doc_id: r.domain for r in labelled.collect()}
    scored = {r.doc_id: r for r in mixing.posteriors(docs, (lexicons, priors, tables)).collect()}
    assert [scored[k].n_tokens for k in range(1000, 1005)] == [0, 2, 3, 0, 5]
    assert len(lexicons) == 1 and 0 < len(lexicons[0]) <= mixing.LEXICON
    split = {k: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for k, t in rows}
    levels = {
        k: (min(mixing.MOST_HITS, len(set(split[k]) & set(lexicons[0]))),
            sum(len(re.findall(r"[#*$%&|!<>]", t or "")) / max(1, len(t or "")) >= b for b in mixing.SYMBOL_LEVELS))
        for k, t in rows
    }
    for at, d in enumerate(domains):
        mine = [k for k, _ in rows if domain.get(k) == d]
        for j, table in enumerate(tables[at]):
            seen = Counter(levels[k][j] for k in mine)
            assert table == pytest.approx(
                [math.log((seen[v] + 0.5) / (len(mine) + 0.5 * len(table))) for v in range(len(table))])
    for k, r in scored.items():
        score = [math.exp(priors[d] + sum(tables[d][j][v] for j, v in enumerate(levels[k]))) for d in (0, 1)]
        assert list(r.p) == pytest.approx([x / sum(score) for x in score], abs=1e-9)


def test_missed_targets_are_reported(spark):
    rows, known = planted(200)
    docs = spark.createDataFrame([r for r in rows if r[0] % 4], "doc_id bigint, text string")
    with pytest.warns(UserWarning, match="poor"):  # there are no poor documents to repeat
        mixed = mixing.mix(docs, labels(spark, known), {"good": 0.5, "poor": 0.5})
    assert mixed.count() == docs.count()
    _, off = mixing.solve(docs, labels(spark, known), {"good": 0.5, "poor": 0.5})
    assert off["poor"] < -0.01
    scored = spark.createDataFrame([(1, 9, [0.5, 0.5]), (2, 9, [0.9, 0.1])], "doc_id bigint, n_tokens bigint, p array<double>")
    with pytest.raises(ArithmeticError):
        mixing.fit_rates(scored, [0.75, 0.25], 0, rounds=1)
