from __future__ import annotations

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scdstar.llm import infill
from scdstar.llm.wavelet import WaveletMatrix

from awkward import awkward, docs, none  # noqa: F401

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXT = st.text(st.sampled_from(list("ab1. \t\n\r\x0b\x0c\x1c\xa0é日🙂")), max_size=30)
SENTINELS = ["a <P> b c d", "<S>", "x <M", "<M> y", "a<P b<S c<M d e f g", "> <P"]


@given(st.lists(st.integers(0, 15), max_size=400), st.data())
def test_ranks_are_counts(symbols, data):
    matrix = WaveletMatrix(np.array(symbols, np.uint8), 4)
    ends = np.array(data.draw(st.lists(st.integers(0, len(symbols)), min_size=1)), np.int64)
    for symbol in (0, 5, 8, 15):
        assert matrix.rank(symbol, ends).tolist() == [symbols[:e].count(symbol) for e in ends]
    pair = (3, 9)
    total = sum(s in pair for s in symbols)
    for times in range(1, total + 1):
        found = matrix.locate(pair, np.array([times]), np.array([0]), np.array([len(symbols) + 1]))
        expected = next(e for e in range(len(symbols) + 1) if sum(s in pair for s in symbols[:e]) >= times)
        assert found.tolist() == [expected]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TEXT, st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1)), min_size=1, max_size=6))
def test_cuts_are_those_of_listed_units(rows):
    texts, first, second = (list(x) for x in zip(*rows))
    found = infill.cuts(texts, np.array(first, np.int64), np.array(second, np.int64)).T.tolist()
    for (text, a, b), (n, prefix, end) in zip(rows, found):
        units = UNIT.findall(text)
        a, b = sorted((a % (len(units) + 1), b % (len(units) + 1)))
        assert (n, prefix, end) == (len(units), len("".join(units[:a])), len("".join(units[:b])))


def test_last_text_that_is_cut_at_its_end():
    # 63 characters in all: a place one beyond them lies in a word that a bit vector of 63 does not have.
    for size in range(60, 68):
        texts = ["a b " * ((size - 3) // 4) + "c" * ((size - 3) % 4), "d e"]
        assert sum(map(len, texts)) == size
        found = infill.cuts(texts, np.array([3, 1]), np.array([5, 2])).T.tolist()
        for text, a, b, row in zip(texts, (3, 1), (5, 2), found):
            units = UNIT.findall(text)
            assert row == [len(units), len("".join(units[:a])), len("".join(units[:b]))]


def test_groups_hold_every_text_once():
    texts = ["a" * k for k in (0, 3, 9, 1, 1, 0, 30, 2)]
    parts = list(infill.groups(texts, 10))
    assert [t for g in parts for t in texts[g]] == texts
    assert all(sum(map(len, texts[g])) <= 10 or g.stop - g.start == 1 for g in parts)
    assert list(infill.groups([], 10)) == []


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_awkward_rows_and_sentinels(spark, docs, none):
    made = infill.transform(docs)
    assert sorted(map(tuple, made.collect()), key=repr) == sorted((brute(i, t) for i, t in awkward()), key=repr)
    texts = [(100 * k + j, t) for k, t in enumerate(SENTINELS) for j in range(12)]
    rows = spark.createDataFrame(texts, "doc_id bigint, text string")
    back = infill.transform(rows).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    found = back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back").collect()
    wanted = dict(texts)
    assert {r.form for r in found} == {"plain", "spm", "psm"}
    for r in found:
        assert tuple(r)[:-1] == brute(r.doc_id, wanted[r.doc_id]) and r.back == wanted[r.doc_id]
    assert infill.transform(none).count() == 0
