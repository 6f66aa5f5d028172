from __future__ import annotations

import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scdstar.llm import languages

from awkward import awkward, docs, none  # noqa: F401

TEXT = st.text(st.sampled_from(list("abAÉé1 .-\n日本ßéำİ🙂")), max_size=40)
ENGLISH = "the house and the garden with the three old trees are there "
GERMAN = "das haus und der garten mit den drei alten bäumen sind dort "


def words(text):
    word, out = "", []
    for c in unicodedata.normalize("NFC", text or "") + " ":
        if unicodedata.category(c)[0] in "LM":
            word += c.lower() if len(c.lower()) == 1 and unicodedata.category(c)[0] == "L" else c
        elif word:
            out.append(word)
            word = ""
    return out


def brute_ngrams(text):
    found = Counter()
    if not any(unicodedata.category(c)[0] == "L" for c in unicodedata.normalize("NFC", text or "")):
        return found
    for word in words(text):
        padded = f" {word} "
        found.update(word)
        found.update(padded[k : k + 2] for k in range(len(padded) - 1))
        found.update(padded[k : k + 3] for k in range(len(padded) - 2))
    return found


def number(gram):
    codes = [0 if c == " " else ord(c) for c in gram]
    if len(codes) == 1:
        return codes[0]
    if len(codes) == 2:
        return (1 << 61) + (codes[0] << 21) + codes[1]
    return (1 << 62) + (codes[0] << 42) + (codes[1] << 21) + codes[2]


def brute(rows, known):
    counts = {}
    for _, text, lang in known:
        counts.setdefault(lang, Counter()).update(brute_ngrams(text))
    profiles = {
        lang: {g: r for r, g in enumerate(sorted(c, key=lambda g: (-c[g], number(g)))[:300])}
        for lang, c in counts.items() if c
    }
    out = []
    for i, text in rows:
        own = brute_ngrams(text)
        top = sorted(own, key=lambda g: (-own[g], number(g)))[:300]
        if not top or not profiles:
            out.append((i, "und", 0.0))
            continue
        mean = {n: np.mean([k for k, g in enumerate(top) if own[g] == n]) for n in set(own[g] for g in top)}
        apart = sorted(
            (float(sum(abs(p[g] - mean[own[g]]) if g in p else 300 for g in top)), lang)
            for lang, p in profiles.items()
        )
        most = apart[1][0] if len(apart) > 1 else 300.0 * len(top)
        out.append((i, apart[0][1], 1.0 - apart[0][0] / most if most else 0.0))
    return sorted(out, key=repr)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_ngrams_are_those_of_each_word(text):
    found = Counter(languages.ngrams(text).tolist())
    assert found == {number(g): n for g, n in brute_ngrams(text).items()}


def found(documents, known):
    return sorted(map(tuple, languages.predict(documents, known).collect()), key=repr)


KNOWN = "doc_id bigint, text string, lang string, n int"


@pytest.mark.parametrize("langs", [("en", "de"), ("en",), ()])
def test_awkward_rows(spark, docs, none, langs):
    known = [(k, t * 3, lang) for k, (t, lang) in enumerate([(ENGLISH, "en"), (GERMAN, "de"), (GERMAN, "de")])
             if lang in langs]
    extra = [(None, "nichts", "xx", 1), (9, None, "xx", 1), (10, "no language", None, 1), (11, "12 34 !", "xx", 1)]
    labelled = spark.createDataFrame([(*r, 1) for r in known] + extra, KNOWN)
    assert found(docs, labelled) == brute(awkward(), known)
    assert found(none, labelled) == []
    told = {r[0]: r[1] for r in brute([(1, "the old tree"), (2, "der alte baum"), (3, "42")], known)}
    if len(langs) == 2:
        assert told == {1: "en", 2: "de", 3: "und"}


def test_ties_go_to_the_first_language_with_score_0(spark):
    known = spark.createDataFrame([(1, "ab ab", "zz", 1), (2, "ab ab", "aa", 1)], KNOWN)
    rows = spark.createDataFrame([(1, "ab"), (2, "日本")], "doc_id bigint, text string")
    assert found(rows, known) == [(1, "aa", 0.0), (2, "aa", 0.0)]


def test_a_bounded_sample_teaches_as_well(spark, monkeypatch):
    monkeypatch.setattr(languages, "LABELLED", 40)
    rows = [(k, (ENGLISH if k % 3 else GERMAN) + f"word{k}", "en" if k % 3 else "de", 1) for k in range(3000)]
    known = spark.createDataFrame(rows, KNOWN).repartition(5)
    profiles = languages.learn(known)
    assert {r.lang: r["count"] for r in profiles.groupBy("lang").count().collect()}.keys() == {"en", "de"}
    assert {r[1] for r in found(known.filter("lang = 'de'").select("doc_id", "text"), known)} == {"de"}


def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    told = languages.predict(documents, documents.filter(~held)).join(documents, "doc_id").filter(held)
    rows = told.select("doc_id", "lang", "lang_pred", "score").collect()
    assert rows and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
