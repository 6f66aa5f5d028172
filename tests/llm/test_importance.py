from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from scdstar.llm import importance

from awkward import awkward, docs, none, sentence  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXT = st.text(st.sampled_from(list("abZ09 .\n\t-_é日🙂\x00\x7f")), max_size=60)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_buckets(text):
    words = WORD.findall((text or "").translate(LOWER))
    found = Counter(
        zlib.crc32(" ".join(words[k : k + n]).encode()) % 10_000
        for n in (1, 2, 3) for k in range(len(words) - n + 1)
    )
    return len(words), found


@settings(max_examples=500, deadline=None)
@given(TEXT)
def test_overlapping_matches_are_all_ngrams(text):
    n, found = importance.buckets_of(text)
    assert (n, Counter(found.tolist())) == brute_buckets(text)


def brute(rows, targets, percent=5, least=20, seed=42):
    known = [brute_buckets(t) for _, t in rows]
    s, t = sum((c for _, c in known), Counter()), sum((brute_buckets(x)[1] for x in targets), Counter())
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10_000.0) / ((s[b] + 1.0) * (all_t + 10_000.0))))
        for b in range(10_000)
    ]
    out = []
    for (i, _), (n, found) in zip(rows, known):
        weight = sum(gain[b] * k for b, k in found.items())
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, sum(found.values()), weight, weight + noise, None])
    enough = sorted(
        (r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2])
    )
    for k, r in enumerate(enough[: len(enough) * percent // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=repr)


def found(*args, **options):
    return sorted(map(tuple, importance.resample(*args, **options).collect()), key=repr)


def test_awkward_rows(spark, docs, none):
    target = spark.createDataFrame([(t, 1) for t in ("beta0 gamma0", None, "", "the é 日本語")], "text string, n int")
    targets = ["beta0 gamma0", None, "", "the é 日本語"]
    for percent in (0, 5, 50, 100):
        assert found(docs, target, percent) == brute(awkward(), targets, percent)
    assert found(docs, target.limit(0), 30) == brute(awkward(), [], 30)
    assert found(docs, target, 100, least=0) == brute(awkward(), targets, 100, least=0)
    assert found(none, target) == []


def test_many_rows_and_one_id_that_holds_a_third(spark):
    rows = [(7 if k % 3 == 0 else k, sentence(k % 90, 15 + k % 20)) for k in range(900)]
    target = spark.createDataFrame([(sentence(5, 40),)], "text string")
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert found(documents, target, 40) == brute(rows, [sentence(5, 40)], 40)
    # What is drawn is nearer to the target than what is not.
    drawn = importance.resample(documents, target, 10)
    weights = {bool(r.drawn): r.w for r in drawn.groupBy(drawn["rank"].isNotNull().alias("drawn")).agg({"weight": "avg"}).toDF("drawn", "w").collect()}
    assert weights[True] > weights[False]
