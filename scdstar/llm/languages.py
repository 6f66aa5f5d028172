"""Language identification by rank-order profiles of character n-grams.

1. **N-grams.** A text is normalized to composed characters and lower-cased; words are runs of
   letters and marks, with a space on either side. One to three neighbouring characters are an
   n-gram, those that span two words excepted. An n-gram is one integer of 64 bits.
2. **Profiles.** N-grams are counted by language over the labelled texts; the ``RANKS`` most frequent,
   in order, are the language's profile. Learned from about ``LABELLED`` documents of each
   language, those of the least hash of the id: a documented bound.
3. **Distance.** A document's own ``RANKS`` most frequent n-grams, from the whole text, are compared with
   each profile: an n-gram is as far out of place as its two ranks differ, or ``RANKS`` if the
   profile lacks it. N-grams that are equally frequent in a document share their mean rank. The least
   sum wins, ties go to the language first in order.

``score`` is one less the least distance over the second least: 0 if two profiles are as near, 1 if one
matches fully. With a single profile it is one less the distance over the largest possible one.

Defined results: a null text or one without letters is ``und`` with score 0, and so is every text
if nothing was learned. Rows without language, id or letters teach nothing. Repeated rows are
predicted each, and count each when learned from. Further columns are ignored. The profiles are broadcast:
``RANKS`` numbers for each language. Memory is bounded by a batch of texts.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scdstar.llm.infill import groups
from scdstar.llm.shingles import arrow_batches
from scdstar.session import stage

#: N-grams of a profile, and of a document that are compared.
RANKS = 300
#: Bound on the documents of a language that its profile is learned from.
LABELLED = 5000
#: Values of the hash that the sample is taken by.
PLACES = 10**12

#: Bits of a character in an n-gram, and marks of n-grams of two and of three.
BITS = 21
TWO, THREE = np.int64(1) << 61, np.int64(1) << 62
#: Characters of the texts that are counted together while learning.
GROUP = 1 << 20
_LETTERS = "Lu Ll Lt Lm Lo".split()
_MARKS = "Mn Mc Me".split()


@cache
def characters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point what it counts as in n-grams (0: it ends a word), and whether it is a letter."""
    counts_as, letter = np.zeros(0x110000, np.int32), np.zeros(0x110000, bool)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind in _LETTERS:
            lower = chr(code).lower()
            counts_as[code], letter[code] = ord(lower) if len(lower) == 1 else code, True
        elif kind in _MARKS:
            counts_as[code] = code
    return counts_as, letter


def ngrams(text: str | None) -> np.ndarray:
    """All n-grams of a text, repeated as often as they occur; none without a letter."""
    text = text or ""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    counts_as, letter = characters()
    if not letter[codes].any():
        return np.empty(0, np.int64)
    found = np.zeros(len(codes) + 2, np.int64)
    found[1:-1] = counts_as[codes]
    inside = found != 0
    kept = inside.copy()
    kept[0] = True
    kept[1:] |= inside[:-1]  # one space after each word
    found = found[kept]
    one, two = found[found != 0], found[:-1] << BITS | found[1:]
    three = (two[:-1] << BITS | found[2:])[found[1:-1] != 0]
    return np.concatenate((one, two | TWO, three | THREE))


def counted(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order, and how often each occurs."""
    found = np.sort(found)
    first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else np.empty(0, int)
    return found[first], np.diff(np.append(first, len(found)))


def ranked(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``RANKS`` most frequent n-grams and the rank of each, from 0; equally frequent ones share
    the mean of theirs. Of those that are as frequent as the last, the smallest numbers stay."""
    grams, times = counted(found)
    order = np.lexsort((grams, -times))[:RANKS]
    grams, times = grams[order], times[order]
    first = np.concatenate(([True], times[1:] != times[:-1]))
    start = np.flatnonzero(first)
    mean = (start + np.append(start[1:], len(times)) - 1) / 2
    return grams, mean[np.cumsum(first) - 1]


class Profiles:
    """The ranks of n-grams in every language."""

    def __init__(self, rows: list[tuple[str, int, int]]) -> None:
        self.languages = sorted({lang for lang, _, _ in rows})
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        self.ranks = np.full((len(self.grams), len(self.languages)), -1, np.int64)
        column = {lang: k for k, lang in enumerate(self.languages)}
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), column[lang]] = rank

    def distances(self, found: np.ndarray) -> np.ndarray:
        """How far out of place the n-grams of a text are in each language."""
        grams, ranks = ranked(found)
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[at] == grams
        theirs = self.ranks[at[known]]
        apart = np.where(theirs < 0, RANKS, np.abs(theirs - ranks[known][:, None]))
        return apart.sum(0) + RANKS * float(len(grams) - known.sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        found = ngrams(text)
        if not len(found) or not self.languages:
            return "und", 0.0
        distances = self.distances(found)
        best = int(distances.argmin())
        if len(self.languages) == 1:
            most = float(RANKS * min(RANKS, len(np.unique(found))))
        else:
            most = float(np.delete(distances, best).min())
        return self.languages[best], 1.0 - float(distances[best]) / most if most else 0.0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for group in groups(texts, GROUP):
            parts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(langs[group], texts[group]):
                parts.setdefault(lang, []).append(ngrams(text))
            for lang, found in parts.items():
                grams, times = counted(np.concatenate(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(times)],
                    ["lang", "gram", "n"],
                )


def learn(known: DataFrame) -> DataFrame:
    """``lang``, ``gram`` and ``rank`` of the profiles, from ``known(doc_id, text, lang)``."""
    arrow_batches(known.sparkSession)
    known = known.select("lang", "doc_id", "text").filter(
        "lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL"
    )
    # Hashes are even, so a share of them is about as large a share of the documents.
    shares = stage(
        known.groupBy("lang").count()
        .select("lang", (F.lit(LABELLED * PLACES) / F.col("count")).alias("share")),
        "language-shares",
    )
    place = F.pmod(F.xxhash64(F.lit("languages"), "doc_id"), F.lit(PLACES))
    chosen = known.join(shares, "lang").filter(place < F.col("share"))
    counts = (
        chosen.select("lang", "text").mapInArrow(_counts, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (
        counts.withColumn("rank", F.row_number().over(by_count) - 1).filter(F.col("rank") < RANKS)
        .select("lang", "gram", "rank")
    )


def _predicted(profiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.value.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([lang for lang, _ in found], pa.string()),
                 pa.array([score for _, score in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score``, one row per row of ``docs(doc_id, text)``; learned from
    ``known(doc_id, text, lang)``, which should hold those rows only that may be learned from."""
    spark = docs.sparkSession
    rows = [tuple(r) for r in learn(known).collect()]  # RANKS rows for each language
    profiles = spark.sparkContext.broadcast(Profiles(rows))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _predicted(profiles), "doc_id bigint, lang_pred string, score double"
    )
