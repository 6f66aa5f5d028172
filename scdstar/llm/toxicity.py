"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Labelled documents are split by hash into three parts of different use, so that no step is
fitted on what an earlier one has seen:

1. **Lexicon.** Words and word beginnings are counted, by label, over the distinct words of each text;
   those far likelier in toxic texts make two lists, by strength. A short list of general insults
   is always strong. Beginnings catch inflected words of any language.
2. **Trees.** Dense features of each text, from one pass over its words: densities of
   both lists, also after undoing digits and marks for letters, repeated and spaced
   letters; hits near a second-person word; capitals, punctuation and obfuscation rates;
   length. ``GBTClassifier`` learns from them.
3. **Calibration.** ``IsotonicRegression`` maps what the trees say to frequencies.

Fitting takes at most ``LABELLED`` labelled documents (those of the least hash), a documented
bound; all documents are scored, over whole texts. Labels, language, source and id are no
features.

Defined results: a null or empty text has zero features and gets a score like any other. If
labels have one class only, or none, every score is the share of toxic labels, with one of
each added. Several labels of one document: the larger counts. Repeated rows are scored each.
A null ``doc_id`` is scored, and is not held out. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scdstar.llm.shingles import arrow_batches
from scdstar.session import stage

#: Bound on labelled documents that anything is fitted on.
LABELLED = 40_000
#: Lengths of word beginnings, most entries of a lexicon, toxic texts that an entry needs.
BEGINNINGS, ENTRIES, SUPPORT = (4, 5), 2000, 4
#: Log odds from which an entry is weak or strong.
WEAK, STRONG = 1.8, 3.2
#: Words between a hit and a second-person word that count as near.
NEAR = 4

# General insults, and second-person words of four languages.
INSULTS = "idiot moron stupid loser scum trash worthless pathetic disgusting imbecile dumb".split()
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner euch euer tu te toi ton ta tes vous"
    " votre vos ti tú tus usted ustedes vosotros".split()
)
# Signs that stand for letters.
LETTERS = str.maketrans("013457@$!|", "oieastasil")

NAMES = (
    "strong_density", "weak_density", "strong_hits", "weak_hits", "near_second_person",
    "second_person_density", "capital_words", "capital_letters", "punctuation", "exclamations",
    "obfuscated", "undone_hits", "mean_word", "log_words",
)
_EDGES = ".,;:!?\"'()[]{}<>#*$%&|-–—…«»“”¡¿"
_STRONG, _WEAK, _SECOND, _CAPITAL, _OBFUSCATED, _UNDONE, _SINGLE = (1 << k for k in range(7))
_REPEATED = re.compile(r"(.)\1{2,}")


def entries_of(text: str | None) -> set[str]:
    """The distinct words of a text, and their beginnings with a star."""
    out = set()
    for word in {w.strip(_EDGES) for w in (text or "").lower().split()}:
        if len(word) > 2:
            out.add(word)
            out.update(word[:k] + "*" for k in BEGINNINGS if len(word) >= k)
    return out


class Codes(dict):
    """What is known of a word as it stands in a text, as bits; bounded."""

    def __init__(self, strong: frozenset[str], weak: frozenset[str]) -> None:
        self.strong, self.weak = strong, weak

    def _listed(self, word: str) -> int:
        forms = [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) >= k)]
        if any(f in self.strong for f in forms):
            return _STRONG
        return _WEAK if any(f in self.weak for f in forms) else 0

    def __missing__(self, token: str) -> int:
        if len(self) > 400_000:
            self.clear()
        core = token.strip(_EDGES)
        word = core.lower()
        code = self._listed(word)
        if word in SECOND_PERSON:
            code |= _SECOND
        if len(core) > 1 and core.isupper():
            code |= _CAPITAL
        if len(word) == 1 and word.isalpha():
            code |= _SINGLE
        if word and not word.isalpha() and any(c.isalpha() for c in word):
            if re.search(r"[^\W\d_][\d@$!|*]+[^\W\d_]", token.lower()):
                code |= _OBFUSCATED
        if not code & _STRONG and word:
            undone = _REPEATED.sub(r"\1", token.lower().strip(".,;:?\"'()").translate(LETTERS))
            if undone != word and (hit := self._listed(undone.strip(_EDGES))):
                code |= hit | _UNDONE | _OBFUSCATED
        self[token] = code
        return code


@cache
def _codes(strong: frozenset[str], weak: frozenset[str]) -> Codes:
    return Codes(strong, weak)


def features_of(text: str | None, codes: Codes) -> list[float]:
    text = text or ""
    tokens = text.split()
    n = len(tokens)
    if not n:
        return [0.0] * len(NAMES)
    code = np.frombuffer(bytes(map(codes.__getitem__, tokens)), np.uint8)
    strong, weak, second = (code & b > 0 for b in (_STRONG, _WEAK, _SECOND))
    spaced = 0
    single = (code & _SINGLE > 0).astype(np.int8)
    if single.sum() >= 4:  # letters set apart, as in "s c u m"
        edges = np.flatnonzero(np.diff(np.concatenate(([0], single, [0]))))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= 4:
                word = "".join(t.strip(_EDGES) for t in tokens[a:b]).lower()
                spaced += any(e.rstrip("*") in word for e in codes.strong)
    hits = np.flatnonzero(strong | weak)
    near = 0
    if len(hits) and second.any():
        places = np.flatnonzero(second)
        k = np.searchsorted(places, hits)
        before = np.abs(hits - places[np.maximum(k - 1, 0)])
        after = np.abs(hits - places[np.minimum(k, len(places) - 1)])
        near = int((np.minimum(before, after) <= NEAR).sum())
    letters = max(len(text) - n + 1, 1)
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    marks = sum(map(text.count, ".,;:!?"))
    return [
        (strong.sum() + spaced) / n, weak.sum() / n, float(strong.sum() + spaced), float(weak.sum()),
        near / n, second.sum() / n, (code & _CAPITAL > 0).sum() / n, capitals / letters,
        marks / letters, (text.count("!") + text.count("?")) / n,
        ((code & _OBFUSCATED > 0).sum() + spaced) / n, float((code & _UNDONE > 0).sum() + spaced),
        letters / n, float(np.log1p(n)),
    ]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [list(entries_of(t)) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.list_(pa.string()))], ["toxic", "entries"]
        )


def learn_lexicon(known: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """Strong and weak entries from ``known(toxic, text)``."""
    sizes = known.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).first()
    a, b = int(sizes["a"] or 0), int(sizes["b"] or 0)
    strong, weak = set(INSULTS), set()
    if a and b:
        odds = (
            known.select("toxic", "text").mapInArrow(_entries, "toxic int, entries array<string>")
            .select("toxic", F.explode("entries").alias("entry"))
            .groupBy("entry").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
            .filter(f"a >= {SUPPORT}")
            .withColumn("odds", F.log((F.col("a") + 0.5) / (a + 1.0))
                        - F.log((F.col("n") - F.col("a") + 0.5) / (b + 1.0)))
            .filter(f"odds >= {WEAK}").orderBy(F.desc(F.col("odds") * F.sqrt("a")), "entry")
            .limit(ENTRIES).select("entry", "odds").collect()
        )
        for entry, value in odds:
            (strong if value >= STRONG else weak).add(entry)
    return frozenset(strong), frozenset(weak - strong)


def _dense(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _codes(*lexicon.value)
        for batch in batches:
            rows = [features_of(t, codes) for t in batch.column(1).to_pylist()]
            columns = np.array(rows, np.float64).reshape(len(rows), len(NAMES)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns)], ["doc_id", *NAMES]
            )

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``score`` and the features, one row per row of ``docs(doc_id, text)``.
    ``labels(doc_id, toxic)`` should hold those rows only that may be learned from."""
    spark = docs.sparkSession
    arrow_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("u", F.xxhash64(F.lit("toxicity"), "doc_id")).orderBy("u", "doc_id").limit(LABELLED)
    )
    chosen = stage(
        chosen.withColumn("use", F.when(F.pmod("u", F.lit(20)) < 9, "lexicon")
                          .when(F.pmod("u", F.lit(20)) < 16, "trees").otherwise("calibration")).drop("u"),
        "toxicity-labels",
    )
    lexicon = spark.sparkContext.broadcast(
        learn_lexicon(stage(docs.join(chosen.filter("use = 'lexicon'"), "doc_id"), "toxicity-lexicon"))
    )
    dense = stage(
        docs.mapInArrow(_dense(lexicon), "doc_id bigint, " + ", ".join(f"{n} double" for n in NAMES)),
        "toxicity-features",
    )
    assembled = VectorAssembler(inputCols=list(NAMES), outputCol="features")
    known = stage(dense.join(chosen, "doc_id"), "toxicity-known")
    counts = {(r.use, r.toxic): r["count"] for r in known.groupBy("use", "toxic").count().collect()}
    if any(not counts.get((use, t)) for use in ("trees", "calibration") for t in (0, 1)):
        toxic = sum(n for (_, t), n in counts.items() if t)
        return dense.withColumn("score", F.lit((toxic + 1) / (sum(counts.values()) + 2)))
    trees = GBTClassifier(
        labelCol="toxic", featuresCol="features", maxIter=24, maxDepth=4, stepSize=0.2, seed=11,
        minInstancesPerNode=4,
    ).fit(assembled.transform(known.filter("use = 'trees'")))

    def said(rows: DataFrame) -> DataFrame:
        rows = trees.transform(assembled.transform(rows))
        return rows.withColumn("said", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction"
        )

    isotonic = IsotonicRegression(labelCol="toxic", featuresCol="said", predictionCol="score").fit(
        said(known.filter("use = 'calibration'"))
    )
    return isotonic.transform(said(dense)).withColumn(
        "score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score"))
    )
