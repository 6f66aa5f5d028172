"""Benchmark decontamination: size-partitioned MinHash containment search.

Which benchmark items does a document contain, when it may be a thousand times as long? An
ordinary MinHash signature sees next to nothing of a short item in a long set. So documents
are partitioned by set size, and each size class has signatures as long as its sets need:

* **Documents.** One-permutation MinHash: a shingle falls into one of ``K`` bins by its hash, a bin
  keeps its least hash. ``K`` is the upper size of the class over ``LOAD``, a power of two.
* **Items** have a signature for every class. Bins of a class are halves of those of the class
  below, so what is least in its bin stays so in all greater classes: a shingle is kept once, with the
  first class whose signature it belongs to.
* **Threshold.** Document and item agree in a bin if both have the same least hash there. A class whose
  upper size is under the item's threshold cannot contain it. In the others a shared shingle agrees
  with a probability of at least ``_agree(percent)``, from the load of documents and of the shingles
  that the item has alone. A candidate agrees in as many bins as an item at the very threshold
  reaches but once in ``1 / MISS`` times (``needed``).
* **Short items**, for which that number would be none, and all items with ``exact=True``, are searched
  by all shingles of the documents, and are candidates by their full count: nothing is missed.
  Items of fewer words than a shingle are looked for as runs of their own number of words.
* Candidates are **verified** by exact containment: distinct shingles of the item that occur
  in the document, over those of the item. Shingles differ by 64-bit hashes.

Documents send only shingles that a bitmap of ``2**BITS`` slots, filled from the items, lets pass:
a fixed size on driver and workers, and no loss, as it errs on one side. Candidates of a document
are verified in groups of some ``CHUNK`` item shingles, whatever the size of the benchmark.

Defined results: null, empty or blank documents and items match nothing; an item of fewer
words than a shingle is one shingle, its whole sequence. A null ``doc_id`` or
``item_id`` matches nothing. A ``doc_id`` or ``item_id`` that occurs with several texts
matches by each of them, and gets one row with its best. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scdstar.llm.common import word_bytes
from scdstar.llm.shingles import arrow_batches, shingle_set
from scdstar.session import stage

#: Shingles to a bin at the upper end of a size class.
LOAD = 0.5
#: Upper size of the first class.
FIRST = 16
#: Chance that an item at the threshold is not found by signatures.
MISS = 1e-9
#: Slots of the bitmap, as a power of two.
BITS = 23
#: Item shingles that a group of candidates of one document is verified with, about.
CHUNK = 1 << 16


def bins(n: int) -> int:
    """Bins of the size class of sets of ``n`` shingles: classes double in size."""
    upper = FIRST
    while upper < n:
        upper *= 2
    return int(upper / LOAD)


def signature(grams: np.ndarray, width: int) -> np.ndarray:
    """The least hash in each of ``width`` bins; ``grams`` are sorted and distinct."""
    _, first = np.unique(grams % np.uint64(width), return_index=True)
    return grams[first]


def first_classes(grams: np.ndarray) -> np.ndarray:
    """For each of ``grams`` the bins of the first class whose signature holds it."""
    first, width = np.zeros(len(grams), np.int64), int(FIRST / LOAD)
    while not first.all():
        kept = np.isin(grams, signature(grams, width), assume_unique=True)
        first[kept & (first == 0)] = width
        width *= 2
    return first


def _agree(percent: int) -> float:
    """Least probability that a shared shingle is its bin's least hash on both sides. Those the
    item has alone are at most ``LOAD * (100 - percent) / percent`` a bin in any class that can
    contain it."""
    return -math.expm1(-LOAD) / LOAD * math.exp(-LOAD * (100 - percent) / percent)


@lru_cache(maxsize=4096)
def needed(n: int, percent: int) -> int:
    """Bins in which an item of ``n`` shingles has to agree: the most that one sharing just
    ``percent`` of them falls short of with a probability of ``MISS`` or less."""
    shared, p = min(-(-percent * n // 100), 1000), _agree(percent)
    term = below = (1 - p) ** shared
    least = 0
    while least < shared and below <= MISS:
        least += 1
        term *= (shared - least + 1) / least * p / (1 - p)
        below += term
    return least


def _passing(grams: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    slots = grams & np.uint64((1 << BITS) - 1)
    return grams[(bitmap[slots >> np.uint64(6)] >> (slots & np.uint64(63)) & np.uint64(1)).astype(bool)]


def _sent(size: int, widths: list[int], maps):
    """Shingles of documents that items may have: of signatures, then of all for exact search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed_map, exact_map = maps.value
        for batch in batches:
            ids, of, grams, exact, width = batch.column(0), [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                every = shingle_set(text, size)
                k = bins(len(every))
                least = _passing(signature(every, k), signed_map)
                if widths:
                    every = np.unique(np.concatenate([every, *(shingle_set(text, w) for w in widths)]))
                rest = _passing(every, exact_map)
                n = len(least) + len(rest)
                of.append(np.full(n, row))
                width.append(np.full(n, k, np.int64))
                grams += [least, rest]
                exact.append(np.arange(n) >= len(least))
            if not of:
                continue
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(np.concatenate(of))), pa.array(np.concatenate(width)),
                 pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(exact))],
                ["doc_id", "width", "gram", "exact"],
            )

    return run


def _items(size: int, percent: int, exact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sets = [shingle_set(t, size) for t in texts]
            need = [0 if exact else needed(len(s), percent) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([min(size, len(word_bytes(t))) for t in texts], pa.int32()),
                 pa.array(need, pa.int64()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([first_classes(s) for s in sets], pa.list_(pa.int64()))],
                ["item_id", "words", "need", "grams", "first"],
            )

    return run


def _contained(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items")))
            for doc_id, text, items in rows:
                sets = {w: shingle_set(text, w).view(np.int64) for w in {i["words"] for i in items}}
                for item in items:
                    own = np.array(item["grams"], np.int64)
                    both = int(np.isin(own, sets[item["words"]], assume_unique=True).sum())
                    out.append((doc_id, item["item_id"], len(own), both))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (list(zip(*out)) or [[]] * 4)],
                ["doc_id", "item_id", "n_shingles", "n_shared"],
            )

    return run


def _bitmap(grams: DataFrame) -> np.ndarray:
    """The slots of ``grams(gram)`` as bits of 64-bit words, ``2**(BITS - 6)`` of them."""
    slot = F.col("gram").bitwiseAND(F.lit((1 << BITS) - 1))
    words = (
        grams.select(F.shiftright(slot, 6).alias("word"), F.expr("shiftleft(1L, CAST(gram & 63 AS INT))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )  # at most 2**(BITS - 6) rows
    found = np.zeros(1 << (BITS - 6), np.uint64)
    found[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return found


def candidates(docs: DataFrame, items: DataFrame, size: int, percent: int) -> DataFrame:
    """Distinct ``(doc_id, item_id)`` that agree in as many bins as the item needs, or share all that
    an exactly searched item needs. ``items(item_id, words, need, grams, first)``."""
    probes = stage(
        items.withColumn("n", F.size("grams").cast("long"))
        .withColumn("exact", F.col("need") == 0)
        .withColumn("need", F.expr(f"IF(exact, ({percent} * n + 99) div 100, need)"))
        .select("item_id", "need", "n", "exact", F.explode(F.arrays_zip("grams", "first")).alias("g"))
        .select("item_id", "need", "n", "exact", F.col("g.grams").alias("gram"), F.col("g.first").alias("first")),
        "contain-probes",
    )
    short = items.filter(F.col("words") < size).select("words").distinct().collect()  # under ``size`` of them
    maps = docs.sparkSession.sparkContext.broadcast(
        [_bitmap(probes.filter(~F.col("exact")).select("gram")), _bitmap(probes.filter("exact").select("gram"))]
    )
    sent = docs.select("doc_id", "text").mapInArrow(
        _sent(size, sorted(r.words for r in short), maps), "doc_id bigint, width bigint, gram bigint, exact boolean"
    )
    fits = F.col("exact") | (
        (F.col("width") >= F.col("first")) & (F.col("width") * LOAD * 100 >= F.col("n") * percent)
    )
    return (
        sent.join(probes, ["gram", "exact"]).filter(fits)
        .groupBy("doc_id", "item_id").agg(F.count("*").alias("agree"), F.min("need").alias("need"))
        .filter("agree >= need").select("doc_id", "item_id")
    )


def contained_items(
    docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80, exact: bool = False
) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shingles`` of the item and ``n_shared`` of them in the
    document, for every pair with ``100 * n_shared >= percent * n_shingles``. ``exact`` searches
    all items by all shingles."""
    arrow_batches(docs.sparkSession)
    docs = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = stage(
        benchmark.filter("item_id IS NOT NULL")
        .select(F.col("item_id").cast("long").alias("item_id"), "text")
        .mapInArrow(
            _items(size, percent, exact),
            "item_id bigint, words int, need bigint, grams array<bigint>, first array<bigint>",
        ).filter("size(grams) > 0"),
        "contain-items",
    )
    found = stage(candidates(docs, items, size, percent), "contain-candidates")
    total = items.agg(F.sum(F.size("grams"))).first()[0] or 0
    group = F.pmod(F.xxhash64("item_id"), F.lit(-(-total // CHUNK) or 1))
    asked = (
        found.join(items, "item_id").groupBy("doc_id", group.alias("group"))
        .agg(F.collect_list(F.struct("item_id", "words", "grams")).alias("items"))
    )  # about CHUNK shingles, or one item
    # Candidates have a known size: if they are few, documents without any are not shuffled.
    verified = (
        docs.join(found, "doc_id", "left_semi").join(asked, "doc_id").select("doc_id", "text", "items")
        .mapInArrow(_contained(size), "doc_id bigint, item_id bigint, n_shingles bigint, n_shared bigint")
        .filter(f"100 * n_shared >= {percent} * n_shingles")
    )
    return verified.groupBy("doc_id", "item_id").agg(
        F.max(F.struct(F.col("n_shared") / F.col("n_shingles"), "n_shared", "n_shingles")).alias("best")
    ).select("doc_id", "item_id", "best.n_shingles", "best.n_shared")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    hit = contained_items(docs, benchmark, size, percent).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").select(*docs.columns)
