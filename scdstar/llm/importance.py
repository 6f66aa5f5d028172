"""Target-distribution importance resampling over hashed n-grams.

1. **Features.** A text becomes ASCII-lower-cased UTF-8 with every run of separators collapsed to one
   space. One regular expression with boundary lookarounds, scanned with overlapping
   matches, yields for each word the spans of the one-, two- and three-word n-grams that begin there.
   The CRC-32 of a span, carried on from the shorter one, modulo ``BUCKETS`` is its bucket. Each
   text is scanned once; its buckets are written as 16-bit numbers.
2. **Counts.** Each task adds up its buckets in one array; Spark sums ``BUCKETS`` numbers of a task.
   All documents and all target texts count, repeats included.
3. **Weights.** A bucket's gain is ``floor(1000 ln(((t + 1) (S + B)) / ((s + 1) (T + B))))``; the
   gains are a table of ``BUCKETS`` numbers, a document's weight is their sum over its features.
4. **Draw.** Gumbel noise from a hash of the id makes the highest scores a sample without
   replacement in proportion to ``exp(weight / 1000)``. Scores are sorted by range over all tasks;
   a rank is a place in a partition plus the sizes of the partitions before.

Defined results: null and empty texts have no features and weight 0. Documents under ``least``
words are scored but never drawn. Ties go to smaller ``doc_id``s, a null one first; rows that agree
in all that is returned are ranked one after another. Without target texts the gains follow the
documents alone; an empty table gives no rows. Further columns are ignored. Memory is bounded by a
batch of texts and ``BUCKETS`` counters.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import methodcaller

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdstar.llm.infill import draws
from scdstar.llm.shingles import arrow_batches
from scdstar.session import stage

#: Buckets of features; a bucket fits 16 bits.
BUCKETS = 10_000

_NOT_WORD = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Bytes of words stay, A-Z are lower-cased, all others become a space.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
#: The n-grams that begin at a word: the word, and what a second and a third one add to it.
_NGRAMS = regex.compile(rb"(?<= )([^ ]++)( [^ ]++)?+( [^ ]++)?+(?= )")
_PARTS = methodcaller("group", 1, 2, 3)


def collapsed(text: str | None) -> bytes:
    """A space before each word, and one at the end."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()
    return b" ".join([b"", *found, b""])


def buckets_of(text: str | None) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every feature."""
    sums: list[int] = []
    add, crc32, n = sums.append, zlib.crc32, 0
    for one, two, three in map(_PARTS, _NGRAMS.finditer(collapsed(text), overlapped=True)):
        n += 1
        found = crc32(one)
        add(found)
        if two:
            found = crc32(two, found)
            add(found)
            if three:
                add(crc32(three, found))
    return n, (np.array(sums, np.uint32) % np.uint32(BUCKETS)).astype("<u2")


def _featurized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [buckets_of(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([n for n, _ in found], pa.int64()),
             pa.array([b.tobytes() for _, b in found], pa.binary())],
            ["doc_id", "n_words", "buckets"],
        )


def _buckets(column: pa.Array) -> Iterator[np.ndarray]:
    for packed in column:
        yield np.frombuffer(packed.as_buffer(), "<u2")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for found in _buckets(batch.column(0)):
            total += np.bincount(found, minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])


def featurize(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words`` and ``buckets`` of ``docs(doc_id, text)``."""
    arrow_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _featurized, "doc_id bigint, n_words bigint, buckets binary"
    )


def bucket_counts(features: DataFrame) -> DataFrame:
    """``bucket`` and ``n`` of all features: a row for each bucket that occurs."""
    counted = features.select("buckets").mapInArrow(_counted, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame) -> DataFrame:
    """``bucket`` and ``gain`` of every bucket, from the counts of documents and of target texts."""
    every = source.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"))
    both = (
        every.join(source.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0)
    )
    all_s, all_t = (int(n or 0) for n in both.agg(F.sum("s"), F.sum("t")).first())

    def plus(column: Column, k: int) -> Column:
        return (column + k).cast("double")

    ratio = (
        plus(F.col("t"), 1) * plus(F.lit(all_s), BUCKETS)
        / (plus(F.col("s"), 1) * plus(F.lit(all_t), BUCKETS))
    )
    return both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def _weighed(gain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_buckets(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(b) for b in found], pa.int64()),
                 pa.array([int(gain.value[b].sum()) for b in found], pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def weigh(features: DataFrame, table: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight``, by ``table(bucket, gain)``."""
    values = np.zeros(BUCKETS, np.int64)
    found = table.toArrow()  # BUCKETS rows
    values[found.column("bucket").to_numpy()] = found.column("gain").to_numpy()
    gain = features.sparkSession.sparkContext.broadcast(values)
    return features.mapInArrow(
        _weighed(gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    )


def in_order(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank``, 1 and up by ``order``, over sorted ranges instead of one window."""
    place = "monotonically_increasing_id()"  # the partition above 33 bits of row number
    ranged = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .selectExpr("*", f"{place} >> 33 AS range_no", f"{place} & ((1L << 33) - 1) AS row_no"),
        "ranked-ranges",
    )
    base = ranged.groupBy("range_no").count().selectExpr(
        "range_no", "coalesce(sum(count) OVER (ORDER BY range_no ROWS BETWEEN UNBOUNDED PRECEDING"
        " AND 1 PRECEDING), 0) AS base",
    )  # a row for each partition
    return ranged.join(base, "range_no").withColumn("rank", F.expr("base + row_no + 1")).drop(
        "range_no", "row_no", "base"
    )


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least: int = 20, seed: int = 42
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn),
    one row per row of ``docs(doc_id, text)``, for the distribution of ``target(text)``.
    ``percent`` of the documents with at least ``least`` words are drawn."""
    features = stage(featurize(docs), "importance-features")
    wanted = featurize(target.select(F.lit(None).alias("doc_id"), "text"))
    table = gains(bucket_counts(features), bucket_counts(wanted))
    (drawn,) = draws(seed, F.col("doc_id"), 1)
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    scored = stage(
        weigh(features, table).withColumn("score", F.col("weight") + noise), "importance-scores"
    )
    enough = F.col("n_words") >= least
    ranked = in_order(
        # Numbers of rows tell equal rows of one id apart, so that no range is bound to hold them all.
        scored.filter(enough).withColumn("row_id", F.monotonically_increasing_id()),
        [F.desc("score"), F.col("doc_id"), F.col("n_features"), F.xxhash64("row_id")],
    ).drop("row_id")
    number = scored.filter(enough).count() * percent // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= number, F.col("rank")))
    return ranked.unionByName(scored.filter(~enough).withColumn("rank", F.lit(None).cast("long")))
