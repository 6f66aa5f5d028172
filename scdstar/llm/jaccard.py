"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

Sets are distinct word n-grams. Two sets link if ``100 * |x & y| >= percent * |x | y|``.

1. **Order.** All tasks count n-grams into a sketch of fixed size; an n-gram's place in
   the global order is (magnitude of its sketch count, hash). Any one order gives whole
   results; the sketch only makes rare n-grams come first, so that texts meet at those.
2. **Classes.** Documents of one set are one class; classes join, copies never do.
3. **Prefixes.** A class is listed under its first ``n - ceil(percent * n / 100) + 1``
   n-grams. Classes that link share one of these.
4. **Stars.** Each prefix n-gram has a hub, the class with the fewest rarer n-grams. Every
   class is compared with the hubs of its n-grams: as many candidates as listings.
5. **The rest.** What no hub links is compared pair by pair, but only across components,
   only where the n-gram's places still leave enough overlap (positional filter) and sizes
   allow it (length filter). Pairs inside one component cannot change the result.
6. **Suffix filter.** Sizes of the parts into which fixed pivots cut both sets bound the
   overlap before any set is moved.
7. **Verification.** Distinct pairs meet their whole sets, once.

No pair, link or set reaches the driver, nothing is capped; hot n-grams are joins that
adaptive execution splits. The driver holds the sketch: ``2 ** SKETCH_BITS`` bytes.

Defined results: null, empty and blank texts have the empty set and link with nothing. A
null ``doc_id`` links with nothing and has no component. Repeated rows give one result row
each; a ``doc_id`` with several texts links by any of them. Columns other than ``doc_id`` and ``text`` are
ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdstar.llm.graph import components
from scdstar.llm.shingles import arrow_batches, shingle_set
from scdstar.session import stage

#: The sketch has this many cells, a power of two: a megabyte of magnitudes when broadcast.
SKETCH_BITS = 20


def _count(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << SKETCH_BITS, np.int64)
        held: list[np.ndarray] = []

        def settle() -> None:
            if held:
                cells[:] += np.bincount(np.concatenate(held), minlength=len(cells))
                held.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append((shingle_set(text, size) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
            if sum(map(len, held)) > len(cells):
                settle()
        settle()
        used = np.flatnonzero(cells)
        for k in range(0, len(used), 1 << 16):
            part = used[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(cells[part])], ["cell", "n"]
            )

    return run


def magnitudes(docs: DataFrame, size: int) -> np.ndarray:
    """The base-two logarithm of how often n-grams of each sketch cell occur."""
    counted = (
        docs.select("text").mapInArrow(_count(size), "cell int, n bigint")
        .groupBy("cell").agg(F.sum("n").alias("n"))
        .select("cell", F.floor(F.log2("n")).cast("byte").alias("m")).toArrow()
    )  # at most 2 ** SKETCH_BITS rows of five bytes
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    out[counted.column("cell").to_numpy()] = counted.column("m").to_numpy()
    return out


def parts(grams: np.ndarray) -> np.ndarray:
    """How many of a set fall between fixed pivots: the low bits of the hash, about eight
    to a part. Larger counts stay at 65535, which only weakens the bound."""
    width = 16
    while width < 1024 and width * 8 < len(grams):
        width *= 2
    counts = np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.minimum(counts, 65535).astype(np.uint16)


def least_overlap(a: int, b: int, percent: int) -> int:
    return -(-percent * (a + b) // (100 + percent))


def parts_allow(x: bytes, y: bytes, a: int, b: int, percent: int) -> bool:
    """Whether sets of ``a`` and ``b`` n-grams with these parts can overlap enough."""
    u, v = np.frombuffer(x, np.uint16).astype(np.int64), np.frombuffer(y, np.uint16).astype(np.int64)
    width = min(len(u), len(v))
    u, v = u.reshape(-1, width).sum(0), v.reshape(-1, width).sum(0)
    return int(np.abs(u - v).sum()) <= a + b - 2 * least_overlap(a, b, percent)


def _sets(size: int, percent: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = order.value
        for batch in batches:
            n, prints, prefixes, cut = [], [], [], []
            for text in batch.column(1).to_pylist():
                grams = shingle_set(text, size)
                n.append(len(grams))
                prints.append(xxhash.xxh3_128_digest(grams.tobytes()))
                rank = ranks[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                first = len(grams) - -(-percent * len(grams) // 100) + 1 if len(grams) else 0
                prefixes.append(grams[np.lexsort((grams, rank))[:first]].view(np.int64))
                cut.append(parts(grams).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(prints, pa.binary()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(cut, pa.binary())],
                ["doc_id", "n", "print", "prefix", "parts"],
            )

    return run


def _whole(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, size).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.large_binary())], ["id", "grams"]
            )

    return run


def _by_parts(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(c).to_pylist() for c in ("na", "nb", "xa", "xb"))
            keep = [parts_allow(p, q, m, n, percent) for p, q, m, n in zip(x, y, a, b)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist()):
                u, v = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(100 * both >= percent * (len(u) + len(v) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _possible(n1: str, p1: str, n2: str, p2: str, percent: int) -> Column:
    """Length and positional filter for two listings of an n-gram, their first in common."""
    return F.expr(
        f"100L * least({n1}, {n2}) >= {percent}L * greatest({n1}, {n2})"
        f" AND {100 + percent}L * least({n1} - {p1}, {n2} - {p2}) >= {percent}L * ({n1} + {n2})"
    )


def _with_both(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with the columns ``x`` and, if there, ``n`` of both ends."""
    for end in ("a", "b"):
        pairs = pairs.join(of.toDF(end, *[f"{c}{end}" for c in of.columns[1:]]), end)
    return pairs


def _verified(pairs: DataFrame, docs: DataFrame, parts_of: DataFrame, size: int, percent: int):
    """The pairs that link, of distinct candidates ``(a, b)``."""
    likely = stage(
        _with_both(pairs, parts_of).mapInArrow(_by_parts(percent), pairs.schema).distinct(),
        "jaccard-likely",
    )
    ends = likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = stage(
        docs.join(ends, "doc_id", "left_semi").mapInArrow(_whole(size), "id bigint, grams binary")
        .withColumnRenamed("grams", "x"),
        "jaccard-sets",
    )
    return stage(
        _with_both(likely, sets).mapInArrow(_linked(percent), pairs.schema).distinct(),
        "jaccard-links",
    )


def jaccard_classes(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id``, ``n_shingles``, ``class_id``
    (the smallest ``doc_id`` of the same set) and ``component_id`` (the smallest ``doc_id``
    that links reach)."""
    spark = docs.sparkSession
    arrow_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = spark.sparkContext.broadcast(magnitudes(docs, size))
    sets = stage(
        docs.mapInArrow(
            _sets(size, percent, order),
            "doc_id bigint, n int, print binary, prefix array<bigint>, parts binary",
        ),
        "jaccard-prefixes",
    )
    docs = docs.filter("doc_id IS NOT NULL")
    known = sets.filter("n > 0 AND doc_id IS NOT NULL")
    first = known.groupBy("print").agg(F.min("doc_id").alias("class_id"))
    first = stage(first, "jaccard-classes")
    classes = stage(
        known.join(first, (known["print"] == first["print"]) & (known["doc_id"] == first["class_id"]))
        .select(F.col("class_id").alias("id"), "n", "prefix", F.col("parts").alias("x")),
        "jaccard-representatives",
    )
    parts_of = classes.select("id", "x", "n").distinct()  # an id with several texts has each
    listed = classes.select("id", "n", F.posexplode("prefix").alias("pos", "gram"))
    hubs = (
        listed.groupBy("gram")
        .agg(F.count("*").alias("c"), F.min(F.struct("pos", "n", "id")).alias("hub"))
        .filter("c > 1")
        .select("gram", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"),
                F.col("hub.pos").alias("hub_pos"))
    )
    shared = stage(listed.join(hubs, "gram"), "jaccard-listings")
    stars = stage(
        shared.filter("id <> hub").filter(_possible("n", "pos", "hub_n", "hub_pos", percent))
        .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct(),
        "jaccard-stars",
    )
    links = _verified(stars, docs, parts_of, size, percent)
    comps = components(links)

    told = shared.join(comps, "id", "left").select(
        "gram", "id", "n", "pos", F.coalesce("component", "id").alias("comp")
    )
    mixed = (
        told.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        .filter("lo < hi").select("gram")
    )
    told = stage(told.join(mixed, "gram"), "jaccard-mixed")
    left, right = told.alias("l"), told.alias("r")
    rest = (
        left.join(
            right,
            (F.col("l.gram") == F.col("r.gram")) & (F.col("l.id") < F.col("r.id"))
            & (F.col("l.comp") != F.col("r.comp"))
            & _possible("l.n", "l.pos", "r.n", "r.pos", percent),
        )
        .select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    rest = stage(rest, "jaccard-rest")
    if not rest.isEmpty():
        comps = components(links.union(_verified(rest, docs, parts_of, size, percent)))
    return (
        sets.select("doc_id", "n", "print").join(first, "print", "left")
        .withColumn("class_id", F.expr("CASE WHEN n > 0 AND doc_id IS NOT NULL THEN class_id ELSE doc_id END"))
        .join(comps.select(F.col("id").alias("class_id"), "component"), "class_id", "left")
        .select("doc_id", F.col("n").cast("long").alias("n_shingles"), "class_id",
                F.coalesce("component", "class_id").alias("component_id"))
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group of texts one stays, once,
    that of the smallest ``doc_id``; rows without a ``doc_id`` all stay.

    Different texts of one ``doc_id`` are documents of their own. They are grouped under a hash of
    id and text that is greater than usual ids, so that of a group with others the others stay.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.filter("doc_id IS NOT NULL").select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"), F.xxhash64(text).alias("h"),
    )
    several = stage(
        keyed.groupBy("doc_id").agg(F.min("h").alias("least"), F.max("h").alias("most"))
        .filter("least <> most").select(F.col("doc_id").alias("several")),
        "jaccard-several",
    )
    own = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", "h"), 2)
    keyed = keyed.join(several, F.col("doc_id") == F.col("several"), "left").withColumn(
        "key", F.when(F.col("several").isNull(), F.col("doc_id")).otherwise(own)
    )
    found = jaccard_classes(keyed.select(F.col("key").alias("doc_id"), "text"), size, percent)
    first = found.filter("doc_id = component_id").select(F.col("doc_id").alias("key")).distinct()
    once = keyed.join(first, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
    return once.unionByName(docs.filter("doc_id IS NULL"))
