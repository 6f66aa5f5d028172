"""Sharding by sampled splitters: ranges of a key with nearly equal bytes.

1. A record is sampled in proportion to its size: a long one may be drawn several times, by a
   hash of its key, so that lost tasks draw the same again.
2. Quantiles of the sampled keys are the boundaries of ``pieces`` ranges. The key is a hash of
   the text first, so equal texts lie side by side and mostly share a shard.
3. Records find their range by an equality join on the key's upper bits, with the
   bounds as a further condition; boundaries are a table of bounded size, not a broadcast
   by decree.
4. Ranges that hold over twice their fair bytes, such as a large group of equal texts, are
   subdivided by quantiles of sampled ``doc_id`` within them.
5. Bytes are then summed for each piece, exactly. Pieces go to shards in key order, each to the
   shard in which its middle byte falls, so a shard is off by about one piece at most: half
   a percent of a shard at 8 shards and 2048 pieces, or the longest record if that is more.
6. Slots count records within a piece, after those of the shard's earlier pieces.

Only the table of pieces is ordered as a whole; it has at most ``pieces`` + subdivisions rows,
whatever the corpus. All of it is DataFrame functions.

Defined results: a null text has size 1, the CRC-32 of no bytes, and is a group of its own; null ``doc_id`` sort
first; repeated rows get slots of their own, in any order among themselves. An empty table
has no rows. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scdstar.session import stage

#: Ranges that splitters make; pieces of a range that is subdivided; draws for each.
PIECES, SUBDIVISIONS, DRAWS = 2048, 512, 16
#: Upper bits of a key that records and ranges meet on.
CELL_BITS = 12


def _quantiles(n: int) -> str:
    return f"array({', '.join(f'{(k + 1) / n!r}D' for k in range(n - 1))})"


def _bounds(edges: DataFrame, key: str, *by: str) -> DataFrame:
    """From an array ``q`` of quantiles, ranges ``lo <= key < hi`` numbered from 0."""
    points = edges.select(*by, F.expr("array_sort(array_distinct(q))").alias("q"))
    return points.select(*by, F.expr(
        "posexplode(transform(sequence(0, size(q)), k -> struct(get(q, k - 1) AS lo, get(q, k) AS hi)))"
    ).alias(f"{key}_no", "range")).select(*by, f"{key}_no", "range.lo", "range.hi")


def shard(docs: DataFrame, shards: int = 8, pieces: int = PIECES) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id``, ``size``, ``text_crc32``,
    ``shard``, ``slot`` and ``piece``."""
    rows = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
            F.xxhash64("text").alias("key"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("piece"))
    fair = total / pieces

    def drawn(of: DataFrame, fair_bytes: float) -> DataFrame:
        u = F.pmod(F.xxhash64(F.lit("draw"), "doc_id", "key"), F.lit(1 << 30)) / float(1 << 30)
        times = F.floor(F.col("size") * (DRAWS / fair_bytes) + u).cast("int")
        return of.withColumn("times", times).filter("times > 0").withColumn(
            "draw", F.explode(F.sequence(F.lit(1), "times"))
        )

    edges = drawn(rows, fair).agg(F.expr(f"percentile_approx(key, {_quantiles(pieces)}, {20 * pieces})").alias("q"))
    ranges = _bounds(edges, "key")
    cell = f"shiftright(%s, {64 - CELL_BITS})"
    low, high = -(1 << CELL_BITS - 1), (1 << CELL_BITS - 1) - 1
    ranges = ranges.withColumn("cell", F.expr(
        f"explode(sequence(CAST(coalesce({cell % 'lo'}, {low}) AS INT), CAST(coalesce({cell % 'hi'}, {high}) AS INT)))"
    ))
    placed = rows.withColumn("cell", F.expr(f"CAST({cell % 'key'} AS INT)")).join(ranges, "cell").filter(
        "(lo IS NULL OR key >= lo) AND (hi IS NULL OR key < hi)"
    ).drop("cell", "lo", "hi")
    placed = stage(placed, "shard-ranges")

    over = placed.groupBy("key_no").agg(F.sum("size").alias("b"), F.count("*").alias("n")).filter(
        (F.col("b") > 2 * fair) & (F.col("n") > 1)
    ).select("key_no")
    inside = placed.join(over, "key_no")
    edges = drawn(inside, fair).groupBy("key_no").agg(
        F.expr(f"percentile_approx(coalesce(doc_id, -9223372036854775808L), {_quantiles(SUBDIVISIONS)}, 10000)").alias("q")
    )
    sub = _bounds(edges, "sub", "key_no")
    doc = F.coalesce("doc_id", F.lit(-(1 << 63)))
    divided = inside.join(
        sub.withColumnRenamed("key_no", "of"),
        (F.col("key_no") == F.col("of")) & (F.col("lo").isNull() | (doc >= F.col("lo")))
        & (F.col("hi").isNull() | (doc < F.col("hi"))),
    ).drop("of", "lo", "hi")
    parted = placed.join(over, "key_no", "left_anti").withColumn("sub_no", F.lit(0)).unionByName(divided)
    parted = stage(parted, "shard-pieces")

    counted = parted.groupBy("key_no", "sub_no").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    # At most pieces + subdivisions rows: the only table that is ordered as a whole.
    told = counted.selectExpr(
        "key_no", "sub_no", "b", "n",
        "row_number() OVER (ORDER BY key_no, sub_no) - 1 AS piece",
        "sum(b) OVER (ORDER BY key_no, sub_no) - b / 2 AS middle",
    ).withColumn("shard", F.least(F.floor(F.col("middle") * shards / total), F.lit(shards - 1)).cast("int"))
    told = told.selectExpr(
        "key_no", "sub_no", "CAST(piece AS BIGINT) AS piece", "shard",
        "sum(n) OVER (PARTITION BY shard ORDER BY piece) - n AS before",
    )
    return parted.join(told, ["key_no", "sub_no"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("before") + F.expr(
            "row_number() OVER (PARTITION BY key_no, sub_no ORDER BY key, doc_id, size)"
        ) - 1).alias("slot"),
        "piece",
    )
