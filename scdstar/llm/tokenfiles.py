"""Token-ID / binary output: documents as files of rANS blocks, in ascending ``doc_id`` order.

1. Documents are range-partitioned and sorted by ``doc_id`` (ties by a hash of the text).
2. Each partition encodes its texts once and gathers the ids of whole documents into blocks of at
   least ``BLOCK`` ids. A block knows its partition, its number and the ids before it in
   the partition, and how often each id occurs in it. Blocks are written compressed, as the
   corpus must be counted first.
3. Occurrences are summed by id over all blocks: a table of the vocabulary's size, which
   becomes the shared frequency table.
4. Each block is coded by itself. The files are Parquet of ``(part, block, before, payload)``,
   a payload for each block, so they can lie in any store that Spark writes to;
   ``frequencies`` beside them has the table. File and block order is document order.

Reading decodes blocks in parallel and checks their sums. Global positions need the
total of each partition only: one row for each partition.

Defined results: a null or empty text has the end id only. A null ``doc_id`` comes first
and is kept as null. Repeated rows are documents of their own. An empty table gives files
without blocks. Further columns are ignored. Memory is bounded by a block and the longest text.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scdstar.llm import rans
from scdstar.llm.encoder import encoder
from scdstar.llm.shingles import arrow_batches
from scdstar.session import shared_folder, stage

#: Ids of a block, but for the document that fills it.
BLOCK = 1 << 19

_BLOCKS = (
    "part int, block int, before bigint, docs array<bigint>, sizes array<bigint>, ids binary,"
    " used array<int>, times array<int>"
)


def _blocks(definition, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(definition.value)
        part, number, before, held = TaskContext.get().partitionId(), 0, 0, 0
        docs: list[int | None] = []
        sizes: list[int] = []
        ids: list[np.ndarray] = []
        end = np.array([end_id], encode.dtype)

        def block() -> pa.RecordBatch:
            nonlocal number, before, held
            found = np.concatenate(ids)
            times = np.bincount(found)
            used = np.flatnonzero(times)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before]),
                 pa.array([docs], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([_packed(found)], pa.binary()), pa.array([used], pa.list_(pa.int32())),
                 pa.array([times[used]], pa.list_(pa.int32()))],
                ["part", "block", "before", "docs", "sizes", "ids", "used", "times"],
            )
            number, before, held = number + 1, before + held, 0
            docs.clear(), sizes.clear(), ids.clear()
            return row

        for batch in batches:
            numbers, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, found in zip(numbers, encode.encode(texts)):
                docs.append(doc)
                sizes.append(len(found) + 1)
                ids.extend((found, end))
                held += len(found) + 1
                if held >= BLOCK:
                    yield block()
        if docs:
            yield block()

    return run


def _packed(ids: np.ndarray) -> bytes:
    """Ids in a byte that says how wide they are and then bytes of equal weight together, as the
    upper ones hardly vary."""
    width = ids.dtype.itemsize
    planes = np.ascontiguousarray(ids).view("u1").reshape(-1, width).T.tobytes()
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), "u1")
    return np.ascontiguousarray(planes.reshape(packed[0], -1).T).view(f"<u{packed[0]}").reshape(-1)


def _coded(frequencies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(frequencies.value)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("ids", "docs", "sizes"))
            payload = [rans.encode(_unpacked(i), table, d, s) for i, d, s in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("part", "block", "before")), pa.array(payload, pa.binary())],
                ["part", "block", "before", "payload"],
            )

    return run


def _documents(frequencies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(frequencies.value)
        for batch in batches:
            for part, before, payload in zip(
                *(batch.column(c).to_pylist() for c in ("part", "before", "payload"))
            ):
                docs, sizes, ids = rans.decode(payload, table)
                ends = np.cumsum(sizes)
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(docs), pa.int32()), pa.array(docs, pa.int64()),
                     pa.array(before + ends - sizes), pa.array(sizes), pa.array(sums, pa.int64())],
                    ["part", "doc_id", "within", "n_tokens", "ids_crc32"],
                )

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int) -> None:
    """Write the texts of ``docs(doc_id, text)`` as token ids, with ``end_id`` after each, to
    ``folder``. ``tokenizer`` is the path of a definition for the tokenizers library; the
    driver reads it and sends its content along."""
    spark = docs.sparkSession
    arrow_batches(spark)
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text("utf-8"))
    vocabulary = max(encoder(definition.value).width.size, end_id + 1)
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    blocks = stage(ordered.mapInArrow(_blocks(definition, end_id), _BLOCKS), "token-blocks")
    counted = (
        blocks.select(F.explode(F.arrays_zip("used", "times")).alias("x"))
        .select(F.col("x.used").alias("id"), F.col("x.times").alias("n")).groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    )  # a row for each id of the vocabulary
    counts = np.zeros(vocabulary, np.int64)
    counts[counted.column("id").to_numpy()] = counted.column("n").to_numpy()
    frequencies = spark.sparkContext.broadcast(rans.quantized(counts))
    spark.range(len(frequencies.value)).select(
        "id", F.expr(f"element_at(array({','.join(map(str, frequencies.value))}), CAST(id + 1 AS INT))")
        .alias("frequency")
    ).write.parquet(f"{folder}/frequencies")
    blocks.drop("used", "times").mapInArrow(_coded(frequencies), "part int, block int, before bigint, payload binary").write.parquet(
        f"{folder}/blocks"
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the files: ``doc_id``, ``start`` (ids of all documents before),
    ``n_tokens`` with the end id, and the CRC-32 of the ids."""
    arrow_batches(spark)
    table = spark.read.parquet(f"{folder}/frequencies").orderBy("id").toArrow()
    frequencies = spark.sparkContext.broadcast(table.column("frequency").to_numpy().astype(np.int64))
    rows = spark.read.parquet(f"{folder}/blocks").mapInArrow(
        _documents(frequencies),
        "part int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint",
    )
    rows = stage(rows, "token-documents")
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each partition
    base = parts.select(
        "part", F.expr("coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING"
                       " AND 1 PRECEDING), 0)").alias("base"),
    )
    return rows.join(base, "part").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/scdstar/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
