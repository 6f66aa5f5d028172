"""Shingle sets of whole texts as 64-bit hashes, made in Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import SparkSession

from scdstar.llm.common import word_bytes

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def arrow_batches(spark: SparkSession, rows: int = 256) -> None:
    """Whole texts go to Python in small batches, so that memory is bounded by the longest
    texts rather than by ten thousand of them. A setting of the user's own stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(rows))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of the whole sequence if there
    are fewer words; nothing without words. Sequences differ by 64-bit hashes."""
    found = word_bytes(text)
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(size, len(found))
    with np.errstate(over="ignore"):
        total = np.full(len(found) - width + 1, np.uint64(width))
        for k in range(width):
            total = _mixed(total * _ODD + hashes[k : len(found) - width + 1 + k])
    return np.unique(total)
