"""Tables kept as parts, so that a batch writes what it changed and not the table.

A table is a list of parts, oldest first, each written once by the batch it is named after.
What a batch adds is a new part. What it removes stays in the parts, and a small record of
removed keys says so: reading is *parts minus removed*. A part takes newer ones into it as soon
as they are not much smaller together, so there are few parts and a row is rewritten a
logarithmic number of times; when much of a table is removed it is written anew as one part.

The oldest part of a warehouse table holds most of its rows and is bucketed by natural key, or by the
bucket its surrogate key was made of, so that change detection joins it without shuffling it.
In the second case the shuffle that makes surrogate keys also serves the buckets. A key has one open version at most and
versions get growing surrogate keys, so a row is removed if its natural key has a removed
version with the same or a greater surrogate key: one equality, by the columns of the bucketing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from scdstar.operators.keys import KEY_BUCKET, deal, dealt_into, key_bucket_sql

#: A part is merged with what came after it once that is over a FACTOR-th of its rows.
FACTOR = 4
#: A table is written anew once a WASTE-th of the rows in its parts are removed ones.
WASTE = 2


@dataclass(frozen=True)
class Stored:
    """The parts of a table, as batch and number of rows, how many of these rows were removed
    since the oldest part was written, and the highest surrogate key given out so far."""

    parts: tuple[tuple[int, int], ...] = ()
    removed: int = 0
    top: int = 0

    @property
    def since(self) -> int:
        """The batch of the oldest part: it has no rows that were removed by then."""
        return self.parts[0][0]

    @property
    def version(self) -> int:
        return self.parts[-1][0]

    def text(self) -> str:
        return json.dumps({"parts": self.parts, "removed": self.removed, "top": self.top})

    @staticmethod
    def parse(text: str) -> Stored:
        found = json.loads(text)
        return Stored(tuple(map(tuple, found["parts"])), found["removed"], found["top"])

    def to_merge(self, n_fresh: int, n_removed: int) -> int:
        """How many of the newest parts are written anew with a batch's rows."""
        total = n_fresh + sum(n for _, n in self.parts)
        if (self.removed + n_removed) * WASTE >= max(total, 1):
            return len(self.parts)
        found, size = 0, n_fresh
        for _, n in reversed(self.parts):
            if not size or n > FACTOR * size:
                break
            found, size = found + 1, size + n
        return found


@dataclass(frozen=True)
class Parts:
    """The parts of one table in the catalog."""

    spark: SparkSession
    namespace: str
    table: str
    #: Natural key that the oldest part is bucketed by, if it is.
    key: tuple[str, ...] = ()
    buckets: int = 0
    #: Whether the oldest part is bucketed by the bucket of the natural key.
    by_bucket: bool = False

    def name(self, batch_id: int) -> str:
        return f"{self.namespace}.{self.table}__v{batch_id}"

    def read(self, batch_id: int) -> DataFrame:
        return self.spark.table(self.name(batch_id)).drop(KEY_BUCKET)

    def dealt_into(self, batch_id: int) -> int | None:
        """The number of files a part is dealt into by key bucket, if it is."""
        return dealt_into(self.spark.table(self.name(batch_id))) if self.by_bucket else None

    def rows(self, stored: Stored) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.read(b) for b, _ in stored.parts])

    def write(self, rows: DataFrame, batch_id: int, oldest: bool) -> int:
        """Write one part and return its number of rows, which its files tell."""
        writer = rows.write
        if oldest and self.key and self.buckets and self.by_bucket:
            writer = (
                deal(rows, self.key, self.buckets).write
                .bucketBy(self.buckets, KEY_BUCKET).sortBy(*self.key)
            )
        elif oldest and self.key and self.buckets:
            writer = (
                rows.repartition(self.buckets, *self.key).write
                .bucketBy(self.buckets, *self.key).sortBy(*self.key)
            )
        writer.mode("overwrite").saveAsTable(self.name(batch_id))
        return self.read(batch_id).count()

    def first(self, rows: DataFrame, batch_id: int) -> Stored:
        return Stored(((batch_id, self.write(rows, batch_id, True)),))

    def add(
        self,
        stored: Stored,
        batch_id: int,
        fresh: DataFrame,
        n_fresh: int,
        n_removed: int,
        merge: Callable[[Stored, DataFrame], DataFrame],
    ) -> Stored:
        """Take in a batch's rows. ``merge`` gives the rows that some parts and the
        batch's rows leave; it is called if parts are written anew."""
        n_merged = stored.to_merge(n_fresh, n_removed)
        removed = stored.removed + n_removed
        if not n_fresh and not n_merged:
            return replace(stored, removed=removed)
        cut = len(stored.parts) - n_merged
        older, newer = stored.parts[:cut], stored.parts[cut:]
        rows = merge(replace(stored, parts=newer, removed=removed), fresh) if newer else fresh
        n_rows = self.write(rows, batch_id, not older)
        return replace(
            stored, parts=(*older, (batch_id, n_rows)), removed=removed if older else 0
        )


def newest_of(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """The rows of several parts, oldest first, without those whose key a newer part has.

    Older parts are larger, and are joined with the few keys of the newer ones: no grouping.
    """
    found = parts[-1]
    for older in reversed(parts[:-1]):
        found = older.join(found.select(key), key, "left_anti").unionByName(found)
    return found


def summed(parts: Sequence[DataFrame]) -> DataFrame:
    """Reference counts of several parts together: ``sk``, ``n`` and ``expired``."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("sk").agg(F.sum("n").alias("n"), F.max("expired").alias("expired"))


def open_select(
    columns: Sequence[str],
    parts: Sequence[str],
    removed: str | None = None,
    key: Sequence[str] = (),
    sk: str | None = None,
    buckets: int | None = None,
) -> str:
    """SQL for the rows of ``parts`` without removed ones.

    ``removed`` selects, for a warehouse table, the natural ``key`` and the surrogate key
    ``gone`` of its last removed version; for other tables, the removed surrogate keys ``gone``.
    ``buckets`` tells that the parts are dealt into so many files by key bucket. Removed keys
    are then dealt alike, so that the parts are not shuffled.
    """
    listed = ", ".join(columns)
    read = ", ".join({**dict.fromkeys(columns), **({KEY_BUCKET: None} if buckets and removed else {})})
    rows = " UNION ALL ".join(f"SELECT {read} FROM {part}" for part in parts)
    if removed is None:
        return rows
    if buckets:
        removed = (
            f"SELECT /*+ REPARTITION({buckets}, {KEY_BUCKET}) */ *, {key_bucket_sql(key)} AS {KEY_BUCKET}"
            f" FROM ({removed})"
        )
        same = " AND ".join(f"p.{c} = g.{c}" for c in (KEY_BUCKET, *key)) + f" AND p.{sk} <= g.gone"
    elif key:
        same = " AND ".join(f"p.{c} = g.{c}" for c in key) + f" AND p.{sk} <= g.gone"
    else:
        same = f"p.{sk} = g.gone"
    return f"SELECT {listed} FROM ({rows}) p LEFT ANTI JOIN ({removed}) g ON {same}"


def numbered_open_select(
    columns: Sequence[str], parts: Sequence[tuple[int, str]], removed: str | None, sk: str
) -> str:
    """Like :func:`open_select` for rows that may come back after they were removed: a
    removal, ``gone`` in batch ``update_id``, counts for older parts only."""
    if removed is None:
        return open_select(columns, [part for _, part in parts])
    listed = ", ".join(columns)
    rows = " UNION ALL ".join(
        f"SELECT {listed}, {batch_id} AS part_no FROM {part}" for batch_id, part in parts
    )
    return (
        f"SELECT {listed} FROM ({rows}) p LEFT ANTI JOIN ({removed}) g"
        f" ON p.{sk} = g.gone AND p.part_no < g.update_id"
    )
