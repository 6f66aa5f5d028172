"""The warehouse as a set of frames, and the load of one table into it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from threading import Lock

from pyspark.sql import Column, DataFrame

from scdstar.operators.lineage import expired
from scdstar.operators.lookup import Lookup, latest_of
from scdstar.operators.scd2 import LoadOptions, Merge, TableSpec, merge, project_source

Stage = Callable[[DataFrame, str], DataFrame]


def unstaged(df: DataFrame, name: str) -> DataFrame:
    return df


@dataclass
class Warehouse:
    """Current and closed versions of each table.

    They are kept apart, so that a reader of current rows never opens history. ``pieces`` may
    give the current rows of a table in frames without common keys, and ``given_latest`` the
    latest key of each natural key, as far as they are stored.
    """

    current: dict[str, DataFrame] = field(default_factory=dict)
    history: dict[str, DataFrame] = field(default_factory=dict)
    pieces: dict[str, list[DataFrame]] = field(default_factory=dict)
    given_latest: dict[str, DataFrame] = field(default_factory=dict)
    _locks: dict[str, Lock] = field(default_factory=dict)

    def copy(self) -> Warehouse:
        frames = (self.current, self.history, self.pieces, self.given_latest)
        return Warehouse(*[dict(found) for found in frames])

    def versions(self, table: str) -> DataFrame:
        rows = self.current[table]
        past = self.history.get(table)
        return rows if past is None else rows.unionByName(past)

    def latest(self, look: Lookup, stage: Stage) -> DataFrame:
        """The latest key of each natural key: as stored, or else written once for all lookups
        of a load, so that history is aggregated once and each lookup is a plain join."""
        with self._locks.setdefault(look.table, Lock()):  # one table's does not hold up another's
            if look.table not in self.given_latest:
                rows = latest_of(look, self.versions(look.table))
                self.given_latest[look.table] = stage(rows, f"{look.table}_latest")
            return self.given_latest[look.table]

    def expired(self, table: str) -> DataFrame:
        past = self.history.get(table)
        return expired(self.current[table]) if past is None else past


def load_table(
    spec: TableSpec,
    source: DataFrame,
    before: Warehouse,
    after: Warehouse,
    batch_id: int,
    load_ts: str,
    options: LoadOptions = LoadOptions(),
    stage: Stage = unstaged,
    base: Column | None = None,
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    whole_table: bool = False,
    buckets: int | None = None,
) -> Merge:
    """Load one table's source rows; ``after`` holds the tables loaded so far in this batch.

    ``watch`` may observe the rows as they are read. ``base``, ``whole_table`` and ``buckets`` are as in
    :func:`merge`.
    """
    return merge(
        spec,
        watch(project_source(source, spec)),
        before.pieces.get(spec.name) or before.current.get(spec.name),
        before.history.get(spec.name),
        after.versions,
        batch_id,
        load_ts,
        options,
        stage,
        lambda look: after.latest(look, stage),
        base,
        whole_table,
        buckets,
    )
