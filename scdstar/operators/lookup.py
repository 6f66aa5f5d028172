"""Resolution of natural keys to surrogate keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from scdstar.operators.keys import latest_keys


@dataclass(frozen=True)
class Lookup:
    """Column ``ref`` refers to ``table``; the key found goes to column ``out``."""

    ref: str
    table: str
    natural: str
    sk: str
    out: str


def latest_of(look: Lookup, versions: DataFrame) -> DataFrame:
    """One row for each natural key of the referred table, with its latest key."""
    return latest_keys(versions, look.natural, look.sk)


def resolve(
    rows: DataFrame,
    lookups: Sequence[Lookup],
    versions: Callable[[str], DataFrame],
    latest: Callable[[Lookup], DataFrame] | None = None,
) -> DataFrame:
    """Add the surrogate key of each referred row; drop rows with a dangling or NULL one.

    A table may be looked up in several roles. Each lookup sees the latest version
    only, so it never multiplies rows. No join is hinted: a small table is
    broadcast by the optimizer's size check, a large one is sort-merge joined.
    ``latest`` may give the latest versions as a written table. Then the join reads
    both sides by plain shuffles, and adaptive execution splits hot references; an
    aggregation between shuffle and join would rule that out.
    """
    for look in lookups:
        found = latest(look) if latest else latest_of(look, versions(look.table))
        target = found.select(F.col(look.natural).alias(look.ref), F.col(look.sk).alias(look.out))
        rows = rows.join(target, look.ref)
    return rows
