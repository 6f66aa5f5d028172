"""The star kept up to date by what a batch inserted and closed.

Facts follow their warehouse table: inserted versions are new facts, closed ones are removed. A
dimension row stays as long as its version is current or some fact refers to it, so for each
dimension a count of references by surrogate key is maintained, moved by the rows that came
and went, together with a mark for closed versions. Only keys that a batch touches are
looked up in the counts; neither facts, bookings nor history are read as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from scdstar.plans import star
from scdstar.plans.star import KEYS
from scdstar.plans.storage import summed

#: For each dimension, the rows that refer to it: warehouse tables or another dimension.
REFERENCES: dict[str, tuple[tuple[str, str], ...]] = {
    "dim_flight": (("flight_bookings", "flight_sk"), ("airline_reviews", "flight_sk")),
    "dim_customer": (("flight_bookings", "customer_sk"), ("airline_reviews", "customer_sk")),
    "dim_airport": (("dim_flight", "departure_airport_sk"), ("dim_flight", "arrival_airport_sk")),
    "dim_airplane": (("dim_flight", "airplane_sk"),),
    "dim_pilot": (("dim_flight", "pilot_sk"), ("dim_flight", "copilot_sk")),
}
#: Dimensions in the order they can be brought up to date.
FIRST, SECOND = ("dim_flight", "dim_customer"), ("dim_airport", "dim_airplane", "dim_pilot")

PROJECTIONS = {
    "dim_airport": star.dim_airport,
    "dim_airplane": star.dim_airplane,
    "dim_pilot": star.dim_pilot,
    "dim_customer": star.dim_customer,
    "dim_flight": star.dim_flight,
    "fact_flight": star.fact_flight,
    "fact_booking": star.fact_booking,
    # Flights and customers of current reviews are always in the dimensions.
    "fact_review": star.fact_review_rows,
}


@dataclass(frozen=True)
class Delta:
    """What a batch did to a table: rows that came, rows that went, and their numbers."""

    fresh: DataFrame | None
    closed: DataFrame | None
    n_fresh: int
    n_closed: int


def _counted(rows: DataFrame, column: str, n: int, expired: int = 0) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).select(
        F.col(column).alias("sk"),
        F.lit(n).cast("long").alias("n"),
        F.lit(expired).cast("int").alias("expired"),
    )


def first_counts(dimension: str, rows: Mapping[str, DataFrame]) -> DataFrame:
    """References of each key of a dimension, from whole tables: ``sk``, ``n``, ``expired``."""
    return summed([_counted(rows[t], c, 1) for t, c in REFERENCES[dimension] if t in rows])


def count_changes(
    dimension: str, deltas: Mapping[str, Delta], closed: DataFrame | None
) -> DataFrame | None:
    """By how much a batch moves the counts of a dimension, and which versions it closed."""
    parts = []
    for table, column in REFERENCES[dimension]:
        delta = deltas.get(table)
        if delta and delta.fresh is not None:
            parts.append(_counted(delta.fresh, column, 1))
        if delta and delta.closed is not None:
            parts.append(_counted(delta.closed, column, -1))
    if closed is not None:
        parts.append(_counted(closed, KEYS[dimension], 0, 1))
    return summed(parts) if parts else None


def moves(changes: DataFrame, counts: Sequence[DataFrame]) -> DataFrame:
    """The keys that leave a dimension or come back to it: ``sk`` and ``came``.

    ``counts`` are the parts of the counts before the batch; of them, only the keys in
    ``changes`` are aggregated.
    """
    before = reduce(DataFrame.unionByName, counts).join(changes.select("sk"), "sk", "left_semi")
    known = summed([before]).withColumnsRenamed({"n": "n_0", "expired": "expired_0"})
    joined = changes.join(known, "sk", "left").na.fill(0, ["n_0", "expired_0"])

    def there(n: Column, expired: Column) -> Column:
        return (expired == 0) | (n > 0)

    was = there(F.col("n_0"), F.col("expired_0"))
    stays = there(F.col("n_0") + F.col("n"), F.greatest("expired_0", "expired"))
    return joined.where(was != stays).select("sk", stays.alias("came"))
