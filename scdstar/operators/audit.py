"""Constraint and business-rule checks. Each returns the violations, none if clean."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from scdstar.functions.columns import whole_minutes
from scdstar.functions.ordered import previous_values, running_max_before
from scdstar.operators.lineage import current
from scdstar.schemas import CONSTRAINTS, FLIGHT_STATUSES, OPERATIONAL, Constraints

# The rules flights obey.
FLIGHT_MINUTES = 210
TURNAROUND_MINUTES = 90
DELAY_RANGE = (15, 120)
CREW_RANGE = (2, 4)
PASSENGER_RANGE = (120, 160)


def not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that must not be NULL, with the number of NULLs, in one pass."""
    required = [f.name for f in schema if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "n_null").where("n_null > 0")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs in each of the columns, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_null")


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def dangling(child: DataFrame, ref: str, parent: DataFrame, key: str) -> DataFrame:
    """References without a parent. The child's references are counted before the join,
    so a reference shared by most rows is one row per task."""
    refs = child.where(F.col(ref).isNotNull()).groupBy(F.col(ref).alias("ref")).agg(
        F.count("*").alias("n_rows")
    )
    return refs.join(parent.select(F.col(key).alias("ref")), "ref", "left_anti")


class _Checks:
    """Declared keys and references as entries that rows make, and what to make of their counts.

    An entry has a space, a value in it and a role. A table's key is a space: its rows enter their
    key in role 0, and each column that refers to it enters its values in a role of its
    own. So one count by space, value and role tells duplicate keys (role 0 more than once) and
    dangling references (no role 0).
    """

    def __init__(
        self,
        schemas: Mapping[str, T.StructType],
        constraints: Mapping[str, Constraints],
        tables: Sequence[str],
    ) -> None:
        #: By table, entries whose value is a number, and those whose value is several columns.
        self.numbers: dict[str, list[Column]] = {t: [] for t in tables}
        self.texts: dict[str, list[Column]] = {t: [] for t in tables}
        #: For each space, its roles: the names to report, or none for keys referred to only.
        self.spaces: list[list[tuple[str, str, str] | None]] = []
        #: Whether a space's role 0 may occur once.
        self.once: list[bool] = []
        parents: dict[str, int] = {}
        for table in tables:
            declared = constraints[table]
            for rule, key in [("key", declared.key), *(("unique", u) for u in declared.unique)]:
                space = self._space((table, rule, ",".join(key)), once=True)
                self._enter(table, schemas[table], space, 0, key)
                if rule == "key" and len(key) == 1:
                    parents[table] = space
        for table in tables:
            for ref, parent in constraints[table].references:
                if parent not in tables:
                    continue
                if parent not in parents:  # a key of several columns: its first is referred to
                    parents[parent] = self._space(None, once=False)
                    key = constraints[parent].key[:1]
                    self._enter(parent, schemas[parent], parents[parent], 0, key)
                found = self.spaces[parents[parent]]
                found.append((table, "reference", ref))
                self._enter(table, schemas[table], parents[parent], len(found) - 1, (ref,))

    def _space(self, check: tuple[str, str, str] | None, once: bool) -> int:
        self.spaces.append([check])
        self.once.append(once)
        return len(self.spaces) - 1

    def _enter(
        self, table: str, schema: T.StructType, space: int, role: int, columns: Sequence[str]
    ) -> None:
        number = len(columns) == 1 and isinstance(schema[columns[0]].dataType, T.IntegralType)
        if number:
            value = F.col(columns[0]).cast("long")
        else:
            value = F.array(*[F.col(c).cast("string") for c in columns])
        entry = F.struct(
            F.lit(space).alias("space"), F.lit(role).alias("role"), value.alias("value")
        )
        (self.numbers if number else self.texts)[table].append(entry)

    def counts(self, tables: Mapping[str, DataFrame], entries: Mapping[str, list[Column]]) -> DataFrame | None:
        """For each space and value how often it was entered in each role."""
        entered = [
            df.select(F.inline(F.array(*entries[name])))
            .where("role = 0 OR value IS NOT NULL")  # a NULL key is a key, a NULL reference is none
            for name, df in tables.items() if entries[name]
        ]
        if not entered:
            return None
        roles = range(max(map(len, self.spaces)))
        return reduce(DataFrame.unionByName, entered).groupBy("space", "value").agg(
            *[F.count_if(F.col("role") == r).alias(f"n_{r}") for r in roles]
        ).drop("value")

    def violations(self, counts: DataFrame) -> DataFrame:
        """Number of rows that violate each check, by its name."""
        roles = max(map(len, self.spaces))
        once = F.element_at(F.array(*map(F.lit, self.once)), F.col("space") + 1)
        found = [F.when(once & (F.col("n_0") > 1), F.col("n_0"))]
        found += [F.when(F.col("n_0") == 0, F.col(f"n_{r}")) for r in range(1, roles)]
        summed = counts.where(reduce(or_, [f > 0 for f in found])).groupBy("space").agg(
            *[F.sum(f).alias(f"n_{r}") for r, f in enumerate(found)]
        )
        named = [
            [checks[r] if r < len(checks) else None for r in range(roles)] for checks in self.spaces
        ]

        def name(r: int, k: int) -> Column:
            words = [F.lit(checks[r][k] if checks[r] else None).cast("string") for checks in named]
            return F.element_at(F.array(*words), F.col("space") + 1)

        listed = [
            F.struct(
                name(r, 0).alias("table_name"), name(r, 1).alias("rule"), name(r, 2).alias("columns"),
                F.col(f"n_{r}").alias("n_rows"),
            )
            for r in range(roles)
        ]
        return summed.select(F.inline(F.array(*listed)))


def _counted_in_rows(name: str, df: DataFrame, schema: T.StructType, declared: Constraints) -> DataFrame:
    """NULLs in columns that must not hold any, and values outside enums, in one pass."""
    tests = [("not null", f.name, F.col(f.name).isNull()) for f in schema if not f.nullable]
    tests += [("enum", c, ~F.col(c).isin(*allowed)) for c, allowed in declared.enums]
    counts = df.agg(*[F.count_if(test).alias(f"n_{k}") for k, (_, _, test) in enumerate(tests)])
    listed = [
        F.struct(
            F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), F.lit(column).alias("columns"),
            F.col(f"n_{k}").alias("n_rows"),
        )
        for k, (rule, column, _) in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*listed)))


def constraint_violations(
    tables: Mapping[str, DataFrame],
    schemas: Mapping[str, T.StructType] = OPERATIONAL,
    constraints: Mapping[str, Constraints] = CONSTRAINTS,
) -> DataFrame:
    """Every declared constraint that is violated, with the number of rows that do.

    The keys and references of all tables are grouped once, whatever the number of
    constraints; NULLs and enums are counted in one pass over each table. Entries are counted
    map-side, so hot values are one row per task.
    """
    checks = _Checks(schemas, constraints, list(tables))
    counts = [checks.counts(tables, entries) for entries in (checks.numbers, checks.texts)]
    parts = [checks.violations(found) for found in counts if found is not None]
    parts += [_counted_in_rows(n, df, schemas[n], constraints[n]) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).where("n_rows > 0 AND table_name IS NOT NULL")


def several_current(versions: DataFrame, key: Sequence[str]) -> DataFrame:
    """Natural keys with more than one current version."""
    return duplicates(current(versions), key)


def outside_enum(
    df: DataFrame, column: str, allowed: Sequence[str] = FLIGHT_STATUSES
) -> DataFrame:
    """Values that are not among the allowed ones, with their number of rows."""
    return (
        df.where(~F.col(column).isin(*allowed))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_rows"))
    )


def airplane_intervals(flights: DataFrame) -> DataFrame:
    """When each airplane is busy: from departure to the end of its turnaround."""
    return _intervals(
        flights.select("id", F.col("airplane_id").alias("entity_id"), "departure_time")
    )


def pilot_intervals(flights: DataFrame) -> DataFrame:
    """When each pilot is busy, in either seat."""
    flown = flights.select(
        "id", "departure_time", F.explode(F.array("pilot_id", "copilot_id")).alias("entity_id")
    )
    return _intervals(flown.where(F.col("entity_id").isNotNull()))


def _intervals(rows: DataFrame) -> DataFrame:
    block = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(FLIGHT_MINUTES + TURNAROUND_MINUTES))
    return rows.select(
        "entity_id",
        "id",
        F.col("departure_time").alias("start_time"),
        (F.col("departure_time") + block).alias("end_time"),
    )


def attendance_intervals(links: DataFrame, flights: DataFrame, ref: str) -> DataFrame:
    """When each crew member or passenger is on board: departure to arrival.

    ``links`` name the flight and, in column ``ref``, the person.
    """
    times = flights.where(F.col("arrival_time").isNotNull()).select(
        F.col("id").alias("flight_id"), "departure_time", "arrival_time"
    )
    return links.join(times, "flight_id").select(
        F.col(ref).alias("entity_id"),
        "id",
        F.col("departure_time").alias("start_time"),
        F.col("arrival_time").alias("end_time"),
    )


def overlaps(intervals: DataFrame) -> DataFrame:
    """Intervals that start before an earlier one of the same entity has ended."""
    seen = running_max_before(
        intervals, "entity_id", "start_time", "id", "end_time", "busy_until"
    )
    return seen.where(F.col("busy_until") > F.col("start_time")).select(
        "entity_id", "id", "start_time", "busy_until"
    )


def discontinuities(flights: DataFrame) -> DataFrame:
    """Flights that do not leave from where their airplane last arrived."""
    legs = flights.select(
        "id", "airplane_id", "departure_time", "departure_airport_id", "arrival_airport_id"
    )
    seen = previous_values(
        legs, "airplane_id", "departure_time", "id",
        {"previous_airport_id": "arrival_airport_id"},
    )
    return seen.where(
        F.col("previous_airport_id") != F.col("departure_airport_id")
    ).select("id", "airplane_id", "previous_airport_id", "departure_airport_id")


def flight_rules() -> dict[str, Column]:
    """Conditions that make a flight violate a rule."""
    delay, low_high = F.col("delay_minutes"), DELAY_RANGE
    cancelled = F.col("status") == "cancelled"
    manned = F.col("pilot_id").isNotNull() | F.col("copilot_id").isNotNull()
    return {
        "block_time": whole_minutes(F.col("departure_time"), F.col("arrival_time"))
        != FLIGHT_MINUTES,
        "estimated_hours": F.col("estimated_flight_hours") * 60 != FLIGHT_MINUTES,
        "delay_range": (delay != 0) & ~delay.between(*low_high),
        "delay_status": ~cancelled & ((F.col("status") == "delayed") != (delay > 0)),
        "cancelled_state": cancelled
        & (F.col("arrival_time").isNotNull() | manned | F.col("is_ferry_flight")),
        "same_airport": F.col("departure_airport_id") == F.col("arrival_airport_id"),
        "same_pilot": F.col("pilot_id") == F.col("copilot_id"),
    }


def rule_violations(flights: DataFrame) -> DataFrame:
    """One row per flight and rule it violates, in one pass without shuffle."""
    broken = F.array(*[F.when(test, F.lit(rule)) for rule, test in flight_rules().items()])
    return flights.select(
        "id", F.explode(F.array_compact(broken)).alias("rule")
    )


def occupancy_violations(
    flights: DataFrame, crew: DataFrame, bookings: DataFrame
) -> DataFrame:
    """Scheduled flights with too few or too many crew members or passengers."""
    n_crew = crew.groupBy("flight_id").agg(F.count("*").alias("n_crew"))
    n_booked = bookings.groupBy("flight_id").agg(F.count("*").alias("n_passengers"))
    counted = (
        flights.where(F.col("status") == "scheduled")
        .select(F.col("id").alias("flight_id"))
        .join(n_crew, "flight_id", "left")
        .join(n_booked, "flight_id", "left")
        .na.fill(0, ["n_crew", "n_passengers"])
    )
    return counted.where(
        ~F.col("n_crew").between(*CREW_RANGE) | ~F.col("n_passengers").between(*PASSENGER_RANGE)
    )
