"""The nine warehouse tables, in load order: referred tables come first."""

from __future__ import annotations

from collections.abc import Iterable

from scdstar.operators.lookup import Lookup
from scdstar.operators.scd2 import TableSpec
from scdstar.schemas import OPERATIONAL, SOURCE_CSV, SOURCE_OPERATIONAL, STAGED_REVIEWS


def _airport(role: str) -> Lookup:
    return Lookup(f"{role}_airport_id", "airports", "airport_id", "airport_sk",
                  f"{role}_airport_sk")


def _pilot(role: str) -> Lookup:
    return Lookup(f"{role}_id", "pilots", "pilot_id", "pilot_sk", f"{role}_sk")


_AIRPLANE = Lookup("airplane_id", "airplanes", "airplane_id", "airplane_sk", "airplane_sk")
_CREW = Lookup("cabin_crew_id", "cabin_crew", "cabin_crew_id", "cabin_crew_sk", "cabin_crew_sk")
_FLIGHT = Lookup("flight_id", "flights", "flight_id", "flight_sk", "flight_sk")
_CUSTOMER = Lookup("customer_id", "customers", "customer_id", "customer_sk", "customer_sk")


def _operational(
    name: str,
    entity: str,
    lookups: tuple[Lookup, ...] = (),
    unseen: tuple[str, ...] = (),
) -> TableSpec:
    """Spec of an operational table; ``unseen`` columns are compared in strict mode only."""
    natural = f"{entity}_id"
    rest = tuple(c for c in OPERATIONAL[name].names if c != "id")
    return TableSpec(
        name=name,
        sk=f"{entity}_sk",
        key=(natural,),
        columns=(natural, *rest),
        compare=tuple(c for c in rest if c not in unseen),
        source_id=SOURCE_OPERATIONAL,
        rename=(("id", natural),),
        lookups=lookups,
        strict_compare=unseen,
    )


_REVIEW_KEY = ("flight_id", "customer_id", "date_published")

SPECS: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _operational("pilots", "pilot"),
        _operational("cabin_crew", "cabin_crew"),
        _operational("customers", "customer"),
        _operational("airports", "airport"),
        _operational("airplanes", "airplane"),
        _operational(
            "flights",
            "flight",
            (_airport("departure"), _airport("arrival"), _pilot("pilot"), _pilot("copilot"),
             _AIRPLANE),
            unseen=("airplane_id",),
        ),
        _operational("flight_cabin_crew", "flight_cabin_crew", (_CREW, _FLIGHT)),
        _operational(
            "flight_bookings",
            "flight_booking",
            (_FLIGHT, _CUSTOMER),
            unseen=("flight_id", "customer_id"),
        ),
        TableSpec(
            name="airline_reviews",
            sk="airline_review_sk",
            key=_REVIEW_KEY,
            columns=tuple(STAGED_REVIEWS.names),
            compare=tuple(c for c in STAGED_REVIEWS.names if c not in _REVIEW_KEY),
            source_id=SOURCE_CSV,
            lookups=(_FLIGHT, _CUSTOMER),
            unique_source=False,
        ),
    )
}

REVIEWS = SPECS["airline_reviews"]


def waves(names: Iterable[str]) -> list[list[TableSpec]]:
    """Sets of tables that can be loaded side by side, each after those it refers to."""
    left, found = [SPECS[n] for n in SPECS if n in set(names)], []
    while left:
        waiting = {spec.name for spec in left}
        ready = [s for s in left if not waiting & {look.table for look in s.lookups}]
        found.append(ready)
        left = [s for s in left if s not in ready]
    return found
