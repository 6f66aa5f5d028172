"""Flights and their endpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scdstar.operators.keys import latest_keys


def flight_endpoints(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """One row per flight and airport it touches.

    "Departs from or arrives at" is an either-or join condition; unfolding the two
    endpoints first turns it into a plain equi-join. A flight whose endpoints
    coincide matches once.
    """
    touched = flights.select(
        "flight_id",
        F.explode(
            F.array_distinct(F.array("departure_airport_id", "arrival_airport_id"))
        ).alias("airport_id"),
    )
    return touched.join(
        latest_keys(airports, "airport_id", "airport_sk"), "airport_id"
    ).select("flight_id", "airport_id", "airport_sk")
