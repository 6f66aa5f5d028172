"""Reports over the star.

Each one aggregates the fact by its keys first (map-side combined, so hot keys do
not matter) and joins descriptions to the few rows that are left.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

Star = Mapping[str, DataFrame]


def delay_by_airport(star: Star) -> DataFrame:
    """Delays by departure airport and month."""
    days = (
        star["fact_flight"]
        .join(star["dim_flight"].select("flight_sk", "departure_airport_sk"), "flight_sk")
        .groupBy("departure_airport_sk", "departure_date_sk")
        .agg(
            F.count("*").alias("_n"),
            F.sum("delay_minutes").alias("_delay"),
            F.max("delay_minutes").alias("_worst"),
            F.sum((F.col("delay_minutes") > 0).cast("int")).alias("_late"),
        )
    )
    # The calendar has a fixed number of rows (one per day of 130 years).
    calendar = F.broadcast(
        star["dim_date"].select(F.col("date_sk").alias("departure_date_sk"), "year", "month")
    )
    airports = star["dim_airport"].select(
        F.col("airport_sk").alias("departure_airport_sk"),
        F.col("code").alias("airport_code"),
    )
    return (
        days.join(calendar, "departure_date_sk")
        .groupBy("departure_airport_sk", "year", "month")
        .agg(
            F.sum("_n").alias("_n"),
            F.sum("_delay").alias("_delay"),
            F.max("_worst").alias("_worst"),
            F.sum("_late").alias("_late"),
        )
        .join(airports, "departure_airport_sk")
        .groupBy("airport_code", "year", "month")
        .agg(
            F.sum("_n").alias("n_flights"),
            F.sum("_late").alias("n_delayed"),
            F.round(F.sum("_delay") / F.sum("_n"), 6).alias("avg_delay"),
            F.max("_worst").alias("max_delay"),
        )
    )


def bookings_by_route(star: Star) -> DataFrame:
    """Bookings and flights booked, by route."""
    per_flight = star["fact_booking"].groupBy("flight_sk").agg(F.count("*").alias("_n"))
    routes = star["dim_flight"].select(
        "flight_sk", "departure_airport_sk", "arrival_airport_sk"
    )
    ends = {
        role: star["dim_airport"].select(
            F.col("airport_sk").alias(f"{role}_airport_sk"), F.col("code").alias(f"{role}_code")
        )
        for role in ("departure", "arrival")
    }
    return (
        per_flight.join(routes, "flight_sk")
        .groupBy("departure_airport_sk", "arrival_airport_sk")
        .agg(F.sum("_n").alias("_n"), F.count("*").alias("_flights"))
        .join(ends["departure"], "departure_airport_sk")
        .join(ends["arrival"], "arrival_airport_sk")
        .groupBy("departure_code", "arrival_code")
        .agg(F.sum("_n").alias("n_bookings"), F.sum("_flights").alias("n_flights"))
    )


def ratings_by_class(star: Star) -> DataFrame:
    """Ratings and the share of recommending reviews, by seat class."""
    return star["fact_review"].groupBy("seat_class").agg(
        F.count("*").alias("n_reviews"),
        F.round(F.avg("rating"), 6).alias("avg_rating"),
        F.round(F.avg(F.col("recommended").cast("int")), 6).alias("recommend_share"),
        F.round(F.avg("seat_comfort"), 6).alias("avg_seat_comfort"),
    )


def by_frequent_flyer(star: Star) -> DataFrame:
    """Bookings and ratings of frequent flyers against the others."""
    groups = star["dim_customer"].select("customer_sk", "frequent_flyer")
    booked = star["fact_booking"].groupBy("customer_sk").agg(F.count("*").alias("_n"))
    rated = (
        star["fact_review"]
        .groupBy("customer_sk")
        .agg(F.count("*").alias("_n"), F.sum("rating").alias("_rating"))
    )
    bookings = (
        booked.join(groups, "customer_sk")
        .groupBy("frequent_flyer")
        .agg(F.sum("_n").alias("n_bookings"), F.count("*").alias("n_customers_booked"))
    )
    reviews = (
        rated.join(groups, "customer_sk")
        .groupBy("frequent_flyer")
        .agg(
            F.sum("_n").alias("n_reviews"),
            F.round(F.sum("_rating") / F.sum("_n"), 6).alias("avg_rating"),
        )
    )
    return bookings.join(reviews, "frequent_flyer", "full_outer")


def fuel_by_model(star: Star) -> DataFrame:
    """Fuel used by airplane model: hours flown times hourly consumption."""
    per_plane = (
        star["fact_flight"]
        .join(star["dim_flight"].select("flight_sk", "airplane_sk"), "flight_sk")
        .groupBy("airplane_sk")
        .agg(F.count("*").alias("_n"), F.sum("estimated_flight_hours").alias("_hours"))
    )
    planes = star["dim_airplane"].select("airplane_sk", "model", "fuel_consumption_per_hour")
    return (
        per_plane.join(planes, "airplane_sk")
        .groupBy("model")
        .agg(
            F.sum("_n").alias("n_flights"),
            F.round(F.sum("_hours"), 6).alias("flight_hours"),
            F.round(F.sum(F.col("_hours") * F.col("fuel_consumption_per_hour")), 6).alias("fuel"),
        )
    )
