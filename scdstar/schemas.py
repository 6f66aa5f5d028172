"""Declared schemas of the four namespaces.

Every reader passes one of these schemas; nothing is inferred. Ids are
``bigint``. Timestamps carry no time zone (``timestamp_ntz``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

# The namespaces, source ids, open-version marker and flight
# states that stored data uses.
AIRLINE = "airline"
WAREHOUSE = "warehouse"
CSV_STAGING = "csv_staging"
STAR = "star_schema"

SOURCE_OPERATIONAL = 1
SOURCE_CSV = 2

MAX_TIMESTAMP = "9999-12-31 23:59:59.999999"

FLIGHT_STATUSES = ("scheduled", "delayed", "cancelled")

CALENDAR_START = "1970-01-01"
CALENDAR_END = "2099-12-31"

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
}


def schema_of(columns: str) -> T.StructType:
    """Build a schema from ``name:type`` words; a trailing ``?`` allows NULL."""
    fields = []
    for word in columns.split():
        name, kind = word.split(":")
        fields.append(T.StructField(name, _TYPES[kind.rstrip("?")], kind.endswith("?")))
    return T.StructType(fields)


LINEAGE = schema_of(
    "start_date:timestamp end_date:timestamp source_id:int insert_id:int update_id:int?"
)
LINEAGE_COLUMNS = tuple(LINEAGE.names)

OPERATIONAL: dict[str, T.StructType] = {
    "pilots": schema_of("id:long name:string license_number:string"),
    "cabin_crew": schema_of("id:long name:string employee_id:string"),
    "customers": schema_of("id:long full_name:string email:string frequent_flyer:string"),
    "airports": schema_of("id:long code:string name:string city:string country:string"),
    "airplanes": schema_of(
        "id:long model:string registration_number:string"
        " fuel_consumption_per_hour:double maintenance_days:int"
    ),
    "flights": schema_of(
        "id:long flight_number:string departure_airport_id:long arrival_airport_id:long"
        " departure_time:timestamp arrival_time:timestamp? delay_minutes:int status:string"
        " pilot_id:long? copilot_id:long? airplane_id:long is_ferry_flight:boolean"
        " estimated_flight_hours:double"
    ),
    "flight_cabin_crew": schema_of("id:long flight_id:long cabin_crew_id:long"),
    "flight_bookings": schema_of("id:long flight_id:long customer_id:long seat_number:string"),
}



@dataclass(frozen=True)
class Constraints:
    """What a table declares beyond its schema, whose columns are NOT NULL unless marked.

    ``references`` maps a column to the table whose first key column it refers to,
    ``enums`` a column to the values it may have.
    """

    key: tuple[str, ...] = ("id",)
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str], ...] = ()
    enums: tuple[tuple[str, tuple[str, ...]], ...] = ()


CONSTRAINTS: dict[str, Constraints] = {
    "pilots": Constraints(),
    "cabin_crew": Constraints(),
    "customers": Constraints(),
    "airports": Constraints(),
    "airplanes": Constraints(unique=(("registration_number",),)),
    "flights": Constraints(
        references=(
            ("departure_airport_id", "airports"), ("arrival_airport_id", "airports"),
            ("pilot_id", "pilots"), ("copilot_id", "pilots"), ("airplane_id", "airplanes"),
        ),
        enums=(("status", FLIGHT_STATUSES),),
    ),
    "flight_cabin_crew": Constraints(
        references=(("flight_id", "flights"), ("cabin_crew_id", "cabin_crew"))
    ),
    "flight_bookings": Constraints(
        references=(("flight_id", "flights"), ("customer_id", "customers"))
    ),
}

STAGED_REVIEWS = schema_of(
    "flight_id:long customer_id:long seat_class:string? content:string? rating:double?"
    " recommended:boolean? seat_comfort:int? cabin_staff_service:int?"
    " food_and_beverages:int? inflight_entertainment:int? value_for_money:int?"
    " date_published:timestamp"
)

RAW_REVIEWS = schema_of(
    "airlines:string? name:string? location:string? date_published:string?"
    " text_content:string? seat_type:string? seat_comfort:string?"
    " cabin_staff_service:string? food_and_beverages:string?"
    " inflight_entertainment:string? value_for_money:string? recommended:string?"
    " ground_service:string? wifi_and_connectivity:string?"
)


def _versioned(columns: str) -> T.StructType:
    return T.StructType(schema_of(columns).fields + LINEAGE.fields)


# flights keep airplane_id and flight_bookings keep flight_id and customer_id so
# that the strict comparison can see a swapped airplane or a moved booking.
WAREHOUSE_TABLES: dict[str, T.StructType] = {
    "pilots": _versioned("pilot_sk:long pilot_id:long name:string license_number:string"),
    "cabin_crew": _versioned(
        "cabin_crew_sk:long cabin_crew_id:long name:string employee_id:string"
    ),
    "customers": _versioned(
        "customer_sk:long customer_id:long full_name:string email:string frequent_flyer:string"
    ),
    "airports": _versioned(
        "airport_sk:long airport_id:long code:string name:string city:string country:string"
    ),
    "airplanes": _versioned(
        "airplane_sk:long airplane_id:long model:string registration_number:string"
        " fuel_consumption_per_hour:double maintenance_days:int"
    ),
    "flights": _versioned(
        "flight_sk:long flight_id:long flight_number:string departure_airport_sk:long"
        " departure_airport_id:long arrival_airport_sk:long arrival_airport_id:long"
        " departure_time:timestamp arrival_time:timestamp? delay_minutes:int status:string"
        " pilot_sk:long pilot_id:long copilot_sk:long copilot_id:long airplane_sk:long"
        " airplane_id:long is_ferry_flight:boolean estimated_flight_hours:double"
    ),
    "flight_cabin_crew": _versioned(
        "flight_cabin_crew_sk:long flight_cabin_crew_id:long flight_sk:long flight_id:long"
        " cabin_crew_sk:long cabin_crew_id:long"
    ),
    "flight_bookings": _versioned(
        "flight_booking_sk:long flight_booking_id:long flight_sk:long flight_id:long"
        " customer_sk:long customer_id:long seat_number:string"
    ),
    "airline_reviews": _versioned(
        "airline_review_sk:long flight_sk:long flight_id:long customer_sk:long"
        " customer_id:long seat_class:string? content:string? rating:double?"
        " recommended:boolean? seat_comfort:int? cabin_staff_service:int?"
        " food_and_beverages:int? inflight_entertainment:int? value_for_money:int?"
        " date_published:timestamp"
    ),
}

STAR_TABLES: dict[str, T.StructType] = {
    "dim_airport": schema_of("airport_sk:long code:string name:string city:string country:string"),
    "dim_airplane": schema_of(
        "airplane_sk:long model:string registration_number:string"
        " fuel_consumption_per_hour:double maintenance_days:int"
    ),
    "dim_pilot": schema_of("pilot_sk:long name:string license_number:string"),
    "dim_customer": schema_of(
        "customer_sk:long full_name:string email:string frequent_flyer:string"
    ),
    "dim_flight": schema_of(
        "flight_sk:long flight_number:string departure_airport_sk:long"
        " arrival_airport_sk:long departure_datetime:timestamp arrival_datetime:timestamp?"
        " airplane_sk:long pilot_sk:long copilot_sk:long status:string is_ferry_flight:boolean"
    ),
    "dim_date": schema_of("date_sk:int date:timestamp day:int month:int year:int weekday:string"),
    "fact_flight": schema_of(
        "flight_sk:long departure_date_sk:int arrival_date_sk:int delay_minutes:int"
        " estimated_flight_hours:double is_ferry_flight:boolean"
    ),
    "fact_booking": schema_of(
        "flight_booking_sk:long flight_sk:long customer_sk:long seat_number:string"
    ),
    "fact_review": schema_of(
        "airline_review_sk:long flight_sk:long customer_sk:long seat_class:string?"
        " rating:double? recommended:boolean? seat_comfort:int? cabin_staff_service:int?"
        " food_and_beverages:int? inflight_entertainment:int? value_for_money:int?"
        " date_published_sk:int"
    ),
}


WAREHOUSE_CONSTRAINTS: dict[str, Constraints] = {
    "pilots": Constraints(("pilot_sk",)),
    "cabin_crew": Constraints(("cabin_crew_sk",)),
    "customers": Constraints(("customer_sk",)),
    "airports": Constraints(("airport_sk",)),
    "airplanes": Constraints(("airplane_sk",)),
    "flights": Constraints(
        ("flight_sk",),
        references=(
            ("departure_airport_sk", "airports"), ("arrival_airport_sk", "airports"),
            ("pilot_sk", "pilots"), ("copilot_sk", "pilots"), ("airplane_sk", "airplanes"),
        ),
        enums=(("status", FLIGHT_STATUSES),),
    ),
    "flight_cabin_crew": Constraints(
        ("flight_cabin_crew_sk",),
        references=(("flight_sk", "flights"), ("cabin_crew_sk", "cabin_crew")),
    ),
    "flight_bookings": Constraints(
        ("flight_booking_sk",),
        references=(("flight_sk", "flights"), ("customer_sk", "customers")),
    ),
    "airline_reviews": Constraints(
        ("airline_review_sk",),
        references=(("flight_sk", "flights"), ("customer_sk", "customers")),
    ),
}

STAR_CONSTRAINTS: dict[str, Constraints] = {
    "dim_airport": Constraints(("airport_sk",)),
    "dim_airplane": Constraints(("airplane_sk",)),
    "dim_pilot": Constraints(("pilot_sk",)),
    "dim_customer": Constraints(("customer_sk",)),
    "dim_flight": Constraints(
        ("flight_sk",),
        references=(
            ("departure_airport_sk", "dim_airport"), ("arrival_airport_sk", "dim_airport"),
            ("airplane_sk", "dim_airplane"), ("pilot_sk", "dim_pilot"), ("copilot_sk", "dim_pilot"),
        ),
        enums=(("status", FLIGHT_STATUSES),),
    ),
    "dim_date": Constraints(("date_sk",)),
    "fact_flight": Constraints(
        ("flight_sk",),
        references=(
            ("flight_sk", "dim_flight"), ("departure_date_sk", "dim_date"),
            ("arrival_date_sk", "dim_date"),
        ),
    ),
    "fact_booking": Constraints(
        ("flight_booking_sk",),
        references=(("flight_sk", "dim_flight"), ("customer_sk", "dim_customer")),
    ),
    "fact_review": Constraints(
        ("airline_review_sk",),
        references=(
            ("flight_sk", "dim_flight"), ("customer_sk", "dim_customer"),
            ("date_published_sk", "dim_date"),
        ),
    ),
}


def timestamp(value: str) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(value).cast("timestamp_ntz")


def max_timestamp() -> Column:
    """End date of an open version."""
    return timestamp(MAX_TIMESTAMP)
