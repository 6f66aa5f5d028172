"""One query per operator, over the test tables.

Results hold no raw end dates (``is_current`` instead); an open ``update_id`` is 0.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scdstar.functions.columns import hours, whole_minutes
from scdstar.operators import audit, lineage
from scdstar.operators.bridge import flight_endpoints
from scdstar.operators.keys import latest_versions, max_key
from scdstar.operators.lookup import resolve
from scdstar.operators.rows import insert_absent
from scdstar.operators.scd2 import CLOSES, LoadOptions, detect_changes, project_source
from scdstar.plans import analytics, star as star_plan
from scdstar.plans.frames import Warehouse, load_table
from scdstar.plans.specs import REVIEWS, SPECS
from scdstar.plans.star import KEYS, STAR_SOURCES, build_star, delete_expired, refresh_star
from scdstar.plans.two_batches import two_batches
from scdstar.schemas import (
    OPERATIONAL, STAR_CONSTRAINTS, STAR_TABLES, WAREHOUSE_CONSTRAINTS, WAREHOUSE_TABLES, max_timestamp,
)
from scdstar.session import shared_folder, stage
from scdstar.sources.catalog import (
    append_by_name, create_namespace, ensure_namespace, insert_select, truncate_namespace,
)
from scdstar.sources.operational import read_parquet
from scdstar.sources.reviews import (
    cleanse_reviews, read_raw_reviews, read_staged_reviews, staged_reviews, write_raw_reviews,
    write_reviews,
)
from scdstar.sources.testdata import LOAD_TS, raw_reviews, snapshot, snapshot_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def shown(versions: DataFrame) -> DataFrame:
    """Versions in a form that any client can read."""
    return versions.withColumns(
        {
            "is_current": lineage.is_current(),
            "update_id": F.coalesce("update_id", F.lit(0)),
        }
    ).drop("end_date")


def _content(df: DataFrame) -> Column:
    """All columns of a row as one text."""
    texts = [
        F.col(f.name).cast("decimal(18,6)" if f.dataType == T.DoubleType() else f.dataType)
        .cast("string")
        for f in df.schema
    ]
    return F.concat_ws("|", *[F.coalesce(text, F.lit("~")) for text in texts])


def rows_of(tables: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """Table name, surrogate key and content of every row of several star tables."""
    parts = [
        df.select(
            F.lit(name).alias("table_name"), F.col(KEYS[name]).alias("sk"),
            _content(df).alias("content"),
        )
        for name, df in tables
    ]
    return reduce(DataFrame.unionByName, parts)


# -- projections, filters, stamps --------------------------------------------------


@query
def project_rename(spark: SparkSession, folder: str) -> DataFrame:
    return project_source(snapshot_table(spark, folder, "pilots"), SPECS["pilots"])


@query
def filter_status(spark: SparkSession, folder: str) -> DataFrame:
    flights = snapshot_table(spark, folder, "flights")
    return flights.where(F.col("status") == "scheduled").select(
        F.col("id").alias("flight_id"), "arrival_time"
    )


@query
def max_key_customers(spark: SparkSession, folder: str) -> DataFrame:
    return max_key(snapshot_table(spark, folder, "customers", 2), "id")


@query
def lineage_stamp(spark: SparkSession, folder: str) -> DataFrame:
    spec = SPECS["customers"]
    rows = project_source(snapshot_table(spark, folder, spec.name), spec)
    return shown(lineage.stamp_inserted(rows, 1, spec.source_id, LOAD_TS[1]))


@query
def flight_durations(spark: SparkSession, folder: str) -> DataFrame:
    flights = snapshot_table(spark, folder, "flights", 2)
    span = F.col("departure_time"), F.col("arrival_time")
    return flights.where(F.col("arrival_time").isNotNull()).select(
        F.col("id").alias("flight_id"),
        whole_minutes(*span).alias("minutes"),
        F.round(hours(*span), 6).alias("hours"),
    )


@query
def review_cleanse(spark: SparkSession, folder: str) -> DataFrame:
    return cleanse_reviews(raw_reviews(spark, folder)).withColumn(
        "rating", F.round("rating", 6)
    ).withColumn("source_date", F.date_format("source_date", "yyyy-MM-dd"))


@query
def review_csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The reviews of batch 2 after being written to and read from CSV files."""
    path = f"{shared_folder(spark)}/scdstar/{uuid.uuid4().hex}/reviews"
    write_reviews(snapshot_table(spark, folder, "airline_reviews", 2), path)
    return read_staged_reviews(spark, path)


@query
def review_raw_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Raw review files, cut into ranges, cleansed, staged and loaded as versions.

    The location of a raw review names its event, and its name the customer.
    """
    path = f"{shared_folder(spark)}/scdstar/{uuid.uuid4().hex}/raw-reviews"
    raw = raw_reviews(spark, folder).withColumn("location", F.col("event_id").cast("string"))
    write_raw_reviews(raw, path)
    flights = spark.read.parquet(f"{folder}/orders.parquet").agg(F.max("o_orderkey") + 1).scalar()
    named = read_raw_reviews(spark, path, split=True).withColumns(
        {"flight_id": F.col("location").cast("long") % flights,
         "customer_id": F.regexp_extract("name", r"(\d+)", 1).cast("long")}
    )
    cleansed = cleanse_reviews(named).withColumns(
        {"seat_class": F.col("seat_type"), "date_published": F.col("source_date").cast("timestamp_ntz")}
    )
    referred = two_batches(spark, folder).warehouse(1, *[look.table for look in REVIEWS.lookups])
    done = load_table(
        REVIEWS, staged_reviews(cleansed), Warehouse(), referred.copy(), 1,
        LOAD_TS[1], stage=stage,
    )
    found = done.inserted.select(*WAREHOUSE_TABLES[REVIEWS.name].names)
    return shown(found.withColumn("rating", F.round("rating", 6)))


@query
def source_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """Airplanes written as a source and read with their declared schema."""
    path = f"{shared_folder(spark)}/scdstar/{uuid.uuid4().hex}"
    tables, _ = snapshot(spark, folder, 1)
    tables["airplanes"].write.parquet(f"{path}/airplanes")
    return read_parquet(spark, path, ["airplanes"])["airplanes"]


def _ddl_namespace(spark: SparkSession) -> str:
    name = f"scdstar_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, name, shared_folder(spark))
    return name


@query
def insert_select_pilots(spark: SparkSession, folder: str) -> DataFrame:
    """Pilots appended to a catalog table as newly opened versions, by column name."""
    name = _ddl_namespace(spark)
    ensure_namespace(spark, name, {"pilots": WAREHOUSE_TABLES["pilots"]})
    spec = SPECS["pilots"]
    rows = project_source(snapshot_table(spark, folder, spec.name), spec)
    select = rows.select(*reversed(rows.columns), (F.col("pilot_id") + 1).alias("pilot_sk"))
    insert_select(select, f"{name}.pilots", 1, spec.source_id, LOAD_TS[1])
    return shown(spark.table(f"{name}.pilots"))


@query
def truncated_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the tables of a namespace before and after it is emptied."""
    name, tables = _ddl_namespace(spark), ("pilots", "airplanes")
    ensure_namespace(spark, name, {t: OPERATIONAL[t] for t in tables})

    def counted(column: str) -> DataFrame:
        parts = [spark.table(f"{name}.{t}").agg(F.count("*").alias(column)).withColumn("table_name", F.lit(t))
                 for t in tables]
        return stage(reduce(DataFrame.unionByName, parts), f"{name}-{column}")

    for table in tables:
        append_by_name(snapshot_table(spark, folder, table), f"{name}.{table}")
    before = counted("n_before")
    truncate_namespace(spark, name)
    return before.join(counted("n_after"), "table_name")


# -- key resolution ----------------------------------------------------------------


def _resolved(table: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        """Batch 1 rows with the surrogate keys they refer to."""
        spec, loads = SPECS[table], two_batches(spark, folder)
        rows = project_source(loads.source(table, 1), spec)
        return resolve(rows, spec.lookups, lambda name: loads.versions(name, 1))

    return run


QUERIES["resolve_flights"] = _resolved("flights")
QUERIES["resolve_crew_bridge"] = _resolved("flight_cabin_crew")
QUERIES["resolve_bookings"] = _resolved("flight_bookings")
QUERIES["resolve_reviews"] = _resolved("airline_reviews")


@query
def flight_endpoint_bridge(spark: SparkSession, folder: str) -> DataFrame:
    loads = two_batches(spark, folder)
    flights = project_source(loads.source("flights", 2), SPECS["flights"])
    return flight_endpoints(flights, loads.versions("airports"))


# -- change detection and versions -------------------------------------------------


def _changes(table: str, options: LoadOptions = LoadOptions()) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        """Keys of the batch 2 rows that get a new version, with the version closed."""
        spec, loads = SPECS[table], two_batches(spark, folder)
        before = loads.warehouse(1, table).current[table]
        source = project_source(loads.source(table, 2), spec)
        return detect_changes(before, source, spec, options).select(
            *spec.key,
            F.col(CLOSES).isNull().alias("is_new"),
            F.coalesce(CLOSES, F.lit(0)).alias("closes"),
        )

    return run


QUERIES["diff_changed_keys"] = _changes("customers")
QUERIES["diff_reviews"] = _changes("airline_reviews")
QUERIES["diff_null_safe"] = _changes("airline_reviews", LoadOptions(null_safe=True))
QUERIES["diff_strict_flights"] = _changes("flights", LoadOptions(strict=True))
QUERIES["diff_strict_bookings"] = _changes("flight_bookings", LoadOptions(strict=True))


def _closed(table: str) -> Query:
    return lambda spark, folder: shown(
        two_batches(spark, folder).warehouse(2, table).history[table]
    )


def _inserted(table: str) -> Query:
    return lambda spark, folder: shown(
        two_batches(spark, folder).done(table, 2).inserted.select(*WAREHOUSE_TABLES[table].names)
    )


def _versions(table: str) -> Query:
    return lambda spark, folder: shown(two_batches(spark, folder).versions(table))


QUERIES["scd2_close"] = _closed("flights")
QUERIES["scd2_insert"] = _inserted("customers")
for _table in SPECS:
    QUERIES["scd2_" + _table.replace("flight_bookings", "bookings").replace(
        "airline_reviews", "reviews")] = _versions(_table)


@query
def scd2_close_missing(spark: SparkSession, folder: str) -> DataFrame:
    done = two_batches(spark, folder).merge("customers", 2, LoadOptions(close_missing=True))
    return shown(done.versions())


@query
def scd2_current(spark: SparkSession, folder: str) -> DataFrame:
    return shown(lineage.current(two_batches(spark, folder).versions("customers")))


@query
def scd2_as_of(spark: SparkSession, folder: str) -> DataFrame:
    versions = two_batches(spark, folder).versions("flights")
    return shown(lineage.as_of(versions, "2024-06-01 12:00:00"))


@query
def scd2_as_of_later(spark: SparkSession, folder: str) -> DataFrame:
    """The flights valid after the second batch."""
    versions = two_batches(spark, folder).versions("flights")
    return shown(lineage.as_of(versions, "2024-06-02 12:00:00"))


@query
def scd2_latest(spark: SparkSession, folder: str) -> DataFrame:
    versions = two_batches(spark, folder).versions("flights")
    return shown(latest_versions(versions, ["flight_id"], "flight_sk"))


@query
def lineage_counts(spark: SparkSession, folder: str) -> DataFrame:
    loads = two_batches(spark, folder)
    parts = [
        lineage.lineage_counts(loads.versions(name)).select(
            F.lit(name).alias("table_name"), "insert_id",
            F.coalesce("update_id", F.lit(0)).alias("update_id"), "source_id", "n_rows",
        )
        for name in SPECS
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def load_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows inserted, closed and left unresolved by batch 2, by table."""
    loads = two_batches(spark, folder)
    parts = []
    for name in SPECS:
        changed = loads.done(name, 2).changes.agg(
            F.lit(0).cast("long").alias("n_inserted"),
            F.count(CLOSES).alias("n_closed"),
            F.count("*").alias("n_changed"),
        )
        added = loads.warehouse(2, name).current[name].agg(
            F.count_if(F.col("insert_id") == 2).alias("n_inserted"),
            F.lit(0).cast("long").alias("n_closed"),
            F.lit(0).cast("long").alias("n_changed"),
        )
        parts.append(changed.unionByName(added).withColumn("table_name", F.lit(name)))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("table_name")
        .agg(
            F.sum("n_inserted").alias("n_inserted"),
            F.sum("n_closed").alias("n_closed"),
            (F.sum("n_changed") - F.sum("n_inserted")).alias("n_unresolved"),
        )
    )


# -- star --------------------------------------------------------------------------


def _star(table: str) -> Query:
    return lambda spark, folder: two_batches(spark, folder).star()[table]


for _table in KEYS:
    QUERIES[_table] = _star(_table)


@query
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar with the number of flights departing each day, found by date."""
    flights = snapshot_table(spark, folder, "flights", 2)
    departures = flights.groupBy(F.to_date("departure_time").alias("_day")).agg(
        F.count("*").alias("n_departures")
    )
    calendar = star_plan.dim_date(spark)
    return (
        calendar.join(departures, F.to_date("date") == F.col("_day"), "left")
        .drop("_day")
        .na.fill(0, ["n_departures"])
    )


@query
def star_delete_expired(spark: SparkSession, folder: str) -> DataFrame:
    """The booking facts of batch 1 without those closed in batch 2."""
    loads = two_batches(spark, folder)
    expired = loads.warehouse(2, "flight_bookings").expired("flight_bookings")
    return delete_expired(loads.star(1)["fact_booking"], expired, KEYS["fact_booking"])


@query
def star_insert_absent(spark: SparkSession, folder: str) -> DataFrame:
    """The customers of batch 1 plus the current ones they lack."""
    loads = two_batches(spark, folder)
    return insert_absent(
        loads.star(1)["dim_customer"],
        star_plan.dim_customer(loads.warehouse(2, "customers").current["customers"]),
        KEYS["dim_customer"],
    )


@query
def star_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of the batch 1 star brought up to date."""
    loads = two_batches(spark, folder)

    def keep(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Flights and customers are written, as other tables refer to them."""
        referred = ("dim_flight", "dim_customer")
        return {n: stage(df, n) if n in referred else df for n, df in tables.items()}

    fresh = refresh_star(loads.star(1), loads.warehouse(2, *STAR_SOURCES), since=2, keep=keep)
    return rows_of((name, fresh[name]) for name in KEYS)


@query
def star_all_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of a star built over all versions."""
    star = build_star(spark, two_batches(spark, folder).warehouse(2, *STAR_SOURCES), mode="all")
    return rows_of((name, star[name]) for name in KEYS)


# -- batches -----------------------------------------------------------------------


def _published(table: str) -> Query:
    """A warehouse table as the batches published it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        runner = two_batches(spark, folder).pipeline()
        return shown(spark.table(f"{runner.names.warehouse}.{table}"))

    return run


QUERIES["batch_flights"] = _published("flights")
QUERIES["batch_reviews_streamed"] = _published("airline_reviews")


@query
def batch_star(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of the star tables as the batches published them."""
    runner = two_batches(spark, folder).pipeline()
    return rows_of((name, spark.table(f"{runner.names.star}.{name}")) for name in KEYS)


@query
def batch_report(spark: SparkSession, folder: str) -> DataFrame:
    """What the batches reported about the warehouse tables."""
    runner = two_batches(spark, folder).pipeline()
    return runner.audit().where(F.col("namespace") == runner.names.warehouse).select(
        "batch_id", "table_name", "inserted", "closed", "unresolved", "status"
    )


@query
def batch_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """Customers after a batch that failed late and a batch without them."""
    runner = two_batches(spark, folder).after_failure()
    return shown(spark.table(f"{runner.names.warehouse}.customers"))


@query
def batch_two_streams(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews that came by two streams with checkpoints of their own."""
    runner = two_batches(spark, folder).streamed_in_two(False)
    reviews = spark.table(f"{runner.names.warehouse}.airline_reviews")
    return reviews.select("flight_id", "customer_id", "date_published", "rating", "content")


@query
def batch_close_missing_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews that are all there already, after streams of some of them each."""
    loads = two_batches(spark, folder)
    runner = loads.streamed_in_two(True, LoadOptions(close_missing=True))
    return shown(spark.table(f"{runner.names.warehouse}.airline_reviews"))


@query
def batch_timed(spark: SparkSession, folder: str) -> DataFrame:
    """Airports after a timed load that found no review files."""
    return shown(spark.table(
        f"{two_batches(spark, folder).timed().names.warehouse}.airports"
    ))


# -- audits ------------------------------------------------------------------------


def _flights(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot_table(spark, folder, "flights", 2)


@query
def audit_not_null(spark: SparkSession, folder: str) -> DataFrame:
    flights = _flights(spark, folder)
    return audit.null_counts(flights, flights.columns)


@query
def audit_constraints(spark: SparkSession, folder: str) -> DataFrame:
    """All declared constraints of a snapshot with rows that break each kind."""
    tables, _ = snapshot(spark, folder, 2)
    row = F.col("id")

    def broken(column: str, every: int, value: Column) -> Column:
        return F.when(row % every == 0, value).otherwise(F.col(column))

    tables["pilots"] = tables["pilots"].unionByName(tables["pilots"].where(row % 3 == 0))
    tables["customers"] = tables["customers"].withColumn(
        "email", broken("email", 7, F.lit(None).cast("string")))
    tables["airplanes"] = tables["airplanes"].withColumn(
        "registration_number", broken("registration_number", 50, F.lit("REG-0")))
    tables["flights"] = tables["flights"].withColumns(
        {"airplane_id": broken("airplane_id", 11, F.lit(-1).cast("long")),
         "status": broken("status", 13, F.lit("lost"))})
    return audit.constraint_violations(tables)


@query
def audit_unique(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return audit.duplicates(lines, ["l_orderkey", "l_linenumber"])


@query
def audit_warehouse(spark: SparkSession, folder: str) -> DataFrame:
    """All constraints of warehouse and star, with rows that break each kind."""
    loads = two_batches(spark, folder)
    star, warehouse = dict(loads.star()), loads.warehouse(2)
    tables = {name: warehouse.versions(name) for name in SPECS}
    tables["pilots"] = tables["pilots"].where("pilot_id % 7 <> 0")
    star["dim_airport"] = star["dim_airport"].unionByName(
        star["dim_airport"].where("airport_sk % 2 = 0"))
    star["fact_booking"] = star["fact_booking"].withColumn(
        "seat_number", F.expr("CASE WHEN flight_booking_sk % 5 <> 0 THEN seat_number END"))
    star["dim_flight"] = star["dim_flight"].withColumn(
        "status", F.expr("CASE WHEN flight_sk % 3 = 0 THEN 'lost' ELSE status END"))
    star["dim_date"] = star["dim_date"].where("year < 1998")
    return audit.constraint_violations(
        tables | star, WAREHOUSE_TABLES | STAR_TABLES, WAREHOUSE_CONSTRAINTS | STAR_CONSTRAINTS
    )


@query
def audit_unique_registration(spark: SparkSession, folder: str) -> DataFrame:
    """Registration numbers that occur more than once, some of them repeated by rule."""
    airplanes = snapshot_table(spark, folder, "airplanes", 2)
    return audit.duplicates(
        airplanes.unionByName(airplanes.where("id % 4 = 0")), ["registration_number"]
    )


@query
def audit_fk(spark: SparkSession, folder: str) -> DataFrame:
    """Flights that bookings name but the warehouse never got."""
    loads = two_batches(spark, folder)
    return audit.dangling(
        loads.source("flight_bookings", 2), "flight_id", loads.versions("flights"), "flight_id"
    )


@query
def audit_single_current(spark: SparkSession, folder: str) -> DataFrame:
    """Flights with several current versions, after some closed versions are opened again."""
    versions = two_batches(spark, folder).versions("flights")
    opened = F.when(F.col("flight_id") % 2 == 0, max_timestamp()).otherwise(F.col("end_date"))
    return audit.several_current(versions.withColumn("end_date", opened), ["flight_id"])


@query
def audit_enum(spark: SparkSession, folder: str) -> DataFrame:
    """Order states that are no flight states."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return audit.outside_enum(orders, "o_orderstatus")


@query
def audit_schedule_conflict(spark: SparkSession, folder: str) -> DataFrame:
    return audit.overlaps(audit.airplane_intervals(_flights(spark, folder)))


@query
def audit_pilot_conflict(spark: SparkSession, folder: str) -> DataFrame:
    return audit.overlaps(audit.pilot_intervals(_flights(spark, folder)))


def _attendance_conflicts(links: str, ref: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        """The joined intervals are looked at more than once, so they are staged."""
        attended = audit.attendance_intervals(
            snapshot_table(spark, folder, links, 2), _flights(spark, folder), ref
        )
        return audit.overlaps(stage(attended, f"{links}_intervals"))

    return run


QUERIES["audit_crew_conflict"] = _attendance_conflicts("flight_cabin_crew", "cabin_crew_id")
QUERIES["audit_passenger_conflict"] = _attendance_conflicts("flight_bookings", "customer_id")


@query
def audit_continuity(spark: SparkSession, folder: str) -> DataFrame:
    return audit.discontinuities(_flights(spark, folder))


@query
def audit_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that flights break, some of them by changes that break one rule each."""
    row = F.col("id")
    flights = _flights(spark, folder).withColumns(
        {"arrival_time": F.when(row % 23 == 0, F.expr("arrival_time + INTERVAL '5' MINUTE"))
                          .otherwise(F.col("arrival_time")),
         "estimated_flight_hours": F.when(row % 29 == 0, 4.0).otherwise(F.col("estimated_flight_hours")),
         "arrival_airport_id": F.when(row % 31 == 0, F.col("departure_airport_id"))
                                .otherwise(F.col("arrival_airport_id")),
         "copilot_id": F.when(row % 37 == 0, F.col("pilot_id")).otherwise(F.col("copilot_id")),
         "is_ferry_flight": F.col("is_ferry_flight") | (row % 41 == 0)}
    )
    return audit.rule_violations(flights)


@query
def audit_occupancy(spark: SparkSession, folder: str) -> DataFrame:
    return audit.occupancy_violations(
        _flights(spark, folder),
        snapshot_table(spark, folder, "flight_cabin_crew", 2),
        snapshot_table(spark, folder, "flight_bookings", 2),
    )


# -- reports -----------------------------------------------------------------------


@query
def q_delay_by_airport(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.delay_by_airport(two_batches(spark, folder).star())


@query
def q_bookings_by_route(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.bookings_by_route(two_batches(spark, folder).star())


@query
def q_ratings_by_class(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.ratings_by_class(two_batches(spark, folder).star())


@query
def q_frequent_flyer(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.by_frequent_flyer(two_batches(spark, folder).star())


@query
def q_fuel_by_model(spark: SparkSession, folder: str) -> DataFrame:
    return analytics.fuel_by_model(two_batches(spark, folder).star())
