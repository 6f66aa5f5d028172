from datetime import datetime, timedelta

from scdstar.operators import audit
from scdstar.operators.bridge import flight_endpoints
from scdstar.operators.rows import append_absent, delete_matching, insert_absent
from scdstar.schemas import OPERATIONAL, schema_of

from conftest import rows

T0 = datetime(2024, 1, 1)


def flight(i, start=0.0, plane=1, dep=1, arr=2, delay=0, status="scheduled", pilots=(1, 2),
           ferry=False, hours=3.5, length=210):
    leave = T0 + timedelta(hours=start)
    arrive = None if status == "cancelled" else leave + timedelta(minutes=length)
    if status == "cancelled":
        pilots = (None, None)
    return (i, f"F{i}", dep, arr, leave, arrive, delay, status, *pilots, plane, ferry, hours)


def flights(spark, *items):
    return spark.createDataFrame(list(items), OPERATIONAL["flights"])


def test_not_null(spark):
    schema = schema_of("a:int b:int?")
    df = spark.createDataFrame([(None, None), (1, None), (None, 2)], "a int, b int")
    assert rows(audit.not_null(df, schema)) == [("a", 2)]
    assert rows(audit.null_counts(df, ["a", "b"])) == [("a", 2), ("b", 2)]
    assert audit.not_null(df.where("a = 1"), schema).count() == 0


def test_duplicates_dangling_enum(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "delayed"), (None, "x")], "k int, s string")
    assert rows(audit.duplicates(df, ["k"])) == [(1, 2)]
    parents = spark.createDataFrame([(2,)], "id int")
    assert rows(audit.dangling(df, "k", parents, "id")) == [(1, 2)]
    assert rows(audit.outside_enum(df, "s")) == [("x", 2), ("y", 1)]


def test_overlaps_are_half_open_and_see_past_the_previous_row(spark):
    f = flights(
        spark,
        flight(1, 0),
        flight(2, 5),             # starts as the turnaround ends: fine
        flight(3, 9.5),           # half an hour early
        flight(4, 20, plane=2),
        flight(5, 20, plane=2),   # same start
    )
    got = audit.overlaps(audit.airplane_intervals(f))
    assert rows(got, "entity_id", "id") == [(1, 3), (2, 5)]
    # A long interval reaches over a short one, hours later.
    long = spark.createDataFrame(
        [(1, 1, T0, T0 + timedelta(hours=9)),
         (1, 2, T0 + timedelta(hours=1), T0 + timedelta(hours=2)),
         (1, 3, T0 + timedelta(hours=5), T0 + timedelta(hours=6))],
        "entity_id int, id int, start_time timestamp_ntz, end_time timestamp_ntz")
    assert rows(audit.overlaps(long), "id", "busy_until") == [
        (2, T0 + timedelta(hours=9)), (3, T0 + timedelta(hours=9))]


def test_pilots_are_busy_in_either_seat(spark):
    f = flights(spark, flight(1, 0, pilots=(1, 2)), flight(2, 1, plane=2, pilots=(3, 1)),
                flight(3, 1, plane=3, status="cancelled"))
    assert rows(audit.overlaps(audit.pilot_intervals(f)), "entity_id", "id") == [(1, 2)]


def test_attendance_ends_on_arrival(spark):
    f = flights(spark, flight(1, 0), flight(2, 3.5, plane=2), flight(3, 3, plane=3),
                flight(4, 0, plane=4, status="cancelled"))
    links = spark.createDataFrame(
        [(10, 1, 7), (11, 2, 7), (12, 1, 8), (13, 3, 8), (14, 4, 8)],
        "id long, flight_id long, customer_id long")
    got = audit.overlaps(audit.attendance_intervals(links, f, "customer_id"))
    assert rows(got, "entity_id", "id") == [(8, 13)]


def test_continuity(spark):
    f = flights(spark, flight(1, 0, dep=1, arr=2), flight(2, 10, dep=2, arr=3),
                flight(3, 20, dep=1, arr=2), flight(4, 20, plane=2, dep=5, arr=6))
    assert rows(audit.discontinuities(f)) == [(3, 1, 3, 1)]


def test_rules(spark):
    clean = flights(spark, flight(1), flight(2, delay=20, status="delayed"),
                    flight(3, status="cancelled"))
    assert audit.rule_violations(clean).count() == 0
    broken = flights(
        spark,
        flight(1, length=200),
        flight(2, hours=4.0),
        flight(3, delay=5, status="delayed"),
        flight(4, delay=20),
        flight(5, status="cancelled", ferry=True),
        flight(6, dep=3, arr=3),
        flight(7, pilots=(4, 4)),
    )
    assert rows(audit.rule_violations(broken)) == [
        (1, "block_time"), (2, "estimated_hours"), (3, "delay_range"), (4, "delay_status"),
        (5, "cancelled_state"), (6, "same_airport"), (7, "same_pilot")]


def test_occupancy(spark):
    f = flights(spark, flight(1), flight(2), flight(3, status="cancelled"), flight(4))
    crew = spark.createDataFrame(
        [(1, 1, c) for c in range(3)] + [(2, 2, c) for c in range(5)] + [(4, 4, 1), (4, 4, 2)],
        OPERATIONAL["flight_cabin_crew"])
    seats = spark.createDataFrame(
        [(s, fl, s, str(s)) for fl in (1, 2) for s in range(130)],
        OPERATIONAL["flight_bookings"])
    assert rows(audit.occupancy_violations(f, crew, seats)) == [(2, 5, 130), (4, 2, 0)]


def test_endpoint_bridge(spark):
    f = spark.createDataFrame(
        [(1, 10, 11), (2, 10, 10), (3, 99, 10)],
        "flight_id long, departure_airport_id long, arrival_airport_id long")
    airports = spark.createDataFrame(
        [(10, 1), (11, 2), (11, 3)], "airport_id long, airport_sk long")
    assert rows(flight_endpoints(f, airports)) == [(1, 10, 1), (1, 11, 3), (2, 10, 1), (3, 10, 1)]


def test_row_operators(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([("x", 2), ("c", 3), ("d", 3)], "v string, k int")
    assert rows(delete_matching(table, new, "k")) == [(1, "a")]
    assert rows(insert_absent(table, new, "k")) == [(1, "a"), (2, "b"), (3, "d")]
    assert rows(append_absent(table, new.where("v <> 'd'"), "k")) == [
        (1, "a"), (2, "b"), (3, "c")]


def test_documented_schedule_conflicts(spark):
    """The counts FIXTURES.md gives for batch 1: departures less than 5 hours apart."""
    from scdstar.sources.testdata import snapshot_table

    for folder, expected in (("/root/testdata/sf0.001", 0), ("/root/testdata/sf0.01", 9)):
        f = snapshot_table(spark, folder, "flights", 1)
        assert audit.overlaps(audit.airplane_intervals(f)).count() == expected
