"""Shapes of the physical plans."""

import re

import pytest

from scdstar.operators import lineage
from scdstar.operators.lookup import Lookup, resolve
from scdstar.operators.scd2 import LoadOptions, detect_changes, merge, project_source
from scdstar.plans.specs import SPECS, waves
from scdstar.plans.star import fact_booking, refresh_star
from scdstar.plans.two_batches import TwoBatches, two_batches
from scdstar.queries import QUERIES
from scdstar.schemas import WAREHOUSE_TABLES

from conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def loads(spark):
    return two_batches(spark, SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_or_gathers_rows(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text  # all work stays in the JVM
    lines = text.splitlines()
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "partial_" in below  # one row per task
    assert not [line for line in lines if "Window [" in line and re.search(r"\), \[\], ", line)]


def test_small_tables_are_broadcast_by_size(spark, loads):
    spec = SPECS["flights"]
    source = project_source(loads.source("flights", 1), spec)

    def resolved():
        return plan(resolve(source, spec.lookups, lambda name: loads.versions(name, 1)))

    text = resolved()
    assert text.count("BroadcastHashJoin") == 5 and "SortMergeJoin" not in text
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64")
    try:
        text = resolved()  # the same tables count as large
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("SortMergeJoin") == 5 and "Broadcast" not in text


def test_version_filter_reaches_the_scan(loads):
    text = plan(lineage.current(loads.warehouse(2, "flights").current["flights"]))
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(end_date", text)


def test_change_detection_reads_what_it_compares(loads):
    spec = SPECS["flight_bookings"]
    before = loads.warehouse(1, "flight_bookings").current["flight_bookings"]
    source = project_source(loads.source("flight_bookings", 2), spec)
    text = plan(detect_changes(before, source, spec, LoadOptions()))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    table = [s for s in scans if "flight_booking_sk" in s]
    assert table and all(
        {c.split(":")[0] for c in s.split(",")}
        == {"flight_booking_sk", "flight_booking_id", "seat_number"}
        for s in table
    )


def test_closing_versions_needs_no_shuffle(loads):
    """Current rows are only scanned: the closing keys are broadcast."""
    warehouse = loads.warehouse(1, "customers")
    source = project_source(loads.source("customers", 2), SPECS["customers"])
    from scdstar.session import stage

    done = merge(SPECS["customers"], source, warehouse.current["customers"], None,
                 loads.versions, 2, "2024-06-02 00:00:00", stage=stage)
    for part in (done.kept, done.closed):
        text = plan(part)
        assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_facts_without_lookups_are_projections(loads):
    text = plan(fact_booking(loads.warehouse(2).current["flight_bookings"]))
    assert "Join" not in text and "Exchange" not in text
    assert "seat_number" in text and "insert_id" not in text


def test_incremental_fact_refresh_does_not_shuffle_the_star(loads):
    fresh = refresh_star(loads.star(1), loads.warehouse(2), since=2)
    assert "hashpartitioning" not in plan(fresh["fact_booking"])


def test_waves_respect_references():
    order = [[s.name for s in wave] for wave in waves(SPECS)]
    assert order == [
        ["pilots", "cabin_crew", "customers", "airports", "airplanes"],
        ["flights"],
        ["flight_cabin_crew", "flight_bookings", "airline_reviews"],
    ]
    assert [[s.name for s in w] for w in waves(["airline_reviews"])] == [["airline_reviews"]]


def test_specs_cover_the_warehouse(loads):
    assert set(SPECS) == set(WAREHOUSE_TABLES)
    for name, spec in SPECS.items():
        made = {spec.sk, *spec.columns, *(look.out for look in spec.lookups)}
        assert made == set(WAREHOUSE_TABLES[name].names) - {
            "start_date", "end_date", "source_id", "insert_id", "update_id"}


def test_a_hot_reference_is_split(spark, tmp_path):
    """The plan that ran has a skew join when the looked-up side is a written table."""
    look = Lookup("flight_id", "flights", "flight_id", "flight_sk", "found_sk")
    spark.range(50_000).selectExpr("id AS flight_id", "id + 7 AS flight_sk").write.parquet(
        str(tmp_path / "latest"))
    hot = spark.range(400_000).selectExpr(
        "id", "CASE WHEN id % 10 = 0 THEN id % 50000 ELSE 3 END AS flight_id", "repeat('x', 30) AS t")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        latest = spark.read.parquet(str(tmp_path / "latest"))
        done = resolve(hot, [look], lambda name: latest, lambda found: latest)
        assert len(done.collect()) == 400_000
        assert "isSkew=true" in done._jdf.queryExecution().executedPlan().toString() or (
            "skew=true" in done._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_star_tables_load_what_they_depend_on(spark):
    """An airplane is never closed here, so nothing that refers to airplanes is read."""
    loads = TwoBatches(spark, SMALL)
    assert loads.star()["dim_airplane"].count() == 200
    assert set(loads.warehouse(2, "airplanes").current) == {"airplanes"}
    loads.star(1)["dim_customer"].count()
    assert set(loads.warehouse(1, "customers").current) == {"airplanes", "customers"}
    assert loads.star()["dim_customer"].count() == 182  # retained by bookings and reviews
    assert "flight_cabin_crew" not in loads.warehouse(2, "customers").current


def test_versions_that_stay_are_not_joined_or_written_again(loads):
    for name in ("flight_bookings", "airline_reviews"):
        text = plan(loads.warehouse(2, name).current[name])
        assert "Join" not in text and "Exchange" not in text
        assert "_ends" in text


@pytest.mark.parametrize("name", ["flight_bookings", "flight_cabin_crew"])
def test_lines_are_dealt_once(spark, loads, name):
    """The shuffle that groups lines serves the flight lookup and the comparison by id, too."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spec, before = SPECS[name], loads.warehouse(1, name).current[name]
    flight = [look for look in spec.lookups if look.table == "flights"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = plan(resolve(project_source(loads.source(name, 1), spec), flight,
                             lambda table: loads.versions(table, 1)))
        second = plan(detect_changes(before, project_source(loads.source(name, 2), spec), spec, LoadOptions()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for text in (first, second):  # one for each side of the join
        assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") == 2, text


def test_raw_reviews_load_only_tables_they_refer_to(spark, monkeypatch):
    monkeypatch.setattr("scdstar.plans.two_batches._SESSIONS", {})
    QUERIES["review_raw_csv"](spark, SMALL)
    loaded = two_batches(spark, SMALL)._loaded[1].current
    assert {"flights", "customers"} <= set(loaded) and "airline_reviews" not in loaded
