"""Initial load, batches and the review stream against the catalog."""

import shutil
import time

import pytest
from pyspark.sql import functions as F

from scdstar.operators import lineage
from scdstar.operators.scd2 import LoadOptions
from scdstar.plans.batch import Namespaces, Pipeline
from scdstar.plans.star import build_star
from scdstar.plans.two_batches import two_batches
from scdstar.schemas import OPERATIONAL, SOURCE_OPERATIONAL, STAR_TABLES, WAREHOUSE_TABLES
from scdstar.sources import catalog
from scdstar.sources.operational import read_catalog, read_parquet
from scdstar.sources.reviews import write_reviews
from scdstar.sources.testdata import LOAD_TS, snapshot
from scdstar.streaming.reviews import load_every, stream_reviews

from conftest import rows


def names(prefix):
    return Namespaces(*[f"{prefix}_{n}" for n in ("warehouse", "star", "staging", "control")])


def reset(spark, found):
    for namespace in (found.warehouse, found.star, found.staging, found.control):
        catalog.wipe_namespace(spark, namespace)


@pytest.fixture(scope="module")
def pipeline(spark):
    """A pipeline that has loaded both batches, the second after a failed attempt."""
    runner = Pipeline(spark, names("t"))
    tables, reviews = snapshot(spark, "/root/testdata/sf0.001", 1)
    assert runner.run_initial(tables, reviews, LOAD_TS[1]) == 1
    tables, reviews = snapshot(spark, "/root/testdata/sf0.001", 2)
    broken = dict(tables)
    broken["flight_bookings"] = tables["flight_bookings"].withColumn(
        "seat_number", F.raise_error(F.lit("lost connection")).cast("string"))
    with pytest.raises(Exception, match="lost connection"):
        runner.run_batch(broken, reviews, LOAD_TS[2])
    assert runner.next_batch_id() == 2
    assert spark.table("t_warehouse.customers").where("insert_id = 2").count() == 0
    assert runner.run_batch(tables, reviews, LOAD_TS[2]) == 2
    yield runner
    reset(spark, runner.names)


def test_tables_equal_the_two_batches(spark, pipeline, small):
    loads = two_batches(spark, small)
    for name in WAREHOUSE_TABLES:
        found = spark.table(f"t_warehouse.{name}")
        columns = [c for c in found.columns if c != "end_date"]
        expected = loads.versions(name).withColumn("open", lineage.is_current())
        assert rows(found.withColumn("open", lineage.is_current()), *columns, "open") == rows(
            expected, *columns, "open"), name
    star = build_star(spark, loads.warehouse(2))
    for name in STAR_TABLES:
        assert rows(spark.table(f"t_star.{name}")) == rows(star[name]), name


def test_one_earlier_version_is_kept(spark, pipeline):
    found = {r.tableName for r in spark.sql("SHOW TABLES IN t_warehouse").collect()}
    assert {"customers__v1", "customers__v2", "pilots__v1"} <= found
    assert not {"customers__v0", "pilots__v2"} & found


def test_load_report(pipeline):
    report = pipeline.audit()
    ok = report.where("status = 'ok' AND namespace = 't_warehouse' AND batch_id = 2")
    got = {r.table_name: (r.inserted, r.closed, r.unresolved, r.version) for r in ok.collect()}
    assert got["customers"] == (32, 20, 0, 2)
    assert got["flights"][:2] == (131, 182)
    assert got["pilots"] == (0, 0, 0, 1)  # nothing changed, nothing rewritten
    failed = report.where("status = 'failed'").collect()
    assert len(failed) == 1 and failed[0].batch_id == 2 and "lost connection" in failed[0].message


def test_same_source_again_changes_nothing(spark, pipeline, small):
    tables, reviews = snapshot(spark, small, 2)
    before = {n: spark.table(f"t_warehouse.{n}").count() for n in WAREHOUSE_TABLES}
    batch = pipeline.run_batch(tables, reviews, "2024-06-03 00:00:00")
    assert {n: spark.table(f"t_warehouse.{n}").count() for n in WAREHOUSE_TABLES} == before
    # A cancelled flight that was changed while it had no version stays unresolved.
    done = pipeline.audit().where(f"batch_id = {batch} AND namespace = 't_warehouse'")
    assert done.agg(F.sum("inserted"), F.sum("closed")).first()[:] == (0, 0)


def test_batch_needs_an_initial_load(spark, small):
    runner = Pipeline(spark, names("u"))
    tables, reviews = snapshot(spark, small, 1)
    with pytest.raises(RuntimeError, match="no initial load"):
        runner.run_batch(tables, reviews, LOAD_TS[1])
    reset(spark, runner.names)


def test_stream_equals_one_batch(spark, small, tmp_path):
    runner = Pipeline(spark, names("s"))
    tables, reviews = snapshot(spark, small, 1)
    runner.run_initial(tables, reviews.limit(0), LOAD_TS[1])
    folder, ticks = tmp_path / "reviews", iter(range(2, 9))
    folder.mkdir()

    def arrive(part, name):
        write_reviews(part.coalesce(1), str(tmp_path / name))
        for file in (tmp_path / name).glob("part-*.csv"):
            shutil.copy(file, folder / f"{name}.csv")

    def run():
        query = stream_reviews(
            runner, str(folder), checkpoint=str(tmp_path / "state"), every=None,
            clock=lambda: f"2024-06-0{next(ticks)} 00:00:00")
        query.awaitTermination()

    arrive(reviews.where("customer_id % 2 = 0"), "even")
    run()
    arrive(reviews.where("customer_id % 2 = 1"), "odd")
    run()
    run()  # nothing new
    found = spark.table("s_warehouse.airline_reviews")
    expected = two_batches(spark, small).versions("airline_reviews", 1)
    business = ["flight_id", "customer_id", "date_published", "rating", "content"]
    assert rows(found, *business) == rows(expected, *business)
    assert rows(found.select("insert_id").distinct()) == [(2,), (3,)]
    assert spark.table("s_star.fact_review").count() == expected.count()
    # A replayed epoch is recognized.
    stream = runner.audit().where("namespace = 'stream'").first().table_name
    assert runner.run_epoch(stream, 0, {}, reviews, "2024-06-09 00:00:00") is None
    # A new checkpoint counts from 0 again, and its files are loaded.
    before = runner.last_batch_id()
    stream_reviews(runner, str(folder), checkpoint=str(tmp_path / "fresh"), every=None,
                   clock=lambda: "2024-06-09 00:00:00").awaitTermination()
    assert runner.last_batch_id() > before
    with pytest.raises(ValueError, match="before that of the last batch"):
        runner.run_batch({}, None, "2024-06-01 12:00:00")
    reset(spark, runner.names)


def test_a_failed_batch_leaves_no_closures(spark, small):
    runner = two_batches(spark, small).after_failure()
    for name in ("customers", "flights"):
        found = spark.table(f"{runner.names.warehouse}.{name}")
        assert found.count() == two_batches(spark, small).versions(name, 1).count()
        assert found.where("update_id IS NOT NULL").count() == 0


def test_streams_close_nothing_for_being_absent(spark, small):
    runner = two_batches(spark, small).streamed_in_two(True, LoadOptions(close_missing=True))
    reviews = spark.table(f"{runner.names.warehouse}.airline_reviews")
    assert reviews.where("update_id IS NOT NULL").count() == 0


def test_tables_are_loaded_on_time_without_review_files(spark, small, tmp_path):
    runner = Pipeline(spark, names("w"))
    tables, reviews = snapshot(spark, small, 1)
    runner.run_initial(tables, reviews.limit(0), LOAD_TS[1])
    changed = snapshot(spark, small, 2)[0]["airports"]
    query = load_every(runner, lambda: {"airports": changed}, "1 second", str(tmp_path / "timed"),
                       lambda: LOAD_TS[2])
    try:
        for _ in range(240):
            if runner.last_batch_id() > 1 or query.exception():
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert query.exception() is None
    airports = spark.table("w_warehouse.airports")
    assert airports.where("insert_id = 2").count() == 5
    reset(spark, runner.names)


def test_namespace_ddl(spark):
    catalog.ensure_namespace(spark, "ddl_airline", OPERATIONAL)
    catalog.ensure_namespace(spark, "ddl_airline", OPERATIONAL)
    people = spark.createDataFrame([("L1", 1, "p")], "license_number string, id long, name string")
    catalog.append_by_name(people, "ddl_airline.pilots")
    assert rows(read_catalog(spark, "ddl_airline")["pilots"]) == [(1, "p", "L1")]
    catalog.truncate_namespace(spark, "ddl_airline")
    assert spark.table("ddl_airline.pilots").count() == 0
    catalog.wipe_namespace(spark, "ddl_airline")
    assert not spark.catalog.databaseExists("ddl_airline")
    catalog.wipe_namespace(spark, "ddl_airline")


def test_insert_select_stamps_rows(spark):
    catalog.wipe_namespace(spark, "ddl_wh")
    catalog.ensure_namespace(spark, "ddl_wh", {"pilots": WAREHOUSE_TABLES["pilots"]})
    rows_in = spark.createDataFrame(
        [("p", 7, "L", 1)], "name string, pilot_id long, license_number string, pilot_sk long")
    catalog.insert_select(rows_in, "ddl_wh.pilots", 4, SOURCE_OPERATIONAL, LOAD_TS[1])
    got = spark.table("ddl_wh.pilots").first()
    assert (got.pilot_sk, got.pilot_id, got.name, got.insert_id, got.update_id) == (
        1, 7, "p", 4, None)
    assert lineage.current(spark.table("ddl_wh.pilots")).count() == 1
    catalog.wipe_namespace(spark, "ddl_wh")


def test_parquet_source(spark, small, tmp_path):
    tables, _ = snapshot(spark, small, 1)
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    for name, df in read_parquet(spark, str(tmp_path)).items():
        assert df.columns == OPERATIONAL[name].names
        assert df.count() == tables[name].count()
