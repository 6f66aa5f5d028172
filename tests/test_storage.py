"""Tables kept as parts, the star kept by deltas, one commit, one writer."""

import random
import re

import pytest
from pyspark.sql import functions as F

from scdstar.operators import audit, lineage
from scdstar.operators.keys import KEY_BUCKET, assign_keys, deal
from scdstar.operators.scd2 import LoadOptions, detect_changes, project_source
from scdstar.plans.batch import Namespaces, Pipeline
from scdstar.plans.specs import SPECS
from scdstar.plans.star import build_star
from scdstar.plans.storage import FACTOR, Parts, Stored, newest_of, open_select
from scdstar.schemas import (
    OPERATIONAL, STAGED_REVIEWS, STAR_CONSTRAINTS, STAR_TABLES, WAREHOUSE_CONSTRAINTS,
    WAREHOUSE_TABLES,
)
from scdstar.sources import catalog
from scdstar.sources.lease import Lease
from scdstar.sources.testdata import LOAD_TS, snapshot

from conftest import SMALL, rows


def names(prefix):
    return Namespaces(*[f"{prefix}_{n}" for n in ("warehouse", "star", "staging", "control")])


def reset(spark, found):
    for namespace in (found.warehouse, found.star, found.staging, found.control):
        catalog.wipe_namespace(spark, namespace)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- parts -------------------------------------------------------------------------


def test_parts_stay_few_and_rows_are_rewritten_seldom():
    generator = random.Random(5)
    stored, written, n_rows = Stored(((1, 100_000),)), 0, 100_000
    for batch in range(2, 600):
        fresh = generator.choice([0, 1, 10, 1000, 1000, 3000])
        k = stored.to_merge(fresh, 0)
        if fresh:
            merged = stored.parts[len(stored.parts) - k:]
            size = fresh + sum(n for _, n in merged)
            stored = Stored((*stored.parts[: len(stored.parts) - k], (batch, size)))
            written += size
            n_rows += fresh
        assert len(stored.parts) <= 10
        for (_, older), (_, newer) in zip(stored.parts, stored.parts[1:]):
            assert older > FACTOR * newer
    assert sum(n for _, n in stored.parts) == n_rows
    assert written < 12 * (n_rows - 100_000)


def test_removed_rows_make_a_table_be_written_anew():
    stored = Stored(((1, 100), (2, 10)), removed=40)
    assert stored.to_merge(0, 10) == 0 and stored.to_merge(0, 15) == 2
    assert Stored.parse(stored.text()) == stored


def test_newest_of_takes_each_key_from_its_last_part(spark):
    parts = [spark.createDataFrame(r, "k long, sk long") for r in (
        [(1, 1), (2, 2), (3, 3)], [(2, 12), (4, 14)], [(4, 24), (5, 25)])]
    assert rows(newest_of(parts, "k")) == [(1, 1), (2, 12), (3, 3), (4, 24), (5, 25)]
    assert rows(newest_of(parts[:1], "k")) == [(1, 1), (2, 2), (3, 3)]


def test_the_oldest_part_is_joined_without_a_shuffle(spark):
    """Change detection shuffles the source to the buckets of the part, not the part."""
    catalog.wipe_namespace(spark, "buckets")
    catalog.create_namespace(spark, "buckets")
    spec = SPECS["customers"]
    columns = WAREHOUSE_TABLES["customers"].names

    def versions(first, last):
        ids = spark.range(first, last).select(
            F.col("id").alias("customer_id"), F.concat(F.lit("n"), "id").alias("full_name"),
            F.lit("e").alias("email"), F.lit("No").alias("frequent_flyer"),
            (F.col("id") + 1).alias("customer_sk"))
        return lineage.stamp_inserted(ids, 1, 1, LOAD_TS[1]).select(*columns)

    parts = Parts(spark, "buckets", "customers", spec.key, 8)
    stored = parts.first(versions(0, 5000), 1)
    stored = parts.add(stored, 2, versions(5000, 5100), 100, 0, lambda some, new: new)
    assert stored.parts == ((1, 5000), (2, 100))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        source = project_source(
            spark.range(0, 6000).selectExpr(
                "id", "concat('n', id) AS full_name", "CASE WHEN id % 9 = 0 THEN 'new' ELSE 'e' END"
                " AS email", "'No' AS frequent_flyer"), spec)
        found = detect_changes([parts.read(1), parts.read(2)], source, spec, LoadOptions())
        text = plan(found)
        whole = detect_changes(
            parts.read(1).unionByName(parts.read(2)), source, spec, LoadOptions())
        assert rows(found) == rows(whole)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = text.splitlines()
    scan = next(k for k, line in enumerate(lines) if "customers__v1" in line)
    above = []  # operators between the scan and its join
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            depth = at
            above.append(line)
            if "Join" in line:
                break
    assert above and "Join" in above[-1] and not any("Exchange" in line for line in above)
    catalog.wipe_namespace(spark, "buckets")


# -- batches of random changes -----------------------------------------------------


def random_sources(spark, generator, batch):
    """Small operational tables, of which each batch changes, adds and drops some rows."""
    def pick(n):
        return generator.randrange(n)

    people = {t: [(k, f"{t}{k}" + ("x" * pick(2) if k % 3 == 0 else ""), f"L{k}") for k in range(5 + batch)]
              for t in ("pilots", "cabin_crew")}
    customers = [(k, f"c{k}", f"e{k if pick(4) else batch}", "Yes") for k in range(12 + batch)]
    airports = [(k, f"N{k}", f"n{k if pick(3) else -batch}", "city", "land") for k in range(5)]
    airplanes = [(k, "m", f"R{k}", 1.5, pick(2)) for k in range(4 + batch)]
    flights, stamp = [], "2024-01-01 10:00:00"
    for k in range(20 + 4 * batch):
        cancelled = pick(5) == 0
        flights.append((
            k, f"F{k}", pick(5), pick(5), stamp, None if cancelled else "2024-01-01 13:30:00", pick(2),
            "cancelled" if cancelled else "scheduled", None if cancelled else pick(5),
            None if cancelled else pick(5), pick(4), False, 3.5))
    crew = [(k, pick(20), pick(5)) for k in range(15)]
    bookings = [(k, pick(20 + 4 * batch), pick(12), f"s{pick(3)}") for k in range(40) if pick(8)]
    reviews = [(pick(20), pick(12), "Eco", f"t{pick(3)}", float(pick(3)), True, 1, 2, 3, 4, 5,
                f"2024-02-{1 + pick(20):02d} 00:00:00") for _ in range(15)]

    def frame(data, schema):
        text = ", ".join(
            f"{f.name} {f.dataType.simpleString().replace('timestamp_ntz', 'string')}" for f in schema)
        return spark.createDataFrame(data, text).select(
            *[F.col(f.name).cast(f.dataType) for f in schema])

    tables = {**people, "customers": customers, "airports": airports, "airplanes": airplanes,
              "flights": flights, "flight_cabin_crew": crew, "flight_bookings": bookings}
    return {n: frame(data, OPERATIONAL[n]) for n, data in tables.items()}, frame(reviews, STAGED_REVIEWS)


def equal_to_a_rebuild(spark, runner, batch):
    warehouse = runner.warehouse(runner.state(), batch)
    star = build_star(spark, warehouse)
    for name in STAR_TABLES:
        if name != "dim_date":
            assert rows(spark.table(f"rnd_star.{name}")) == rows(star[name]), (batch, name)
    for name, spec in SPECS.items():
        found = spark.table(f"rnd_warehouse.{name}")
        assert rows(found) == rows(warehouse.versions(name))
        assert audit.several_current(found, spec.key).count() == 0
        keys = warehouse.given_latest.get(name)
        if keys is not None:  # the stored latest keys are those of all versions
            expected = found.groupBy(spec.key[0]).agg(F.max(spec.sk))
            assert rows(keys) == rows(expected), (batch, name)


def test_random_batches_keep_the_star_equal_to_a_rebuild(spark, monkeypatch):
    monkeypatch.setattr("scdstar.plans.storage.FACTOR", 2)  # so that parts are merged soon
    generator = random.Random(11)
    runner = Pipeline(spark, names("rnd"), buckets=2, verify=True)
    before = None
    for batch in range(1, 5):
        tables, reviews = random_sources(spark, generator, batch)
        if batch == 3:  # some tables only
            tables, reviews = {n: tables[n] for n in ("flights", "airports")}, None
        load_ts = f"2024-06-0{batch} 00:00:00"
        (runner.run_initial if batch == 1 else runner.run_batch)(tables, reviews, load_ts)
        if batch in (2, 4):  # what an earlier batch got wrong would still be there
            equal_to_a_rebuild(spark, runner, batch)
        if before is not None:  # a version never changes but for being closed
            now = spark.table("rnd_warehouse.flights").select("flight_sk", "flight_id", "insert_id")
            assert before <= set(map(tuple, now.collect()))
        before = set(map(tuple, spark.table("rnd_warehouse.flights").select(
            "flight_sk", "flight_id", "insert_id").collect()))
    assert runner.audit().where("status = 'violated'").count() == 0
    merged = [s for s in runner.state().values() if s.since > 1 or len(s.parts) > 1]
    assert merged and all(len(s.parts) <= 5 for s in runner.state().values())
    reset(spark, runner.names)


# -- small batches -----------------------------------------------------------------


@pytest.fixture(scope="module")
def loaded(spark):
    runner = Pipeline(spark, names("m"))
    tables, reviews = snapshot(spark, SMALL, 1)
    runner.run_initial(tables, reviews, LOAD_TS[1])
    yield runner, tables, reviews
    reset(spark, runner.names)


def written(spark, runner, batch):
    """Rows of all parts, closed versions and removed keys that a batch wrote."""
    n = 0
    for namespace in (runner.names.warehouse, runner.names.star):
        for found in spark.sql(f"SHOW TABLES IN {namespace}").collect():
            table = f"{namespace}.{found.tableName}"
            if found.tableName.endswith(f"__v{batch}"):
                n += spark.table(table).count()
            elif found.tableName.endswith(("__history", "__gone")):
                n += spark.table(table).where(f"update_id = {batch}").count()
    return n


def test_a_small_batch_writes_what_changed(spark, loaded):
    runner, tables, reviews = loaded
    whole = written(spark, runner, 1)
    changed = tables | {
        "customers": tables["customers"].withColumn(
            "email", F.expr("CASE WHEN id % 100 = 7 THEN 'new' ELSE email END")),
        "flights": tables["flights"].withColumn(
            "delay_minutes", F.expr("CASE WHEN id % 100 = 7 THEN 77 ELSE delay_minutes END")),
        "flight_bookings": tables["flight_bookings"].withColumn(
            "seat_number", F.expr("CASE WHEN id % 100 = 7 THEN 'Z' ELSE seat_number END")),
    }
    batch = runner.run_batch(changed, reviews, LOAD_TS[2])
    assert 0 < written(spark, runner, batch) < 0.04 * whole
    star = build_star(spark, runner.warehouse(runner.state(), batch))
    for name in STAR_TABLES:
        assert rows(spark.table(f"m_star.{name}")) == rows(star[name]), name
    # Keys and counts of the parts are what the report says.
    for (namespace, name), stored in runner.state().items():
        for part, n in stored.parts:
            assert spark.table(f"{namespace}.{name}__v{part}").count() == n


def test_refreshing_reads_no_unchanged_facts(spark, loaded):
    """The plans of a dimension's moves have keys that changed and reference counts only."""
    from scdstar.plans.star_delta import count_changes, moves, Delta

    runner, _, _ = loaded
    fresh = spark.table("m_warehouse.flight_bookings").limit(3)
    changes = count_changes("dim_flight", {"flight_bookings": Delta(fresh, None, 3, 0)}, None)
    counts = spark.table("m_star.dim_flight__refs__v1")
    text = plan(moves(changes, [counts]))
    assert "dim_flight__refs__v1" in text
    for table in ("fact_", "airline_reviews", "flights__"):
        assert table not in text


def test_a_reader_sees_one_batch_until_the_commit(spark, monkeypatch):
    runner = Pipeline(spark, names("one"))
    tables, reviews = snapshot(spark, SMALL, 1)
    runner.run_initial(tables, reviews, LOAD_TS[1])
    counted = [f"one_warehouse.{t}" for t in WAREHOUSE_TABLES] + [f"one_star.{t}" for t in STAR_TABLES]

    def seen():
        return {t: spark.table(t).count() for t in counted}

    before, seen_at = seen(), []
    report = Pipeline._report

    def watched(self, lines):
        seen_at.append(seen())
        report(self, lines)
        seen_at.append(seen())

    monkeypatch.setattr(Pipeline, "_report", watched)
    runner.run_batch(*snapshot(spark, SMALL, 2), LOAD_TS[2])
    after = seen()
    assert seen_at == [before, after] and before != after
    for table in counted:  # and the switch is gone from the views afterwards
        assert "load_audit" not in spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    # A failure while publishing leaves the state of the last batch, and the batch can be repeated.
    monkeypatch.undo()
    publish, calls = catalog.publish, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 3:
            raise OSError("lost catalog")
        publish(*args)

    tables, reviews = snapshot(spark, SMALL, 1)
    monkeypatch.setattr(catalog, "publish", failing)
    with pytest.raises(OSError, match="lost catalog"):
        runner.run_batch(tables, reviews, "2024-06-03 00:00:00")
    monkeypatch.undo()
    assert seen() == after
    assert runner.run_batch({"airports": tables["airports"]}, None, "2024-06-03 00:00:00") == 3
    now = seen()
    assert now["one_warehouse.airports"] > after["one_warehouse.airports"]
    assert {t: n for t, n in now.items() if "airport" not in t} == {
        t: n for t, n in after.items() if "airport" not in t}
    reset(spark, runner.names)


# -- one writer --------------------------------------------------------------------


def test_two_writers_one_error(spark, tmp_path):
    folder = f"file:{tmp_path}"
    with Lease(spark, folder) as first:
        assert first.held()
        with pytest.raises(RuntimeError, match="another load holds"):
            with Lease(spark, folder):
                pass
        assert first.held()
    with Lease(spark, folder) as second:
        assert second.held() and not first.held()
    assert not (tmp_path / "_writer").exists()


def test_a_lease_of_a_lost_writer_is_taken_over(spark, tmp_path):
    lost = Lease(spark, f"file:{tmp_path}")
    lost._create()
    with pytest.raises(RuntimeError):
        Lease(spark, f"file:{tmp_path}", expires=60).__enter__()
    import os
    import time

    old = time.time() - 120
    os.utime(tmp_path / "_writer", (old, old))
    with Lease(spark, f"file:{tmp_path}", expires=60) as found:
        assert found.held() and not lost.held()
    with Lease(spark, f"file:{tmp_path}", expires=2) as kept:  # renewed while it is held
        time.sleep(4)
        with pytest.raises(RuntimeError):
            Lease(spark, f"file:{tmp_path}", expires=2).__enter__()
        assert kept.held()


def test_a_batch_beside_another_one_fails_and_changes_nothing(spark, loaded):
    runner, tables, _ = loaded
    before = runner.last_batch_id()
    with runner._writing():
        with pytest.raises(RuntimeError, match="another load"):
            runner.run_batch({"airports": tables["airports"]}, None, "2024-06-04 00:00:00")
    assert runner.last_batch_id() == before


def test_constraints_of_warehouse_and_star_are_declared_and_checked(spark, loaded):
    runner, _, _ = loaded
    references = sum(
        len(c.references) for declared in (WAREHOUSE_CONSTRAINTS, STAR_CONSTRAINTS)
        for c in declared.values())
    assert references == 24  # and 9 operational ones
    assert set(WAREHOUSE_CONSTRAINTS) == set(WAREHOUSE_TABLES)
    assert set(STAR_CONSTRAINTS) == set(STAR_TABLES)
    found = runner.violations()
    assert found.collect() == []
    text = plan(found)
    assert len(re.findall(r"Exchange hashpartitioning\(space", text)) == 2  # by value, then by check


def test_one_shuffle_makes_keys_and_buckets(spark):
    """First versions are written as they were dealt for their surrogate keys; change detection and
    removals join that part by bucket and key without shuffling it."""
    catalog.wipe_namespace(spark, "dealt")
    catalog.create_namespace(spark, "dealt")
    spec, columns = SPECS["customers"], WAREHOUSE_TABLES["customers"].names
    source = spark.range(0, 3000).selectExpr(
        "id", "concat('n', id) AS full_name", "CASE WHEN id % 9 = 0 THEN 'new' ELSE 'e' END"
        " AS email", "'No' AS frequent_flyer")
    base = F.lit(0).cast("long")

    def keyed(buckets):
        rows = project_source(source.where("id < 2500"), spec).withColumn("email", F.lit("e"))
        return lineage.stamp_inserted(
            assign_keys(rows, spec.sk, spec.key, base, buckets), 1, 1, LOAD_TS[1])

    first = keyed(8).select(*columns, KEY_BUCKET)
    assert len(re.findall("Exchange hashpartitioning", plan(first))) == 1
    assert deal(first, spec.key, 8) is first
    parts = Parts(spark, "dealt", "customers", spec.key, 8, by_bucket=True)
    assert parts.first(first, 1).parts == ((1, 2500),) and parts.dealt_into(1) == 8
    assert rows(parts.read(1)) == rows(keyed(None).select(*columns))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    gone = "SELECT customer_id, customer_sk AS gone FROM dealt.customers__v1 WHERE customer_id < 10"
    opened = [spark.sql(open_select([*columns, *more], [parts.name(1)], gone, spec.key, spec.sk, n))
              for more, n in (([KEY_BUCKET], 8), ([], None))]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        dealt, plain = [
            detect_changes(piece, project_source(source, spec), spec, LoadOptions()) for piece in opened]
        # The source and the removed keys are shuffled; of the others, the part is, too.
        assert len(re.findall("Exchange hashpartitioning", plan(dealt))) == 2
        assert "_bucket" not in dealt.columns and rows(dealt) == rows(plain)
        changed = sum(k % 9 == 0 for k in range(10, 2500))
        assert dealt.count() == 500 + 10 + changed  # added, removed, changed
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    catalog.wipe_namespace(spark, "dealt")
