import pytest
from pyspark.sql import functions as F

from scdstar.operators import lineage
from scdstar.operators.audit import several_current
from scdstar.operators.keys import KEY_BUCKETS, assign_keys, latest_keys, latest_versions, max_key
from scdstar.operators.lookup import Lookup, resolve
from scdstar.operators.scd2 import (
    LoadOptions, TableSpec, differs, merge, one_row_per_key, project_source,
)
from scdstar.plans.specs import SPECS

from conftest import rows

DAY = "2024-06-0{} 00:00:00"
CUSTOMERS = SPECS["customers"]
SOURCE = "id long, full_name string, email string, frequent_flyer string"


def customers(spark, *people):
    df = spark.createDataFrame([(i, n, f"{n}@x", flag) for i, n, flag in people], SOURCE)
    return project_source(df, CUSTOMERS)


def nothing(name):
    raise AssertionError(name)


class Table:
    """A customers table loaded batch by batch."""

    def __init__(self, options=LoadOptions()):
        self.current = self.history = None
        self.batch, self.options = 0, options

    def load(self, source):
        self.batch += 1
        done = merge(CUSTOMERS, source, self.current, self.history, nothing, self.batch,
                     DAY.format(self.batch), self.options)
        past = [p for p in (self.history, done.closed) if p is not None]
        self.current = done.current()
        self.history = past[0].unionByName(past[1]) if len(past) == 2 else (past or [None])[0]
        return done

    @property
    def versions(self):
        return self.current if self.history is None else self.current.unionByName(self.history)

    def brief(self):
        return rows(self.versions.select(
            "customer_id", "full_name", "insert_id", "update_id",
            lineage.is_current().alias("open")))


def test_change_closes_and_opens(spark):
    table = Table()
    table.load(customers(spark, (1, "a", "No"), (2, "b", "No"), (3, "c", "Yes")))
    table.load(customers(spark, (1, "a", "No"), (2, "B", "No"), (4, "d", "No")))
    assert table.brief() == sorted([
        (1, "a", 1, None, True), (2, "b", 1, 2, False), (2, "B", 2, None, True),
        (3, "c", 1, None, True), (4, "d", 2, None, True)], key=repr)
    assert several_current(table.versions, ["customer_id"]).count() == 0


def test_same_source_changes_nothing(spark):
    table = Table()
    people = customers(spark, (1, "a", "No"), (2, "b", "No"))
    table.load(people)
    before = table.brief()
    done = table.load(people)
    assert done.changes.count() == 0
    assert table.brief() == before


def test_versions_of_a_key_do_not_overlap(spark):
    table = Table()
    for name in ("a", "b", "c"):
        table.load(customers(spark, (1, name, "No")))
    spans = rows(table.versions, "start_date", "end_date")
    assert len(spans) == 3
    assert all(a[1] <= b[0] for a, b in zip(sorted(spans), sorted(spans)[1:]))
    assert [lineage.as_of(table.versions, DAY.format(n)).first().full_name
            for n in (1, 2, 3)] == ["a", "b", "c"]
    assert lineage.as_of(table.versions, "2024-05-31 00:00:00").count() == 0


def test_missing_row_stays_open_unless_asked(spark):
    for close, open_rows in ((False, [(1,), (2,)]), (True, [(1,)])):
        table = Table(LoadOptions(close_missing=close))
        table.load(customers(spark, (1, "a", "No"), (2, "b", "No")))
        table.load(customers(spark, (1, "a", "No")))
        assert rows(lineage.current(table.versions), "customer_id") == open_rows


def test_null_is_no_difference_unless_asked(spark):
    df = spark.createDataFrame(
        [(1, "a", "a"), (2, "a", "b"), (3, None, "b"), (4, "a", None), (5, None, None)],
        "i int, x string, y string")
    pairs = [(F.col("x"), F.col("y"))]
    assert rows(df.where(differs(pairs)), "i") == [(2,)]
    assert rows(df.where(differs(pairs, null_safe=True)), "i") == [(2,), (3,), (4,)]
    # A NULL pair does not hide a difference in another column.
    both = [(F.col("x"), F.col("y")), (F.col("i"), F.lit(9))]
    assert df.where(differs(both)).count() == 5


def test_nothing_to_compare_is_an_error():
    spec = TableSpec("t", "sk", ("id",), ("id",), (), 1)
    with pytest.raises(ValueError, match="nothing to compare"):
        spec.compared()


def test_compared_columns():
    assert SPECS["flight_bookings"].compared() == ("seat_number",)
    assert set(SPECS["flight_bookings"].compared(strict=True)) == {
        "seat_number", "flight_id", "customer_id"}
    assert "airplane_id" not in SPECS["flights"].compared()
    assert "airplane_id" in SPECS["flights"].compared(strict=True)
    assert len(SPECS["airline_reviews"].compared()) == 9


def test_one_row_per_key_is_repeatable(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (1, "b", 1), (1, "b", 2), (2, None, None)] + [(3, "x", 1)] * 50,
        "k int, s string, n int")
    assert rows(one_row_per_key(df, ["k"])) == [(1, "b", 2), (2, None, None), (3, "x", 1)]


def test_assigned_keys_are_unique_above_the_base_and_repeatable(spark):
    df = spark.range(20000).select((F.col("id") * 64).alias("k"))
    keyed = assign_keys(df, "sk", ["k"], F.lit(1000).cast("long"))
    again = assign_keys(df.repartition(7), "sk", ["k"], F.lit(1000).cast("long"))
    found = keyed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert found[0] > 1000 and found[2] == 20000
    assert found[1] <= 1000 + 6 * KEY_BUCKETS
    assert rows(keyed) == rows(again)


def test_keys_continue_above_closed_versions(spark):
    table = Table()
    table.load(customers(spark, *[(i, "a", "No") for i in range(50)]))
    top = table.versions.agg(F.max("customer_sk")).first()[0]
    table.load(customers(spark, *[(i, "b", "No") for i in range(50)]))
    assert table.current.agg(F.min("customer_sk")).first()[0] > top
    assert table.versions.agg(F.count_distinct("customer_sk")).first()[0] == 100


def test_max_key(spark):
    assert max_key(spark.range(5), "id").first()[0] == 4
    assert max_key(spark.range(0), "id").first()[0] == 1


def test_lookup_uses_latest_version_and_drops_dangling(spark):
    dims = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "pid long, psk long")
    facts = spark.createDataFrame([(1, 1), (2, 2), (3, 9), (4, None)], "id long, ref long")
    look = Lookup("ref", "dims", "pid", "psk", "found_sk")
    assert rows(resolve(facts, [look], lambda name: dims), "id", "found_sk") == [(1, 11), (2, 12)]


def test_latest_versions(spark):
    table = Table()
    table.load(customers(spark, (1, "a", "No"), (2, "b", "No")))
    table.load(customers(spark, (1, "z", "No")))
    latest = latest_versions(table.versions, ["customer_id"], "customer_sk")
    assert rows(latest, "customer_id", "full_name") == [(1, "z"), (2, "b")]
    assert rows(latest_keys(table.versions, "customer_id", "customer_sk")) == rows(
        latest, "customer_id", "customer_sk")


def test_unresolvable_change_closes_without_successor(spark):
    spec = TableSpec("t", "t_sk", ("t_id",), ("t_id", "ref", "v"), ("ref", "v"), 1,
                     lookups=(Lookup("ref", "dims", "pid", "psk", "ref_sk"),))
    dims = spark.createDataFrame([(1, 10)], "pid long, psk long")
    source = "t_id long, ref long, v string"
    first = merge(spec, spark.createDataFrame([(1, 1, "a"), (2, 1, "a")], source), None, None,
                  lambda n: dims, 1, DAY.format(1))
    second = merge(spec, spark.createDataFrame([(1, None, "x"), (2, 1, "a")], source),
                   first.current(), None, lambda n: dims, 2, DAY.format(2))
    assert rows(second.closed, "t_id") == [(1,)]
    assert second.inserted.count() == 0
    # A changed reference alone that became NULL is no difference.
    third = merge(spec, spark.createDataFrame([(1, None, "a"), (2, 1, "a")], source),
                  first.current(), None, lambda n: dims, 2, DAY.format(2))
    assert third.changes.count() == 0


def test_close_keeps_start_and_insert_batch(spark):
    table = Table()
    table.load(customers(spark, (1, "a", "No")))
    table.load(customers(spark, (1, "b", "No")))
    closed = table.history.first()
    assert (closed.insert_id, closed.update_id, closed.source_id) == (1, 2, 1)
    assert str(closed.start_date) == DAY.format(1) and str(closed.end_date) == DAY.format(2)
    assert rows(lineage.lineage_counts(table.versions)) == [(1, 2, 1, 1), (2, None, 1, 1)]


@pytest.mark.parametrize("options", [
    LoadOptions(), LoadOptions(null_safe=True), LoadOptions(close_missing=True),
    LoadOptions(null_safe=True, close_missing=True)])
def test_one_join_gives_what_three_joins_give(spark, options):
    """Kept, closed, changed and inserted rows, with and without ``whole_table``."""
    table = Table()
    table.load(customers(spark, (1, "a", "No"), (2, "b", None), (3, "c", "Yes"), (4, "d", "No"), (None, "n", "No")))
    source = customers(spark, (1, "a", "No"), (2, "b", "Yes"), (3, "C", "Yes"), (5, "e", "No"), (None, "m", "No"))
    found = [
        merge(CUSTOMERS, source, table.current, None, nothing, 2, DAY.format(2), options, whole_table=whole)
        for whole in (False, True)
    ]
    for part in ("changes", "kept", "closed", "inserted"):
        separate, together = (getattr(done, part) for done in found)
        assert rows(separate) == rows(together, *separate.columns), part
    gone = 1 if options.close_missing else 0  # customer 4; the one without key stays
    assert found[1].closed.count() == 1 + gone + options.null_safe
