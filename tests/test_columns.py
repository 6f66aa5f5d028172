from datetime import datetime

import pytest
from pyspark.sql import functions as F

from scdstar.functions import columns as c
from scdstar.plans.star import dim_date

from conftest import rows


def evaluate(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    result = df.select("i", expression(F.col("x")).alias("y")).orderBy("i")
    return [r.y for r in result.collect()]


def test_strip_removes_every_kind_of_space(spark):
    assert evaluate(spark, ["\n a b\t", " x　", "", None], c.strip) == [
        "a b", "x", "", None]


def test_int_or_zero(spark):
    values = ["3", " 3 ", "", "4.0", "-1", "x", None, "007"]
    assert evaluate(spark, values, c.int_or_zero) == [3, 3, 0, 0, 0, 0, 0, 7]


def test_is_true_only_for_exact_text(spark):
    assert evaluate(spark, ["True", "true", "False", "", None], c.is_true) == [
        True, False, False, False, False]


def test_review_text(spark):
    values = ["Trip Verified | good \n seat", "a|b|c", " plain ", "x|", "one\ntwo"]
    assert evaluate(spark, values, c.review_text) == [
        "good   seat", "a|b|c", "plain", "", "one two"]


def test_mean_of_nonzero(spark):
    df = spark.createDataFrame([(0, 0, 0), (4, 0, 5), (3, 3, 3)], "a int, b int, c int")
    mean = c.mean_of_nonzero(F.col("a"), F.col("b"), F.col("c"))
    assert [r[0] for r in df.select(mean).collect()] == [0.0, 4.5, 3.0]


def test_strict_cast_fails_on_bad_and_empty_cells(spark):
    assert evaluate(spark, ["12"], lambda x: c.strict_cast(x, "int")) == [12]
    for bad in ("", "x", None, "1.5.2"):
        with pytest.raises(Exception, match="not a int"):
            evaluate(spark, [bad], lambda x: c.strict_cast(x, "int"))


def test_durations(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-03-10 01:30:00' a, TIMESTAMP_NTZ'2024-03-10 05:00:59' b")
    got = df.select(c.whole_minutes(F.col("a"), F.col("b")), c.hours(F.col("a"), F.col("b")))
    minutes, hours = got.first()
    assert minutes == 210
    assert round(hours, 6) == round(3.5 + 59 / 3600, 6)


def test_calendar_is_complete_and_padded(spark):
    calendar = dim_date(spark)
    assert calendar.count() == 47482
    first = calendar.where("date_sk = 1").first()
    assert (first.date, first.day, first.month, first.year, first.weekday) == (
        datetime(1970, 1, 1), 1, 1, 1970, "Thursday ")
    last = calendar.orderBy(F.desc("date_sk")).first()
    assert (last.date_sk, last.date) == (47482, datetime(2099, 12, 31))
    assert dim_date(spark, padded=False).where("date_sk = 1").first().weekday == "Thursday"


def test_calendar_key_equals_the_lookup_by_date(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet").select("o_orderkey", "o_orderdate")
    edges = spark.createDataFrame(
        [(-1, datetime(1969, 12, 31, 23, 59)), (-2, datetime(2100, 1, 1)),
         (-3, datetime(2099, 12, 31, 23, 59)), (-4, datetime(1970, 1, 1))],
        "o_orderkey long, o_orderdate timestamp_ntz",
    )
    dates = orders.unionByName(edges)
    looked_up = dates.join(
        dim_date(spark), F.to_date("o_orderdate") == F.to_date("date"), "left"
    ).select("o_orderkey", "date_sk")
    computed = dates.select("o_orderkey", c.calendar_key(F.col("o_orderdate")).alias("date_sk"))
    assert rows(looked_up) == rows(computed)
