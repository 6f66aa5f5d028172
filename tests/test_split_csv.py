"""CSV files with line breaks in cells, cut into many ranges."""

import csv
import random

import pytest
from pyspark.sql import types as T

from scdstar.schemas import RAW_REVIEWS, STAGED_REVIEWS
from scdstar.sources import split_csv
from scdstar.sources.reviews import (
    cleanse_reviews, read_raw_reviews, read_staged_reviews, write_raw_reviews, write_reviews,
)

from conftest import rows

THREE = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
WHOLE = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "mode": "FAILFAST"}


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few hundred bytes, so that cells and records go over several of them."""
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0",
                "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cell(generator):
    kind = generator.randrange(9)
    if kind == 0:
        return ""
    if kind == 1:
        return "\n" * generator.randrange(1, 4)
    if kind == 2:
        return '"' * generator.randrange(1, 4)
    if kind == 3:  # longer than several ranges
        return "".join(generator.choice("ab,\n\"é ") for _ in range(generator.randrange(300, 2500)))
    return "".join(generator.choice("ab, \n\"é;x日") for _ in range(generator.randrange(1, 30)))


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_equal_to_the_multi_line_reader(spark, tmp_path, small_ranges, ending):
    generator = random.Random(3)
    for name in ("one", "two"):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as file:
            writer = csv.writer(file, lineterminator=ending)
            writer.writerow(["h1", "h2", "h3"])
            for k in range(70):
                writer.writerow([str(k), cell(generator), cell(generator)])
    expected = spark.read.schema(THREE).options(**WHOLE).csv(str(tmp_path))
    found = split_csv.read_split_csv(spark, str(tmp_path), THREE)
    assert rows(found) == rows(expected) and found.count() == 140
    lines = split_csv._lines(spark, str(tmp_path / "one.csv"))
    assert lines.select("start").distinct().count() > 20  # one file, many tasks
    assert lines.rdd.getNumPartitions() > 20


def test_awkward_files(spark, tmp_path, small_ranges):
    def read(text, **options):
        path = tmp_path / f"{abs(hash(text))}.csv"
        path.write_bytes(text.encode())
        return rows(split_csv.read_split_csv(spark, str(path), THREE, **options))

    assert read("") == read("h,h,h") == read("h,h,h\n") == []
    assert read("1,2,3", header=False) == [("1", "2", "3")]
    assert read('h,h,h\n\n1,"a\n\nb",3\n\n') == [("1", "a\n\nb", "3")]
    assert read(f'h,h,h\n1,"{"x" * 5000}",3\n') == [("1", "x" * 5000, "3")]
    with pytest.raises(Exception, match="not closed"):
        read('h,h,h\n1,"2,3\n')
    with pytest.raises(Exception, match="[Mm]alformed"):
        read("h,h,h\n1,2\n")


def test_many_files_at_once(spark, tmp_path, small_ranges):
    paths = []
    for k in range(5):
        path = tmp_path / f"f{k}.csv"
        path.write_text(f'h,h,h\n{k},"x\ny",z\n')
        paths.append(str(path))
    assert rows(split_csv.read_split_csv(spark, paths, THREE)) == [
        (str(k), "x\ny", "z") for k in range(5)]


def test_review_readers(spark, tmp_path, small_ranges):
    raw = [[f"A{k}", "n", "l", "2024-01-02", f"Trip | {k}\nand, \"more\"\n", "Eco", "1", "2", "", "4.0",
            "5", "True", "0", "1"] for k in range(60)]
    with open(tmp_path / "raw.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows([RAW_REVIEWS.names, *raw])
    path = str(tmp_path / "raw.csv")
    assert rows(read_raw_reviews(spark, path, split=True)) == rows(read_raw_reviews(spark, path))
    line = '{},2,F,"two\nlines, ""q""",4.5,True,1,2,3,4,5,2024-01-02 03:04:05.0'
    staged = tmp_path / "staged.csv"
    staged.write_text("\n".join([",".join(STAGED_REVIEWS.names), *(line.format(k) for k in range(80))]))
    found = read_staged_reviews(spark, str(staged), split=True)
    assert rows(found) == rows(read_staged_reviews(spark, str(staged))) and found.count() == 80
    write_reviews(found, str(tmp_path / "out"))
    assert read_staged_reviews(spark, str(tmp_path / "out"), split=True).count() == 80


def test_conditions_on_cells_parse_no_record_again(spark, tmp_path):
    row = ", ".join(f"'2024-01-02' AS {c}" for c in RAW_REVIEWS.names)
    write_raw_reviews(spark.sql(f"SELECT {row}"), f"{tmp_path}/raw")
    found = cleanse_reviews(read_raw_reviews(spark, f"{tmp_path}/raw", split=True))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
    assert found.count() == 1
