import pytest
from pyspark.sql import functions as F

from scdstar.schemas import RAW_REVIEWS, STAGED_REVIEWS
from scdstar.sources.reviews import (
    cleanse_reviews, read_raw_reviews, read_staged_reviews, staged_reviews, write_reviews,
)

from conftest import rows

HEADER = ",".join(STAGED_REVIEWS.names)


def write(tmp_path, text, name="reviews.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_raw_reviews_are_cleansed(spark, tmp_path):
    path = write(tmp_path, (
        "Airlines,Name,Location,Date Published,Text Content,Seat Type,Seat Comfort,Cabin,Food,"
        "Inflight,Value,Recommended,Ground,Wifi\n"
        'A, Ann ,x,2024-01-02,"Trip Verified | fine, ""very"" fine\nindeed",Eco,4, 3 ,,4.0,5,True,-1,1\n'
        ",Bob,x,2024-01-02,dropped,Eco,1,1,1,1,1,True,1,1\n"
        "B,Cid,x,2024-01-03,a|b|c,Eco,5,0,0,0,0,true,0,0\n"
    ))
    raw = read_raw_reviews(spark, path)
    assert raw.columns == RAW_REVIEWS.names
    got = cleanse_reviews(raw).orderBy("source_date").collect()
    assert len(got) == 2
    first, second = got
    assert first.content == 'fine, "very" fine indeed'
    assert (first.seat_comfort, first.cabin_staff_service, first.food_and_beverages,
            first.inflight_entertainment, first.value_for_money) == (4, 3, 0, 0, 5)
    assert first.rating == 3.0  # mean of 3, 5 and 1; the seat is left out
    assert first.recommended is True
    assert (second.content, second.rating, second.recommended) == ("a|b|c", 0.0, False)


def test_bad_raw_date_fails(spark):
    row = spark.createDataFrame(
        [("A", "", "", "someday", "t", "", "", "", "", "", "", "True", "", "")], RAW_REVIEWS)
    with pytest.raises(Exception, match="not a date"):
        cleanse_reviews(row).select("content").collect()


def test_staged_reviews_round_trip(spark, tmp_path):
    path = write(tmp_path, HEADER + "\n"
        '1,2,First,"good, ""really""",4.5,True,1,2,3,4,5,2024-01-02 03:04:05.000006\n'
        "1,3,Economy,,0,true,0,0,0,0,0,2024-01-02 03:04:05\n")
    reviews = read_staged_reviews(spark, path)
    assert [f.dataType for f in reviews.schema] == [f.dataType for f in STAGED_REVIEWS]
    got = rows(reviews, "customer_id", "content", "rating", "recommended")
    assert got == [(2, 'good, "really"', 4.5, True), (3, "", 0.0, False)]
    out = str(tmp_path / "out")
    write_reviews(reviews, out)
    assert rows(read_staged_reviews(spark, out)) == rows(reviews)
    assert rows(read_staged_reviews(spark, out, multiline=False)) == rows(reviews)
    stamps = spark.read.csv(out, header=True, escape='"').select("date_published")
    assert rows(stamps) == [("2024-01-02 03:04:05.000000",), ("2024-01-02 03:04:05.000006",)]


@pytest.mark.parametrize("bad", [
    "x,2,F,c,4.5,True,1,2,3,4,5,2024-01-02 03:04:05.0",
    "1,2,F,c,,True,1,2,3,4,5,2024-01-02 03:04:05.0",
    "1,2,F,c,4.5,True,1,2,3,4,5,yesterday",
    "1,2,F,c,4.5,True,1,2,3,4",
])
def test_malformed_staged_review_fails(spark, tmp_path, bad):
    path = write(tmp_path, f"{HEADER}\n{bad}\n")
    with pytest.raises(Exception):
        read_staged_reviews(spark, path).collect()


def test_line_breaks_inside_cells(spark, tmp_path):
    path = write(tmp_path, HEADER + "\n"
        '1,2,F,"two\nlines",4.5,True,1,2,3,4,5,2024-01-02 03:04:05.0\n')
    reviews = read_staged_reviews(spark, path)
    assert reviews.first().content == "two\nlines"
    out = str(tmp_path / "out")
    write_reviews(reviews, out)
    assert read_staged_reviews(spark, out, multiline=False).first().content == "two lines"


def test_cleansed_reviews_fit_the_staging_table(spark):
    row = spark.createDataFrame(
        [("A", "", "", "2024-01-01", "t", "Eco", "1", "2", "", "", "", "True", "", "")],
        RAW_REVIEWS,
    ).withColumns({
        "flight_id": F.lit(1), "customer_id": F.lit(2), "seat_class": F.lit("First")})
    row = row.withColumn("date_published", F.lit("2024-01-01"))
    cleansed = cleanse_reviews(row).withColumn(
        "date_published", F.lit("2024-02-03 04:05:06").cast("timestamp_ntz"))
    staged = staged_reviews(cleansed)
    assert staged.columns == STAGED_REVIEWS.names
    assert staged.first().rating == 2.0


def test_padded_cells_come_back_as_they_were(spark, tmp_path):
    values = [1, 2, "  Economy ", "  padded text  ", 1.5, True, 1, 2, 3, 4, 5, None]
    row = spark.createDataFrame([tuple(values)], ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in STAGED_REVIEWS
    )).withColumn("date_published", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    row = row.select(*[F.col(f.name).cast(f.dataType) for f in STAGED_REVIEWS])
    write_reviews(row, str(tmp_path / "padded"))
    for multiline in (True, False):
        back = read_staged_reviews(spark, str(tmp_path / "padded"), multiline)
        assert back.collect() == row.collect()
