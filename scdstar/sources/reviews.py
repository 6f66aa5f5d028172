"""Review CSV files: the raw layout, the cleansed layout, and the cleansing between."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scdstar.functions.columns import (
    int_or_zero,
    is_true,
    mean_of_nonzero,
    review_text,
    strict_cast,
    strip,
)
from scdstar.schemas import RAW_REVIEWS, STAGED_REVIEWS
from scdstar.sources.split_csv import read_split_csv

# The scores whose non-zero mean is the rating (the seat is not one).
RATED = (
    "cabin_staff_service",
    "food_and_beverages",
    "inflight_entertainment",
    "value_for_money",
    "ground_service",
    "wifi_and_connectivity",
)
SCORES = ("seat_comfort", *RATED)

STAGED_TEXT = T.StructType([T.StructField(n, T.StringType()) for n in STAGED_REVIEWS.names])


def _csv_options(multiline: bool) -> dict[str, object]:
    return {"header": True, "quote": '"', "escape": '"', "multiLine": multiline,
            "mode": "FAILFAST"}


def read_raw_reviews(
    spark: SparkSession, path: str | Sequence[str], split: bool = False
) -> DataFrame:
    """Raw reviews: 14 text columns, bound by position.

    Texts may hold line breaks, so one file is one task, unless ``split`` cuts files
    by quote parity (see :mod:`scdstar.sources.split_csv`).
    """
    if split:
        return read_split_csv(spark, path, RAW_REVIEWS)
    return spark.read.schema(RAW_REVIEWS).options(**_csv_options(True)).csv(path)


def cleanse_reviews(raw: DataFrame) -> DataFrame:
    """Cleanse raw reviews; columns other than the raw ones pass through.

    Rows with an empty first cell are dropped, cells are stripped, scores become
    integers, the rating is the mean of the non-zero scores. A date that is not
    ``yyyy-MM-dd`` fails the job. ``source_date`` is that date.
    """
    passed = [F.col(c) for c in raw.columns if c not in RAW_REVIEWS.names]
    scores = {c: int_or_zero(F.col(c)) for c in SCORES}
    dated = strict_cast(strip(F.col("date_published")), "date")
    return (
        raw.where(F.coalesce("airlines", F.lit("")) != "")
        .where(dated.isNotNull())
        .select(
            *passed,
            review_text(F.coalesce("text_content", F.lit(""))).alias("content"),
            strip(F.col("seat_type")).alias("seat_type"),
            is_true(strip(F.col("recommended"))).alias("recommended"),
            dated.alias("source_date"),
            *[value.alias(c) for c, value in scores.items()],
        )
        .withColumn("rating", mean_of_nonzero(*[F.col(c) for c in RATED]))
    )


def staged_reviews(cleansed: DataFrame) -> DataFrame:
    """The twelve columns of the staging table, from cleansed reviews that also
    carry ``flight_id``, ``customer_id``, ``seat_class`` and ``date_published``."""
    return cleansed.select(*[F.col(f.name).cast(f.dataType) for f in STAGED_REVIEWS])


def parse_staged_text(text: DataFrame) -> DataFrame:
    """Type the cells of a cleansed review file; any malformed cell fails the job."""
    typed = []
    for field in STAGED_REVIEWS:
        cell = F.col(field.name)
        if field.name == "recommended":
            value = is_true(cell)
        elif isinstance(field.dataType, T.StringType):
            value = F.coalesce(cell, F.lit(""))
        else:
            value = strict_cast(cell, field.dataType.simpleString())
        typed.append(value.alias(field.name))
    return text.select(*typed)


def read_staged_reviews(
    spark: SparkSession, path: str | Sequence[str], multiline: bool = True, split: bool = False
) -> DataFrame:
    """Cleansed reviews: 12 columns, bound by position.

    Files written by ``write_reviews`` hold no line feeds inside cells and may be
    read with ``multiline=False``, which lets Spark split large files. With ``split``, files
    with line feeds inside cells are split as well.
    """
    if split:
        return parse_staged_text(read_split_csv(spark, path, STAGED_TEXT))
    reader = spark.read.schema(STAGED_TEXT).options(**_csv_options(multiline))
    if not multiline:
        reader = reader.option("lineSep", "\n")
    return parse_staged_text(reader.csv(path))


def _with_micros(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.ffffff``, the timestamp format of the cleansed file."""
    text = ts.cast("string")
    dotted = F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".")))
    return F.rpad(dotted, 26, "0")


def write_raw_reviews(raw: DataFrame, path: str) -> None:
    """Write raw reviews as CSV files with a header each, cells as they are."""
    (
        raw.select(*RAW_REVIEWS.names).write.options(header=True, quote='"', escape='"', lineSep="\n")
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="")
        .mode("overwrite").csv(path)
    )


def write_reviews(reviews: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write cleansed reviews as CSV files with a header each."""
    text = reviews.select(*STAGED_REVIEWS.names).withColumns(
        {
            "content": F.replace("content", F.lit("\n"), F.lit(" ")),
            "recommended": F.when(F.col("recommended"), "True").otherwise("False"),
            "date_published": _with_micros(F.col("date_published")),
        }
    )
    (
        text.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("lineSep", "\n")
        .option("maxRecordsPerFile", rows_per_file)
        .mode("overwrite")
        .csv(path)
    )
