"""Awkward rows that every operator has to stand, and small helpers."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id bigint, text string, n bigint, row string, id bigint, x string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()


def sentence(start: int, n: int) -> str:
    return " ".join(WORDS[(start + k * (1 + start % 5)) % len(WORDS)] + str(k // 7) for k in range(n))


def awkward() -> list[tuple[int | None, str | None]]:
    long = sentence(3, 30_000)
    return [
        (1, sentence(1, 80)), (2, sentence(1, 80)), (2, sentence(1, 80)),  # copies, a repeated row
        (3, sentence(1, 80).replace("beta", "BETA")), (4, sentence(1, 79) + " end"),
        (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "ONE"), (10, "two words"),
        (11, long), (12, long + " more"), (None, sentence(2, 60)), (None, None),
        (13, "ünï cødé 日本語 🙂 " * 20), (14, "a\r\nb\x0bc\x0cd  e"), (15, sentence(4, 3)),
        (20, sentence(6, 70)), (20, sentence(8, 70)),  # one id, two texts
        (21, "\x00\x01 control ퟿"), (22, "same same same same same same same"),
    ]


def labels(spark: SparkSession, rows=()) -> DataFrame:
    return spark.createDataFrame(list(rows), "doc_id bigint, quality bigint, toxic bigint")


@pytest.fixture(scope="session")
def docs(spark: SparkSession) -> DataFrame:
    """Awkward rows, with further columns whose names operators use inside."""
    return spark.createDataFrame(
        [(i, t, 1, "r", 2, "x") for i, t in awkward()], DOCS
    ).repartition(3)


@pytest.fixture(scope="session")
def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)
