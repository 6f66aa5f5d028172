"""What several operators share: input tables and words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of anything but the six ASCII white-space characters are words.
SPACE, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, JVM-side; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def characters(text: Column, kind: str) -> Column:
    """How many characters of ``text`` match ``kind``, a pattern of one character."""
    return F.regexp_count(text, F.lit(kind)).cast("long")


def word_bytes(text: str | None) -> list[bytes]:
    """The same words as UTF-8, with A-Z lower-cased, for code that runs in Python tasks.

    ``bytes.split`` and ``bytes.lower`` know ASCII only, which is the rule here.
    """
    return (text or "").encode("utf-8", "surrogatepass").lower().split()
