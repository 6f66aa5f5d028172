"""Version stamps and version filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from scdstar.schemas import max_timestamp, timestamp


def stamp_inserted(df: DataFrame, batch_id: int, source_id: int, load_ts: str) -> DataFrame:
    """Open a version: valid from the batch's load time on, not yet updated."""
    return df.withColumns(
        {
            "start_date": timestamp(load_ts),
            "end_date": max_timestamp(),
            "source_id": F.lit(source_id).cast("int"),
            "insert_id": F.lit(batch_id).cast("int"),
            "update_id": F.lit(None).cast("int"),
        }
    )


def stamp_closed(df: DataFrame, batch_id: int, source_id: int, load_ts: str) -> DataFrame:
    """Close a version; its start date and insert batch stay."""
    return df.withColumns(
        {
            "end_date": timestamp(load_ts),
            "source_id": F.lit(source_id).cast("int"),
            "update_id": F.lit(batch_id).cast("int"),
        }
    )


def is_current() -> Column:
    return F.col("end_date") == max_timestamp()


def current(df: DataFrame) -> DataFrame:
    return df.where(is_current())


def expired(df: DataFrame) -> DataFrame:
    return df.where(~is_current())


def as_of(df: DataFrame, moment: str) -> DataFrame:
    """The versions valid at ``moment``."""
    at = timestamp(moment)
    return df.where((F.col("start_date") <= at) & (F.col("end_date") > at))


def lineage_counts(df: DataFrame) -> DataFrame:
    """Rows inserted and closed per batch and source."""
    return df.groupBy("insert_id", "update_id", "source_id").agg(F.count("*").alias("n_rows"))
