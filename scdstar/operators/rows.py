"""Row deletion and insertion by key, for tables that are rebuilt rather than updated."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def delete_matching(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among ``keys``."""
    return table.join(keys.select(key), key, "left_anti").select(*table.columns)


def insert_absent(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The table plus one row for each key in ``rows`` that it lacks.

    Duplicates within ``rows`` collapse to the greatest row, combined map-side.
    """
    absent = rows.select(*table.columns).join(table.select(key), key, "left_anti")
    rest = [c for c in table.columns if c != key]
    if rest:
        absent = (
            absent.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(key, "_row.*")
        )
    else:
        absent = absent.distinct()
    return table.unionByName(absent.select(*table.columns))


def append_absent(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Like ``insert_absent`` for rows whose keys are distinct already, such as
    warehouse surrogate keys: a plain anti join, no grouping."""
    absent = rows.select(*table.columns).join(table.select(key), key, "left_anti")
    return table.unionByName(absent.select(*table.columns))
