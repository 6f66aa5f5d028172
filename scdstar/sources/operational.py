"""Readers of the operational tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from scdstar.schemas import AIRLINE, OPERATIONAL


def read_parquet(
    spark: SparkSession, folder: str, tables: Iterable[str] = OPERATIONAL
) -> dict[str, DataFrame]:
    """Operational tables from ``<folder>/<table>``, with their declared schemas."""
    return {
        name: spark.read.schema(OPERATIONAL[name]).parquet(f"{folder}/{name}") for name in tables
    }


def read_catalog(spark: SparkSession, namespace: str = AIRLINE) -> dict[str, DataFrame]:
    """All operational tables from a catalog namespace."""
    return {
        name: spark.table(f"{namespace}.{name}").select(*schema.names)
        for name, schema in OPERATIONAL.items()
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    namespace: str,
    table: str,
    properties: dict[str, str],
    id_range: tuple[int, int],
    partitions: int,
) -> DataFrame:
    """One operational table over JDBC, split by id ranges so that no task reads it whole."""
    low, high = id_range
    return spark.read.jdbc(
        url,
        f"{namespace}.{table}",
        column="id",
        lowerBound=low,
        upperBound=high,
        numPartitions=partitions,
        properties=properties,
    ).select(*OPERATIONAL[table].names)
