"""Namespaces, tables and sinks in the session catalog.

A logical table is a view over physical ones: the parts that batches wrote, named after the
batch, without what was removed since. Closed versions go to one append-only history table
per warehouse table, partitioned by the batch that closed them; removed dimension keys likewise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scdstar.operators.lineage import stamp_inserted


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def create_namespace(spark: SparkSession, namespace: str, root: str | None = None) -> None:
    """Create the namespace if missing, under ``root`` if given, else where the
    catalog puts it."""
    location = f" LOCATION '{root}/{namespace}'" if root else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}{location}")


def ensure_namespace(
    spark: SparkSession,
    namespace: str,
    tables: Mapping[str, T.StructType],
    root: str | None = None,
) -> None:
    """Create the namespace and its missing tables, empty."""
    create_namespace(spark, namespace, root)
    for name, schema in tables.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {namespace}.{name} ({_columns(schema)}) USING parquet"
        )


def ensure_versioned(
    spark: SparkSession,
    namespace: str,
    tables: Mapping[str, T.StructType],
    root: str | None = None,
) -> None:
    """Create the namespace and, for each missing logical table, an empty first part."""
    create_namespace(spark, namespace, root)
    missing = {n: s for n, s in tables.items()
               if not spark.catalog.tableExists(f"{namespace}.{n}")}
    ensure_namespace(spark, namespace, {f"{n}__v0": s for n, s in missing.items()})
    for name in missing:
        publish(spark, namespace, name, f"SELECT * FROM {namespace}.{name}__v0")


def wipe_namespace(spark: SparkSession, namespace: str) -> None:
    """Drop the namespace with everything in it."""
    spark.sql(f"DROP DATABASE IF EXISTS {namespace} CASCADE")


def reset_namespace(
    spark: SparkSession,
    namespace: str,
    tables: Mapping[str, T.StructType],
    root: str | None = None,
) -> None:
    """Drop the namespace and create it anew with empty versioned tables."""
    wipe_namespace(spark, namespace)
    ensure_versioned(spark, namespace, tables, root)


def truncate_namespace(spark: SparkSession, namespace: str) -> None:
    """Empty every table of the namespace."""
    for table in spark.catalog.listTables(namespace):
        if table.tableType != "VIEW" and not table.isTemporary:
            spark.sql(f"TRUNCATE TABLE {namespace}.{table.name}")


def append_by_name(df: DataFrame, table: str) -> None:
    """Append to an existing table, matching columns by name."""
    names = df.sparkSession.table(table).columns
    df.select(*names).write.insertInto(table)


def insert_select(
    df: DataFrame, table: str, insert_id: int, source_id: int, load_ts: str
) -> None:
    """Append a select's rows as newly opened versions."""
    append_by_name(stamp_inserted(df, insert_id, source_id, load_ts), table)


def begin_staging(spark: SparkSession, namespace: str, root: str | None = None) -> None:
    """Start a staging cycle, dropping what an earlier one left."""
    wipe_namespace(spark, namespace)
    create_namespace(spark, namespace, root)


def stage_rows(df: DataFrame, namespace: str, table: str) -> DataFrame:
    """Write rows to a staging table and read them back.

    Writing all columns also forces every cell to be parsed.
    """
    df.write.saveAsTable(f"{namespace}.{table}")
    return df.sparkSession.table(f"{namespace}.{table}")


def drop_parts(spark: SparkSession, namespace: str, drop: Callable[[str, int], bool]) -> None:
    """Drop the parts ``<table>__v<batch>`` of a namespace for which ``drop(table, batch)`` holds."""
    for found in spark.sql(f"SHOW TABLES IN {namespace}").collect():
        table, _, batch_id = found.tableName.rpartition("__v")
        if table and batch_id.isdigit() and drop(table, int(batch_id)):
            spark.sql(f"DROP TABLE IF EXISTS {namespace}.{found.tableName}")


def parts_from(spark: SparkSession, namespace: str, batch_id: int) -> bool:
    """Whether any part of ``batch_id`` or later is there."""
    names = [r.tableName.rpartition("__v") for r in spark.sql(f"SHOW TABLES IN {namespace}").collect()]
    return any(t and v.isdigit() and int(v) >= batch_id for t, _, v in names)


def ensure_history(
    spark: SparkSession, namespace: str, table: str, schema: T.StructType
) -> None:
    """Create the table that collects closed versions, if missing."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {namespace}.{table}__history ({_columns(schema)})"
        " USING parquet PARTITIONED BY (update_id)"
    )


def ensure_removed(spark: SparkSession, namespace: str, table: str) -> None:
    """Create the table of the keys that were removed from ``table``, if missing."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {namespace}.{table}__gone (gone bigint, update_id int)"
        " USING parquet PARTITIONED BY (update_id)"
    )


def drop_uncommitted(
    spark: SparkSession, namespace: str, tables: Iterable[str], batch_id: int
) -> None:
    """Drop what failed attempts left in tables partitioned by batch: partitions of ``batch_id`` and
    later, whether or not the coming attempt writes to them."""
    for table in tables:
        target = f"{namespace}.{table}"
        if spark.catalog.tableExists(target):
            stale = spark.sql(f"SHOW PARTITIONS {target}").where(
                F.substring_index("partition", "=", -1).cast("int") >= batch_id
            )
            for found in stale.collect():  # of attempts that failed since the last success
                spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({found.partition})")


def add_partition(df: DataFrame, target: str, batch_id: int) -> int:
    """Append a batch's rows to a table partitioned by ``update_id``, replacing those of a
    failed attempt.

    They come few from every part of a table, so they are gathered into files of
    a reasonable size. Returns their number, counted in the new partition.
    """
    spark = df.sparkSession
    spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION (update_id = {batch_id})")
    append_by_name(df.hint("rebalance"), target)
    return spark.table(target).where(F.col("update_id") == batch_id).count()


def read_history(
    spark: SparkSession,
    namespace: str,
    table: str,
    schema: T.StructType,
    batch_id: int,
    since: int = 0,
) -> DataFrame:
    """Versions closed after batch ``since`` and up to ``batch_id``, whole partitions only."""
    rows = spark.table(f"{namespace}.{table}__history")
    chosen = rows.where((rows.update_id > since) & (rows.update_id <= batch_id))
    return chosen.select(*schema.names)


def publish(spark: SparkSession, namespace: str, table: str, select: str) -> None:
    """Point the logical table at a query over physical ones."""
    spark.sql(f"CREATE OR REPLACE VIEW {namespace}.{table} AS {select}")
