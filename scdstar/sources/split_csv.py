"""CSV files with line breaks inside quoted cells, read by many tasks a file.

A line break ends a record only outside quotes, so a file cannot be cut at line breaks by looking at
one place, and Spark's multi-line reader gives a whole file to one task. But quotes come in
pairs: a line begins a record if an even number of quotes stands before it. So

1. each range of a file that a task reads counts its quotes (one row for a range);
2. the parity of the ranges before tells for each range whether it begins inside a cell;
3. each range numbers its records and puts their lines together;
4. a record that goes on in the next ranges is joined with the lines they begin with: two
   pieces for a range at most.

Then Spark's CSV parser reads each record by itself. Files follow RFC 4180: a quote opens or closes
a cell, or is doubled inside one. A file that ends inside a cell fails the read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from scdstar.session import stage

RANGE = ("file", "start", "length")


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines as they stand in the files, with the range each was read in, in its order."""
    text = spark.read.text(path if isinstance(path, str) else list(path), lineSep="\n")
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        "value",
        F.monotonically_increasing_id().alias("line"),  # grows within a range
    ).withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'))))


def _ranges(lines: DataFrame) -> DataFrame:
    """For each range with a line, whether it begins inside a cell."""
    counted = lines.groupBy(*RANGE).agg((F.sum("quotes") % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    checked = F.when(
        F.sum("odd").over(whole) % 2 == 0, F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    ).otherwise(
        F.raise_error(F.concat(F.lit("a cell is not closed in "), F.col("file"))).cast("long")
    )
    return counted.select(*RANGE, checked.alias("inside"))


def _joined(order: str, value: str) -> Column:
    """The values of a group as lines of one text, in order."""
    pairs = F.array_sort(F.collect_list(F.struct(order, value)))
    return F.array_join(F.transform(pairs, lambda p: p[value]), "\n")


def records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The records of CSV files as texts: ``file``, ``start`` (of the range it begins in),
    ``record`` (counting from 1 in the range) and ``value``."""
    lines = _lines(spark, path)
    ranges = stage(_ranges(lines), "csv-ranges")
    # Both scans cut the files alike unless the cluster grew in between.
    inside = F.coalesce(
        "inside",
        F.raise_error(F.lit("files were cut anew: set spark.sql.files.minPartitionNum")).cast("long"),
    )
    in_range = Window.partitionBy("file", "start").orderBy("line")
    before = in_range.rowsBetween(Window.unboundedPreceding, -1)
    begins = (F.col("inside") + F.coalesce(F.sum("quotes").over(before), F.lit(0))) % 2 == 0
    numbered = (
        lines.join(ranges, list(RANGE), "left").withColumn("inside", inside)
        .withColumn("begins", begins.cast("int"))
        .withColumn("record", F.sum("begins").over(in_range.rowsBetween(Window.unboundedPreceding, 0)))
    )
    # Grouped within the ranges that the windows have gathered: no further shuffle.
    pieces = numbered.groupBy("file", "start", "record").agg(
        _joined("line", "value").alias("value"), (F.sum("quotes") % 2 == 1).alias("odd")
    )
    # Record 0 is what a range begins with inside a cell; a record with an odd number of quotes goes on.
    cut = (F.col("record") == 0) | F.col("odd")
    whole = pieces.where(~cut).select("file", "start", "record", "value")
    in_file = Window.partitionBy("file").orderBy("start", "record")
    joined = (
        pieces.where(cut)
        .withColumn("run", F.sum((F.col("record") > 0).cast("int")).over(
            in_file.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("file", "run")
        .agg(F.min(F.struct("start", "record")).alias("first"), _joined("start", "value").alias("value"))
        .select("file", "first.start", "first.record", "value")
    )
    return whole.unionByName(joined).withColumn("value", F.regexp_replace("value", "\r$", ""))


def read_split_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, header: bool = True
) -> DataFrame:
    """CSV files with the columns of ``schema``, bound by position. A record with more or fewer
    cells fails the read; empty records are none."""
    found = records(spark, path).where("value <> ''")
    if header:
        found = found.where((F.col("start") > 0) | (F.col("record") > 1))
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    # As a generator, for else conditions on cells are pushed down with a parse of their own each.
    return found.select(F.inline(F.array(F.from_csv("value", ddl, options))))
