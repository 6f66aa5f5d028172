"""Reviews arriving as files, loaded batch by batch."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from scdstar.plans.batch import Pipeline
from scdstar.session import shared_folder
from scdstar.sources.reviews import read_staged_reviews

# Fixed value: time between incremental loads.
CADENCE = "5 minutes"

#: What Spark tells of a file; its content is not read.
FILES = "path string, modificationTime timestamp, length bigint, content binary"


def utc_now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")


def load_every(
    pipeline: Pipeline,
    operational: Callable[[], Mapping[str, DataFrame]],
    every: str = CADENCE,
    checkpoint: str | None = None,
    clock: Callable[[], str] = utc_now,
) -> StreamingQuery:
    """Load the operational tables every interval, whether or not review files arrive.

    A rate source is the clock: its rows are not used. For an outside scheduler,
    ``pipeline.run_batch(operational(), None, utc_now())`` is the same without a stream.
    """
    spark = pipeline.spark

    def load(rows: DataFrame, epoch: int) -> None:
        # An epoch that is replayed after a failure is loaded once.
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        pipeline.run_epoch(f"timed/{query}", epoch, operational(), None, clock())

    return (
        spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        .writeStream.queryName(f"timed_{pipeline.names.warehouse}")
        .foreachBatch(load)
        .option(
            "checkpointLocation",
            checkpoint or f"{shared_folder(spark)}/streams/timed_{pipeline.names.warehouse}",
        )
        .trigger(processingTime=every)
        .start()
    )


def stream_reviews(
    pipeline: Pipeline,
    folder: str,
    name: str = "reviews",
    operational: Callable[[], Mapping[str, DataFrame]] = dict,
    checkpoint: str | None = None,
    every: str | None = CADENCE,
    clock: Callable[[], str] = utc_now,
) -> StreamingQuery:
    """Load each set of new review files in ``folder`` as one batch.

    ``operational`` supplies the operational tables to load along with them. With
    ``every=None`` the files there are loaded and the query stops. All state is in
    the warehouse, so there is no watermark; an epoch that is replayed after a
    failure is loaded once. A stream with a new checkpoint loads all files it finds.
    """
    # The stream tells which files are new, whose names the driver lists anyway; contents are read
    # by the split reader, so that a large file is many tasks.
    files = pipeline.spark.readStream.schema(FILES).format("binaryFile").load(folder).select("path")

    def load(rows: DataFrame, epoch: int) -> None:
        # Epochs count within a checkpoint, which keeps the id of the query.
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", r.path) for r in rows.collect()]
        reviews = read_staged_reviews(pipeline.spark, paths, split=True) if paths else None
        pipeline.run_epoch(f"{name}/{query}", epoch, operational(), reviews, clock())

    writer = (
        files.writeStream.queryName(name)
        .foreachBatch(load)
        .option(
            "checkpointLocation", checkpoint or f"{shared_folder(pipeline.spark)}/streams/{name}"
        )
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
