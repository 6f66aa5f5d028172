"""Session helpers: defaults, the shared folder, and staged frames."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "scdstar", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back on a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="scdstar-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors and, unlike a cached or
    checkpointed frame, gives the optimizer true file sizes, so that later joins
    broadcast this frame only if it really is small.
    """
    spark = df.sparkSession
    path = "/".join(
        [shared_folder(spark), "scdstar", spark.sparkContext.applicationId,
         f"{name}-{uuid.uuid4().hex}"]
    )
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(run: Callable[[Item], Result], items: Iterable[Item]) -> list[Result]:
    """Submit independent Spark jobs at the same time, so that small tables fill the
    executors a large one leaves idle. Results come in the order of the items."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        # Job groups and local properties go along, so that stopping a query stops its jobs.
        return [f.result() for f in [pool.submit(inheritable_thread_target(run), i) for i in items]]
