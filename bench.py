"""Time the loads and every registered query; print one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from scdstar.plans.batch import Namespaces, Pipeline
from scdstar.plans.two_batches import two_batches
from scdstar.queries import QUERIES
from scdstar.session import local_session
from scdstar.sources.testdata import LOAD_TS, snapshot


def timed(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(
        cores,
        "bench",
        **{
            "spark.sql.shuffle.partitions": str(cores),
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/shared",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    times: dict[str, float] = {}
    pipeline = Pipeline(spark, Namespaces())
    times["initial_load"] = timed(
        lambda: pipeline.run_initial(*snapshot(spark, folder, 1), LOAD_TS[1])
    )
    times["incremental_load"] = timed(
        lambda: pipeline.run_batch(*snapshot(spark, folder, 2), LOAD_TS[2])
    )

    loads = two_batches(spark, folder)
    loads.warehouse(1), loads.warehouse(2), loads.star(1), loads.star(2)
    # What the batch queries read is loaded by the pipeline timed above.
    chosen = sys.argv[1:] or [name for name in QUERIES if not name.startswith("batch_")]
    for name in chosen:
        times[name] = timed(
            lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
