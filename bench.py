"""Benchmark the headline queries; prints one JSON line.

Each query runs to completion through Spark's ``noop`` sink (the whole plan
executes, nothing is collected to the driver).  Every query is run once to
warm the JVM and then timed over ``BENCH_REPEAT`` runs (best time kept).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2), BENCH_QUERIES (comma list, default the headline set).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimflow.plans.catalog import QUERIES  # noqa: E402
from claimflow.plans.ocr import run_ocr  # noqa: E402
from claimflow.session import get_session, scratch_path  # noqa: E402
from claimflow.sources.fixtures import REP_END, entities  # noqa: E402

HEADLINE = ("ocr_report", "acr_report", "payment_rollup", "latest_diagnosis", "relate_paths",
            "run_ocr")


def run(spark, name: str, sf_dir: str) -> None:
    """One run to completion; ``run_ocr`` is the production run, audited, to a CSV folder."""
    if name == "run_ocr":
        run_ocr(entities(spark, sf_dir), REP_END, [scratch_path(spark, "bench-report")])
    else:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    shared = tempfile.TemporaryDirectory(prefix="claimflow-bench-")
    spark = get_session(f"local[{cpus}]", app_name="claimflow-bench",
                        shuffle_partitions=cpus * 2,
                        **{"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                           "spark.checkpoint.dir": f"file://{shared.name}/checkpoints",
                           "spark.sql.warehouse.dir": f"file://{shared.name}/warehouse"})
    times = {}
    for name in names:
        run(spark, name, sf_dir)  # warm-up
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(spark, name, sf_dir)
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
