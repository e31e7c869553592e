"""Benchmark the headline queries.

Runs every query registered with ``bench=True`` on ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one
JSON line.  Each query is executed in full with the ``noop`` sink, so the
whole plan runs without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.plans import registry  # noqa: E402
from tidemill.session import build_session  # noqa: E402

EXTRA_QUERIES = ("c01_inner_join", "d01_reduce_by_key", "e03_global_rank", "c13_context_join", "k11_sequence_pattern")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
             "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)}
    spark = build_session(f"local[{cpus}]", 2 * cpus, app_name="tidemill-bench", extra=extra)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemill-bench-ckpt-"))
    names = [n for n, q in registry.QUERIES.items() if q.bench] + list(EXTRA_QUERIES)
    # warm-up: JVM, codegen and file listing
    registry.QUERIES["d14_count"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        registry.QUERIES[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
