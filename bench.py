"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  One untimed pass over all
queries comes first, so the timed pass measures steady-state execution, not
the one-off generation and JIT compilation of each new plan shape (which
is negligible on a long job over large data).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["M2", "K1", "K4", "K7", "K10_parts", "K2", "K6", "K8", "K9", "K5_test",
            "K10_docs", "K11_docs", "T10_docs", "T11_docs"]
# the whole vocabulary on postings and documents, timed in addition
TEXT = ["T4_docs", "T5_docs", "T7_docs", "T8_docs", "T10", "T11", "K10", "K11"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from payscope.plans.catalog import QUERIES
    from payscope.session import build_session

    spark = build_session(master=f"local[{cpus}]", app="payscope-bench",
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)), driver_memory="16g",
                          # the test tables are one file each: spread their scans over the cores
                          extra={"payscope.scan.partitions": str(cpus)})
    names = sys.argv[1:] or HEADLINE + TEXT
    for name in names:  # warm-up pass, not timed
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
