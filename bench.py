"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then ``BENCH_RUNS`` (default 3) times; the median
is reported.  A run executes the whole plan through the ``noop`` sink, so nothing
is collected to the driver and the timing is Spark's work only.

``BENCH_EVENT_LOG=<folder>`` writes Spark's event log there (stage and task times
without the web UI).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans import registry  # noqa: E402
from strata.session import build_session, clear_scratch  # noqa: E402

HEADLINE = {
    "q02": registry.q02_nested_lists,
    "q04": registry.q04_posting_fields,
    "q05": registry.q05_tree,
    "q09": registry.q09_hop_metrics,
    "q10": registry.q10_hop_sliced,
    "q11": registry.q11_hop_stream,
    "q14": registry.q14_recent,
    "q15": registry.q15_pivot_cnt,
    "q19": registry.q19_paged_source,
}


def _run(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    conf = {
        "spark.sql.shuffle.partitions": str(int(cpus) * 2),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
    }
    if os.environ.get("BENCH_EVENT_LOG"):
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = build_session("strata-bench", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    results = {}
    for name, fn in HEADLINE.items():
        try:
            _run(spark, fn, sf_dir)  # warm-up
            results[name] = round(statistics.median(_run(spark, fn, sf_dir) for _ in range(runs)), 3)
        except Exception as exc:  # keep measuring the others; report the failure
            print(f"bench: {name} failed: {exc!r}"[:500], file=sys.stderr)
            results[name] = None
        clear_scratch(spark)
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(v for v in results.values() if v is not None), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
