"""Benchmark the headline queries.

Runs each query's full plan into Spark's ``noop`` sink (everything is
computed, nothing is collected) at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` (default 8), and prints one
JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "vehicle_etl",
    "vehicle_metrics",
    "publish_partitioned",
    "merge_vertices",
    "merge_edges",
    "graph_metrics",
    "pagerank",
    "connected_components",
    "popular_products",
    "purchase_graph_etl",
    "run_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from keelson.registry import queries
    from keelson.session import local_session

    spark = local_session(cpus, app="keelson-bench")
    qs = queries()
    # warm up the JVM and the parquet reader outside the timings
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
