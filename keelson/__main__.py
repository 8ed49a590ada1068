"""Command line: ``spark-submit -m keelson <job> key=value ...`` or
``python -m keelson <job> key=value ...``.

``<job>`` is ``vehicle``, ``purchase-graph`` or a ``module:Class`` path of
a class with the job methods. The session is the one spark-submit
configured (``getOrCreate``); no master or warehouse is hard-coded. Exit
status 1 on failure, after the FAILED run record has been reported.
"""

from __future__ import annotations

import importlib
import sys

from pyspark.sql import SparkSession

from keelson.plans import PurchaseGraphJob, VehicleJob, parse_properties, run_job

JOBS = {"vehicle": VehicleJob, "purchase-graph": PurchaseGraphJob}


def load_job(name: str):
    if name in JOBS:
        return JOBS[name]()
    module, sep, cls = name.partition(":")
    if not sep:
        raise SystemExit(f"unknown job {name!r}: use {sorted(JOBS)} or module:Class")
    return getattr(importlib.import_module(module), cls)()


def main(argv: list[str]) -> int:
    if not argv:
        print("usage: python -m keelson <job> [key=value ...]", file=sys.stderr)
        return 1
    job = load_job(argv[0])
    props = parse_properties(argv[1:])
    spark = SparkSession.builder.appName(props.get("metrics-name", argv[0])).getOrCreate()
    try:
        run = run_job(spark, job, props, raise_errors=False)
    finally:
        spark.stop()
    return 0 if run.status == "SUCCESS" else 1


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
