"""Job contract and runner with run metrics.

A job is three functions over a caller-supplied session and a flat
``dict[str, str]`` of properties:

* ``logic(spark, props) -> DataFrame`` - lazy plan of the result;
* ``output(spark, df, props) -> dict[str, int]`` - persist it, returning
  record counts observed during the write (no second pass);
* ``metrics(spark, df, props) -> DataFrame | None`` - business metrics in
  long format (``metric, group_key, value, text_value``), or None.

``run_job`` runs them, times the phases and hands the business metrics frame
and a ``RunMetrics`` record to a reporter. On failure the FAILED record is
reported before the error is re-raised.
"""

from __future__ import annotations

import sys
import time
import traceback
import uuid
from dataclasses import dataclass, field, replace
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "job_id string, etl_class string, name string, start_time bigint, end_time bigint, "
    "duration_ms bigint, status string, record_counts map<string,bigint>, "
    "timings map<string,bigint>, error_details string"
)


class Job(Protocol):
    def logic(self, spark: SparkSession, props: dict[str, str]) -> DataFrame: ...

    def output(self, spark: SparkSession, df: DataFrame, props: dict[str, str]) -> dict[str, int]: ...

    def metrics(self, spark: SparkSession, df: DataFrame, props: dict[str, str]) -> DataFrame | None: ...


@dataclass(frozen=True)
class RunMetrics:
    job_id: str
    etl_class: str
    name: str
    start_time: int
    end_time: int | None = None
    status: str = "RUNNING"
    record_counts: dict[str, int] = field(default_factory=dict)
    timings: dict[str, int] = field(default_factory=dict)
    error_details: str | None = None

    @property
    def duration_ms(self) -> int | None:
        return None if self.end_time is None else self.end_time - self.start_time

    def with_count(self, phase: str, n: int) -> RunMetrics:
        return replace(self, record_counts={**self.record_counts, phase: int(n)})

    def with_timing(self, phase: str, ms: int) -> RunMetrics:
        return replace(self, timings={**self.timings, phase: int(ms)})

    def finished(self, status: str, error: str | None = None) -> RunMetrics:
        return replace(self, status=status, error_details=error, end_time=_now_ms())

    def as_tuple(self) -> tuple:
        return (self.job_id, self.etl_class, self.name, self.start_time, self.end_time,
                self.duration_ms, self.status, dict(self.record_counts), dict(self.timings),
                self.error_details)


def _now_ms() -> int:
    return int(time.time() * 1000)


def parse_properties(args: list[str]) -> dict[str, str]:
    """``key=value`` arguments -> dict; split on the first ``=``; later keys
    win; malformed arguments are reported and skipped."""
    props: dict[str, str] = {}
    for arg in args:
        key, sep, value = arg.partition("=")
        if not sep:
            print(f"skipped argument {arg!r}: not of the form key=value", file=sys.stderr)
            continue
        props[key] = value
    return props


class ConsoleReporter:
    """Prints the run record and every business metric, streamed row by row."""

    def business(self, spark: SparkSession, run: RunMetrics, business: DataFrame) -> None:
        print(f"business metrics of run {run.job_id}: {', '.join(business.columns)}")
        for row in business.toLocalIterator():
            print("  " + ", ".join("" if v is None else str(v) for v in row))

    def run(self, spark: SparkSession, run: RunMetrics) -> None:
        print(f"run {run.job_id} ({run.etl_class}, {run.name}): {run.status}")
        print(f"  duration_ms={run.duration_ms} records={run.record_counts} timings={run.timings}")
        if run.error_details:
            print(f"  error: {run.error_details}")


class TableReporter:
    """Appends the business metrics (tagged with the job id) to
    ``{path}/business_metrics`` and the run record to ``{path}/runs``, as Parquet."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def business(self, spark: SparkSession, run: RunMetrics, business: DataFrame) -> None:
        (business.select(F.lit(run.job_id).alias("job_id"), "*")
         .write.mode("append").parquet(f"{self.path}/business_metrics"))

    def run(self, spark: SparkSession, run: RunMetrics) -> None:
        spark.createDataFrame([run.as_tuple()], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.path}/runs")


def create_reporter(props: dict[str, str]):
    kind = props.get("metrics-reporter", "console")
    if kind == "table":
        if "metrics-path" not in props:
            raise ValueError("metrics-reporter=table needs metrics-path")
        return TableReporter(props["metrics-path"])
    if kind != "console":
        print(f"no reporter is called {kind!r}; the console is used", file=sys.stderr)
    return ConsoleReporter()


def run_job(spark: SparkSession, job: Job, props: dict[str, str] | None = None,
            reporter=None, raise_errors: bool = True) -> RunMetrics:
    """logic -> output (record counts observed on the write) -> business
    metrics, each timed. Metrics are evaluated (handed to the reporter's
    ``business``) inside the run, so a metrics frame that fails makes the run
    FAILED. The run record is handed over last, and always."""
    props = dict(props or {})
    run = RunMetrics(
        job_id=props.get("job-id", str(uuid.uuid4())),
        etl_class=f"{type(job).__module__}.{type(job).__name__}",
        name=props.get("metrics-name", "ETL Run"),
        start_time=_now_ms(),
    )
    reporter = reporter or create_reporter(props)
    error: Exception | None = None
    try:
        start = _now_ms()
        df = job.logic(spark, props)
        run = run.with_timing("logic", _now_ms() - start)
        start = _now_ms()
        counts = job.output(spark, df, props) or {}
        run = run.with_timing("output", _now_ms() - start)
        for phase, n in counts.items():
            run = run.with_count(phase, n)
        start = _now_ms()
        business = job.metrics(spark, df, props)
        if business is not None:
            reporter.business(spark, run, business)
        run = run.with_timing("metrics", _now_ms() - start).finished("SUCCESS")
    except Exception as exc:  # report, then re-raise
        error = exc
        run = run.finished("FAILED", f"{type(exc).__module__}.{type(exc).__name__}: {exc}")
    try:
        reporter.run(spark, run)
    except Exception as lost:
        if error is None:
            raise
        error.add_note(f"the run record could not be written: {lost}")  # the job's own error is what counts
    if error is not None:
        if raise_errors:
            raise error
        traceback.print_exception(error)
    return run
