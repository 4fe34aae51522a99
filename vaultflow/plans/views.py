"""Views over the tracking relations: what operators look at. as_of stands for "now"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.functions import measures as m
from vaultflow.operators.state import latest_by

_PROGRESS = ("recorded", "succeeded", "failed", "skipped", "bytes_written", "docs_per_sec", "mib_per_sec")


def _now(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def latest_progress(progress: DataFrame) -> DataFrame:
    return latest_by(progress, ["job_id"], "snapshot", "progress_id")


def active_jobs(jobs: DataFrame, progress: DataFrame, as_of: str) -> DataFrame:
    latest = latest_progress(progress).select("job_id", "snapshot", *_PROGRESS, "last_part", "last_ver")
    return (
        jobs.filter(F.col("status").isin("Running", "Paused")).join(latest, "job_id", "left")
        .select("job_id", "job_name", "partition_key", "started", "expected", "status", "snapshot", *_PROGRESS, "last_part", "last_ver", m.seconds_between("started", _now(as_of)).alias("elapsed_seconds"))
    )


def job_summary(jobs: DataFrame, progress: DataFrame, workers: DataFrame, errors: DataFrame, as_of: str) -> DataFrame:
    """All jobs with their latest progress, workers and errors. A job without workers has 0 in total and null active ones, as the
    sum of no rows is null; the same of errors."""
    latest = latest_progress(progress).select("job_id", *_PROGRESS)
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    w = workers.groupBy("job_id").agg(one(F.col("status").isin("Active", "Idle")).alias("active_workers"), F.count(F.lit(1)).alias("total_workers"))
    e = errors.groupBy("job_id").agg(one(F.col("status").isin("New", "Acknowledged", "Investigating")).alias("open_errors"), one(F.col("severity") == "Critical").alias("critical_errors"))
    end = F.coalesce("completed", _now(as_of))
    return (
        jobs.join(latest, "job_id", "left").join(w, "job_id", "left").join(e, "job_id", "left")
        .select("job_id", "job_name", "partition_key", "status", "started", "completed", m.seconds_between("started", end).alias("elapsed_seconds"), "expected", *_PROGRESS,
                "active_workers", F.coalesce("total_workers", F.lit(0)).alias("total_workers"), "open_errors", "critical_errors")
    )


def worker_health(workers: DataFrame, jobs: DataFrame, as_of: str, stale_after: int = 120) -> DataFrame:
    age = m.seconds_between("heartbeat", _now(as_of))
    return workers.join(jobs.select("job_id", "job_name"), "job_id").select(
        "worker_id", "job_id", "job_name", "worker_name", "machine_name", "assigned_partition", "concurrency", "status", "started", "heartbeat", "stopped",
        age.alias("heartbeat_age"), m.health_label("status", "heartbeat", age, stale_after).alias("health"),
    )


def error_summary(errors: DataFrame) -> DataFrame:
    return errors.groupBy("job_id", "category", "severity", "status").agg(F.count(F.lit(1)).alias("error_count"), F.min("occurred").alias("first_seen"), F.max("occurred").alias("last_seen"))


def throughput_hourly(progress: DataFrame) -> DataFrame:
    """Hours of jobs: average rates with six decimals, and the greatest cumulative counters."""
    avg = lambda c: F.avg(c).cast("decimal(38,6)")
    return progress.filter(F.col("snapshot").isNotNull()).groupBy("job_id", m.hour_bucket("snapshot").alias("hour")).agg(
        avg("docs_per_sec").alias("avg_docs_per_sec"), avg("mib_per_sec").alias("avg_mib_per_sec"),
        F.max("recorded").alias("end_recorded"), F.max("succeeded").alias("end_succeeded"), F.max("bytes_written").alias("end_bytes"),
    )


def checkpoint_current(checkpoints: DataFrame, jobs: DataFrame, as_of: str) -> DataFrame:
    return checkpoints.filter("status = 'Active'").join(jobs.select("job_id", "job_name"), "job_id").select(
        "checkpoint_id", "job_id", "job_name", "partition_key", "last_part", "last_ver", "processed", "checkpoint_at", m.seconds_between("checkpoint_at", _now(as_of)).alias("age_seconds")
    )


def audit_recent(audit: DataFrame, n: int = 1000) -> DataFrame:
    return audit.orderBy(F.col("occurred").desc(), F.col("audit_id").desc()).limit(n).drop("status")
