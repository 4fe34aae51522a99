"""Reports on a job: the one named, or the most recent one that runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.functions import measures as m
from vaultflow.functions.paths import left, truncated


def target_job(jobs: DataFrame, job_id: int | None = None, statuses: tuple[str, ...] = ("Running",), any_status: bool = False) -> DataFrame:
    """At most one row. any_status: without a job of those statuses, the most recent one of any."""
    if job_id is not None:
        return jobs.filter(F.col("job_id") == job_id).select("job_id").limit(1)
    wanted = F.col("status").isin(*statuses)
    if any_status:
        return jobs.orderBy(wanted.desc(), F.col("started").desc(), F.col("job_id").desc()).select("job_id").limit(1)
    return jobs.filter(wanted).orderBy(F.col("started").desc(), F.col("job_id").desc()).select("job_id").limit(1)


def _of_target(df: DataFrame, target: DataFrame) -> DataFrame:
    return df.join(F.broadcast(target), "job_id", "left_semi")  # one row at most


def _since(since: str | None, col: str) -> Column:
    return F.lit(True) if since is None else F.col(col) >= F.lit(since).cast("timestamp_ntz")


def status_summary(summary: DataFrame, target: DataFrame) -> DataFrame:
    zero = lambda c, name=None: F.coalesce(F.col(c), F.lit(0).cast(summary.schema[c].dataType)).alias(name or c)
    return _of_target(summary, target).select(
        "job_id", "job_name", "partition_key", "status", "started", "completed", m.elapsed_hms("elapsed_seconds").alias("elapsed"), m.elapsed_dhms("elapsed_seconds").alias("elapsed_days"),
        zero("expected"), zero("recorded", "processed"), m.remaining("expected", "recorded").alias("remaining"), zero("succeeded"), zero("failed"), zero("skipped"), zero("bytes_written"),
        zero("docs_per_sec"), zero("mib_per_sec"), m.percent(F.coalesce("recorded", F.lit(0)), "expected").alias("pct_complete"),
        m.eta_by_rate("expected", "recorded", "docs_per_sec").alias("eta_seconds"), zero("active_workers"), zero("total_workers"), zero("open_errors"), zero("critical_errors"),
    )


def outcomes_breakdown(summary: DataFrame, target: DataFrame) -> DataFrame:
    """Three rows, from one pass: outcome, n, pct."""
    rows = _of_target(summary, target).selectExpr("recorded", "stack(3, 'Succeeded', succeeded, 'Failed', failed, 'Skipped', skipped) AS (outcome, n)")
    return rows.select("outcome", "n", m.percent("n", "recorded").alias("pct"))


def failures_by_category(errors: DataFrame, target: DataFrame | None = None, since: str | None = None, n: int = 20) -> DataFrame:
    rows = (errors if target is None else _of_target(errors, target)).filter(_since(since, "occurred"))
    g = rows.groupBy("category", "severity").agg(F.count(F.lit(1)).alias("occurrences"), F.min("occurred").alias("first_seen"), F.max("occurred").alias("last_seen"), F.max("message").alias("sample"))
    return g.orderBy(F.col("occurrences").desc(), "category", "severity").limit(n)


def cli_failures(errors: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return failures_by_category(errors, target, n=10).withColumn("sample", truncated("sample", 60))


def throughput_by_hour(progress: DataFrame, target: DataFrame) -> DataFrame:
    """What was done in each hour: differences of the counters at the hours' ends (the first hour: from its first snapshot on)."""
    rows = _of_target(progress, target).groupBy("job_id", m.hour_bucket("snapshot").alias("hour")).agg(
        F.max("recorded").alias("r"), F.max("bytes_written").alias("b"), F.min("recorded").alias("r0"), F.min("bytes_written").alias("b0"))
    w = Window.partitionBy("job_id").orderBy("hour")
    d = rows.select("hour", (F.col("r") - F.coalesce(F.lag("r").over(w), F.col("r0"))).alias("docs_processed"), (F.col("b") - F.coalesce(F.lag("b").over(w), F.col("b0"))).alias("bytes_written"))
    per = lambda c, by, kind: (F.col(c).cast("decimal(38,6)") / F.lit(by)).cast(kind)
    return d.select("hour", "docs_processed", "bytes_written", per("docs_processed", 3600, "decimal(10,2)").alias("avg_docs_per_sec"), (F.col("bytes_written") / F.lit(3600.0 * m.MIB)).cast("decimal(10,3)").alias("avg_mib_per_sec"))


def recent_errors(errors: DataFrame, workers: DataFrame, target: DataFrame | None = None, since: str | None = None, n: int = 100) -> DataFrame:
    rows = (errors if target is None else _of_target(errors, target)).filter(_since(since, "occurred")).orderBy(F.col("occurred").desc(), F.col("error_id").desc()).limit(n)
    named = rows.join(workers.select("worker_id", "worker_name"), "worker_id", "left")
    return named.select("error_id", "occurred", "category", "severity", "status", "part", "ver", "dfv", "worker_name", left("message", 500).alias("message"), left(F.coalesce("stack_trace", F.lit("")), 200).alias("stack_hint"))


def worker_report(health: DataFrame, target: DataFrame | None = None) -> DataFrame:
    rows = health if target is None else _of_target(health, target)
    return rows.withColumn("health_rank", m.health_rank("health")).orderBy("health_rank", "worker_name")


def active_report(summary: DataFrame) -> DataFrame:
    zero = lambda c, name=None: F.coalesce(F.col(c), F.lit(0).cast(summary.schema[c].dataType)).alias(name or c)
    return summary.filter("status = 'Running'").select(
        "job_id", "job_name", "partition_key", "status", "started", m.elapsed_hours("elapsed_seconds").alias("elapsed_hours"), zero("expected"), zero("recorded", "processed"), zero("failed"),
        zero("active_workers"), zero("open_errors"), zero("docs_per_sec"),
    ).orderBy(F.col("started").desc(), "job_id")


def checkpoint_report(current: DataFrame) -> DataFrame:
    return current.select("partition_key", "last_part", "last_ver", "processed", "checkpoint_at", "age_seconds").orderBy("partition_key")


def job_statistics(jobs: DataFrame, latest: DataFrame, job_id: int) -> DataFrame:
    """The job with its latest progress, found = false and nulls if there is none."""
    one = jobs.sparkSession.range(1).select(F.lit(job_id).cast("bigint").alias("job_id"))
    j = jobs.select("job_id", "job_name", "status", "expected").withColumn("found", F.lit(True))
    return one.join(j, "job_id", "left").join(latest.select("job_id", "recorded", "succeeded", "failed", "docs_per_sec"), "job_id", "left").withColumn("found", F.coalesce("found", F.lit(False)))
