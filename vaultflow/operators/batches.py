"""Batch runs: results of batches, the failure gate, retry schedules and the circuit breaker."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow.functions import guards
from vaultflow.functions.measures import RETRYABLE, backoff, ratio
from vaultflow.schemas import FAILED, SKIPPED, SUCCEEDED


def batch_results(items: DataFrame) -> DataFrame:
    """items (batch_no, status, bytes_written, seconds) to one row a batch. Bytes are those of succeeded items."""
    one = lambda s: F.sum(F.when(F.col("status") == s, 1).otherwise(0)).cast("bigint")
    g = items.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("size"), one(SUCCEEDED).alias("succeeded"), one(FAILED).alias("failed"), one(SKIPPED).alias("skipped"),
        F.coalesce(F.sum(F.when(F.col("status") == SUCCEEDED, F.col("bytes_written"))), F.lit(0)).cast("bigint").alias("bytes_written"), F.max("seconds").alias("seconds"),
    )
    return g.withColumns({"failure_rate": ratio("failed", "size"), "items_per_sec": F.when(F.col("seconds") > 0, F.col("size") / F.col("seconds")).otherwise(F.lit(0.0))})


def run_summary(results: DataFrame, threshold: float) -> DataFrame:
    """Totals of the batches that run: all up to and with the first whose failure rate is above threshold."""
    guards.within("failure_threshold", threshold)
    stop = results.filter(F.col("failure_rate") > threshold).agg(F.min("batch_no").alias("stopped_at"))
    ran = results.crossJoin(F.broadcast(stop)).filter(F.col("stopped_at").isNull() | (F.col("batch_no") <= F.col("stopped_at")))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    return ran.agg(
        F.count(F.lit(1)).alias("batches"), total("size"), total("succeeded"), total("failed"), total("skipped"), total("bytes_written"), F.max("stopped_at").alias("stopped_at")
    ).withColumn("stopped", F.col("stopped_at").isNotNull())


@dataclass(frozen=True)
class RetryProfile:
    attempts: int = 5
    base_seconds: float = 0.5
    cap_seconds: float = 30.0
    jitter: float = 0.2


# Attempts by category; they only ever lower those of a profile.
CATEGORY_ATTEMPTS = {"SqlDeadlock": 8, "DiskFull": 2, "RateLimited": 6}


def retry_schedule(failures: DataFrame, profile: RetryProfile = RetryProfile(), seed: int = 0) -> DataFrame:
    """failures (key, category, attempt) with retry (bool) and wait_seconds; the draw comes from key, attempt and seed."""
    guards.within("retry_attempts", profile.attempts)
    most = F.lit(profile.attempts)
    for category, n in CATEGORY_ATTEMPTS.items():
        most = F.when(F.col("category") == category, F.lit(min(n, profile.attempts))).otherwise(most)
    draw = F.pmod(F.xxhash64(F.col("key"), F.col("attempt"), F.lit(seed)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    again = F.col("category").isin(*RETRYABLE) & (F.col("attempt") < most)
    return failures.withColumns({"retry": again, "wait_seconds": F.when(again, backoff("attempt", profile.base_seconds, profile.cap_seconds, profile.jitter, draw))})


@dataclass(frozen=True)
class BreakerSettings:
    least_calls: int = 20
    failure_ratio: float = 0.5
    window_seconds: float = 30.0
    open_seconds: float = 30.0


def replay_breaker(calls: DataFrame, settings: BreakerSettings = BreakerSettings()) -> DataFrame:
    """calls (operation, ts, id, ok) to operation, id, ts, ok, allowed, state (after the call), in their order of (ts, id).

    A state machine over time needs its calls in order: one group for each operation, streamed through in sorted
    batches, with a few numbers as its state. A call that an open breaker refuses changes nothing."""

    schema = "operation string, id bigint, ts timestamp_ntz, ok boolean, allowed boolean, state string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        operation, state, since, opened, good, bad = None, "Closed", None, None, 0, 0
        for df in batches:
            rows = []
            for op, i, ts, ok in zip(df["operation"], df["id"], df["ts"], df["ok"]):
                if op != operation:
                    operation, state, since, opened, good, bad = op, "Closed", ts, None, 0, 0
                if state == "Open":
                    if (ts - opened).total_seconds() < settings.open_seconds:
                        rows.append((op, i, ts, ok, False, state))
                        continue
                    state, since, good, bad = "HalfOpen", ts, 0, 0
                if (ts - since).total_seconds() >= settings.window_seconds:
                    since, good, bad = ts, 0, 0
                good, bad = good + bool(ok), bad + (not ok)
                trips = not ok and (state == "HalfOpen" or (good + bad >= settings.least_calls and bad / (good + bad) >= settings.failure_ratio))
                if trips:
                    state, opened, since, good, bad = "Open", ts, ts, 0, 0
                elif ok and state == "HalfOpen":
                    state, since, good, bad = "Closed", ts, 0, 0
                rows.append((op, i, ts, ok, True, state))
            yield pd.DataFrame(rows, columns=["operation", "id", "ts", "ok", "allowed", "state"])

    ordered = calls.select("operation", "id", "ts", "ok").repartition("operation").sortWithinPartitions("operation", "ts", "id")
    return ordered.mapInPandas(run, schema)
