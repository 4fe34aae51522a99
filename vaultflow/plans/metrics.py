"""Rates, quantiles and alerts over samples (name, ts, value, tags)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Alerts by threshold, comparison and minutes that it must hold.
ALERTS: dict[str, tuple[float, str, int]] = {
    "a_high_failure_rate": (0.05, ">", 5), "a_disk_low": (0.10, "<", 10), "a_workers_stalled": (0.0, ">", 10), "a_sql_p95_high": (5000.0, ">", 5), "a_queue_saturated": (0.9, ">", 15),
}


def bucket(ts: str, minutes: int) -> Column:
    """The start of the tumbling window that holds ts."""
    return F.window(F.col(ts), f"{minutes} minutes")["start"].cast("timestamp_ntz")


def rate(samples: DataFrame, ts: str, minutes: int = 5, value: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """bucket, by, n and per_second: how many samples, or how much of value, a second of each window brings."""
    total = F.count(F.lit(1)).cast("double") if value is None else F.sum(value)
    g = samples.groupBy(bucket(ts, minutes).alias("bucket"), *by).agg(total.alias("total"), F.count(F.lit(1)).alias("n"))
    return g.select("bucket", *by, "n", (F.col("total") / F.lit(60.0 * minutes)).alias("per_second"))


def failure_ratio(samples: DataFrame, ts: str, failed: Column, minutes: int = 5, floor: float = 1.0) -> DataFrame:
    """Failures a second over all samples a second, of which there are taken to be floor at least."""
    seconds = F.lit(60.0 * minutes)
    g = samples.groupBy(bucket(ts, minutes).alias("bucket")).agg(F.sum(F.when(failed, 1).otherwise(0)).alias("f"), F.count(F.lit(1)).alias("n"))
    return g.select("bucket", ((F.col("f") / seconds) / F.greatest(F.col("n") / seconds, F.lit(floor))).alias("failure_ratio"))


def quantiles(samples: DataFrame, value: str, by: tuple[str, ...], qs: tuple[float, ...] = (0.5, 0.95, 0.99), exact: bool = False) -> DataFrame:
    """Quantiles of raw samples: exact ones keep every distinct value of a group, the others a sketch of fixed size."""
    f = (lambda q: F.percentile(value, F.lit(q))) if exact else (lambda q: F.percentile_approx(value, q, 10_000))
    return samples.groupBy(*by).agg(*(f(q).alias(f"p{round(100 * q)}") for q in qs))


def latest(samples: DataFrame, ts: str, tie: str, *by: str) -> DataFrame:
    """by and the value of the last sample, by time and then tie: what a gauge shows."""
    return samples.groupBy(*by).agg(F.max_by("value", F.struct(ts, tie)).alias("value"))


def clamped_ratio(df: DataFrame, part: str, rest: str, by: tuple[str, ...] = ()) -> DataFrame:
    """part over max(part + rest, 1), of sums."""
    g = df.groupBy(*by).agg(F.sum(part).alias("a"), F.sum(rest).alias("b"))
    return g.select(*by, (F.col("a") / F.greatest(F.col("a") + F.col("b"), F.lit(1))).alias("ratio"))


def alerts(series: DataFrame, threshold: float, comparison: str, hold_minutes: int, step_minutes: int = 1, by: tuple[str, ...] = (), ts: str = "bucket", value: str = "value") -> DataFrame:
    """Islands of samples beyond threshold: by, started, ended, samples, peak, fired. Samples more than a step apart
    end an island; it fires when it lasts hold_minutes."""
    beyond = F.col(value) > threshold if comparison == ">" else F.col(value) < threshold
    w = Window.partitionBy(*by).orderBy(ts)
    at = F.unix_timestamp(F.col(ts).cast("timestamp"))
    marked = series.withColumns({"__beyond": F.coalesce(beyond, F.lit(False)), "__at": at})
    apart = F.col("__at") - F.lag("__at").over(w) > step_minutes * 60
    starts = F.col("__beyond") & (F.lag("__beyond").over(w).isNull() | ~F.lag("__beyond").over(w) | apart)
    island = F.sum(F.when(starts, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    peak = F.max(value) if comparison == ">" else F.min(value)
    g = marked.withColumn("__island", island).filter("__beyond").groupBy(*by, "__island").agg(F.min(ts).alias("started"), F.max(ts).alias("ended"), F.count(F.lit(1)).alias("samples"), peak.alias("peak"), (F.max("__at") - F.min("__at")).alias("__long"))
    return g.select(*by, "started", "ended", "samples", "peak", (F.col("__long") + step_minutes * 60 >= hold_minutes * 60).alias("fired"))


def alert(name: str, series: DataFrame, **how) -> DataFrame:
    threshold, comparison, minutes = ALERTS[name]
    return alerts(series, threshold, comparison, minutes, **how)
