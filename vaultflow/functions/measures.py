"""Times, rates, estimates, back-off and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultflow.functions.keys import _col

MIB = 1024.0 * 1024.0


def seconds_between(start, end) -> Column:
    """Second boundaries crossed from start to end."""
    whole = lambda t: F.unix_timestamp(F.date_trunc("second", _col(t)).cast("timestamp"))
    return whole(end) - whole(start)


def hour_bucket(t) -> Column:
    return F.date_trunc("hour", _col(t)).cast("timestamp_ntz")


def elapsed_hms(seconds) -> Column:
    """HH:mm:ss, which starts anew every 24 hours."""
    return F.date_format(F.timestamp_seconds(_col(seconds)), "HH:mm:ss")


def elapsed_dhms(seconds) -> Column:
    """d.HH:mm:ss, which does not."""
    s = _col(seconds)
    return F.concat(F.floor(s / 86_400).cast("string"), F.lit("."), elapsed_hms(s))


def elapsed_hours(seconds) -> Column:
    return (_col(seconds).cast("decimal(18,4)") / F.lit("3600.0").cast("decimal(6,1)")).cast("decimal(9,2)")


def docs_per_second(n, elapsed) -> Column:
    return F.when(_col(elapsed) > 0, _col(n) / _col(elapsed)).otherwise(F.lit(0.0))


def mib_per_second(n_bytes, elapsed) -> Column:
    return F.when(_col(elapsed) > 0, _col(n_bytes) / _col(elapsed) / F.lit(MIB)).otherwise(F.lit(0.0))


def throughput(n, n_bytes, elapsed) -> Column:
    return F.struct(docs_per_second(n, elapsed).alias("docs_per_sec"), mib_per_second(n_bytes, elapsed).alias("mib_per_sec"))


def average_rates(n, n_bytes, started, completed) -> Column:
    """Throughput of a completed run; null before."""
    return F.when(_col(completed).isNotNull(), throughput(n, n_bytes, seconds_between(started, completed)))


def ratio(part, whole) -> Column:
    """part / whole, 0 where there is nothing."""
    return F.when(_col(whole) > 0, _col(part) / _col(whole)).otherwise(F.lit(0.0))


def percent(done, total) -> Column:
    """With two decimals, rounded half up; null where total is null or 0."""
    return F.when(_col(total) != 0, (F.lit("100.0").cast("decimal(4,1)") * _col(done).cast("decimal(18,0)") / _col(total).cast("decimal(18,0)")).cast("decimal(5,2)"))


def remaining(expected, recorded) -> Column:
    return _col(expected) - F.coalesce(_col(recorded), F.lit(0))


def eta_by_rate(expected, recorded, rate) -> Column:
    """Whole seconds left at a rate; null without a rate or an expectation."""
    left = remaining(expected, recorded)
    return F.when((_col(rate) > 0) & _col(expected).isNotNull(), (left / _col(rate)).cast("bigint"))


def eta_linear(expected, recorded, elapsed) -> Column:
    """Seconds left if all goes on as so far: null before the first document or without an expectation, 0 when all is done."""
    e, r = _col(expected), _col(recorded)
    return F.when(e.isNull() | (r <= 0) | (_col(elapsed) <= 0), F.lit(None).cast("double")).when(r >= e, F.lit(0.0)).otherwise((e - r) / (r / _col(elapsed)))


def eta_dashboard(expected, recorded, rate) -> Column:
    e, r = _col(expected), _col(recorded)
    return F.when(e.isNull() | (_col(rate) <= 0), F.lit(None).cast("double")).when(r >= e, F.lit(0.0)).otherwise((e - r) / _col(rate))


def clamped_percent(done, total) -> Column:
    return F.when(_col(total) > 0, F.least(F.greatest(F.lit(100.0) * _col(done) / _col(total), F.lit(0.0)), F.lit(100.0))).otherwise(F.lit(0.0))


def format_bytes(n) -> Column:
    """B, KiB without decimals, MiB with one, GiB and TiB with two."""
    n = _col(n)
    x = n.cast("double")
    return (
        F.when(n < 2**10, F.format_string("%d B", n)).when(n < 2**20, F.format_string("%.0f KiB", x / 2**10)).when(n < 2**30, F.format_string("%.1f MiB", x / 2**20))
        .when(n < 2**40, F.format_string("%.2f GiB", x / 2**30)).otherwise(F.format_string("%.2f TiB", x / 2**40))
    )


def queue_ratio(depth, capacity) -> Column:
    return F.when(_col(capacity) > 0, _col(depth) / _col(capacity))


def utilization(busy, workers) -> Column:
    return ratio(busy, workers)


def backoff(attempt, base: float, cap: float, jitter: float = 0.0, draw=None) -> Column:
    """min(base * 2**min(n - 1, 30), cap) seconds for attempt n >= 1, times 1 +- jitter by a draw from 0 to 1."""
    n = F.least(F.greatest(_col(attempt), F.lit(1)) - 1, F.lit(30))
    wait = F.least(F.lit(float(base)) * F.pow(F.lit(2.0), n), F.lit(float(cap)))
    return wait if draw is None else wait * (F.lit(1.0 - jitter) + F.lit(2.0 * jitter) * _col(draw))


def backoff_policy(attempt, base: float, multiplier: float, cap: float, draw=None) -> Column:
    """base * multiplier**n for attempt n >= 0, capped; a draw from 0 to 1 scales it by 0.75 to 1.25."""
    wait = F.least(F.lit(float(base)) * F.pow(F.lit(float(multiplier)), F.greatest(_col(attempt), F.lit(0))), F.lit(float(cap)))
    return wait if draw is None else wait * (F.lit(0.75) + F.lit(0.5) * _col(draw))


def backoff_conflict_ms(attempt, draw=None) -> Column:
    """250 ms * 2**(n - 1), +- 25 %."""
    wait = F.lit(250.0) * F.pow(F.lit(2.0), F.greatest(_col(attempt), F.lit(1)) - 1)
    return wait if draw is None else wait * (F.lit(0.75) + F.lit(0.5) * F.least(F.greatest(_col(draw), F.lit(0.0)), F.lit(1.0)))


def after_seconds(ts, seconds) -> Column:
    """The time so many seconds after ts."""
    return _col(ts) + F.make_dt_interval(secs=_col(seconds))


def json_or_null(*columns: str) -> Column:
    """A JSON object of the columns, or null where all of them are."""
    return F.when(F.coalesce(*(F.col(c).cast("string") for c in columns)).isNotNull(), F.to_json(F.struct(*columns)))


# Failures by code.
FAILURE_CODES: dict[str, dict[str, tuple[int, ...]]] = {
    "sql": {
        "SqlDeadlock": (1205, 1222), "SqlTimeout": (-2,), "NetworkInterruption": (20, 64, 232, 233, 258, 10053, 10054, 10060, 10061, 11001),
        "SqlTransient": (121, 615, 4060, 4221), "RateLimited": (40197, 40501, 40613, 49918, 49919, 49920), "PermissionDenied": (229, 916, 18452, 18456),
    },
    "posix": {"DiskFull": (28, 122), "PermissionDenied": (1, 13)},
    "win32": {"DiskFull": (39, 112), "PermissionDenied": (5,)},
}
# Failures by kind of exception.
FAILURE_KINDS = {
    "OperationCanceledException": "Cancelled", "TaskCanceledException": "Cancelled", "TimeoutException": "SqlTimeout", "UnauthorizedAccessException": "PermissionDenied",
    "SecurityException": "PermissionDenied", "ArgumentException": "Permanent", "InvalidOperationException": "Permanent", "NotSupportedException": "Permanent",
}
RETRYABLE = ("SqlTimeout", "SqlDeadlock", "SqlTransient", "NetworkInterruption", "IoFailure", "DiskFull", "RateLimited")
DISK_FULL_WORDS = ("disk full", "no space left", "insufficient space", "not enough space")
TRANSIENT_SQL = (1205, 1222, -2, 233, 10053, 10054, 10060, 121, 40197, 40501, 40613, 49918, 49919, 49920)


def says_disk_full(message) -> Column:
    return F.coalesce(F.lower(_col(message)).rlike("|".join(DISK_FULL_WORDS)), F.lit(False))


def _by_code(code, family: str, other: str) -> Column:
    out = F.lit(other)
    for category, codes in FAILURE_CODES[family].items():
        out = F.when(code.isin(*codes), F.lit(category)).otherwise(out)
    return out


def failure_category(kind, code=None, message=None, inner_kind=None) -> Column:
    """The category of a failure; of an AggregateException, that of what it wraps."""
    kind = _col(kind)
    if inner_kind is not None:
        kind = F.when((kind == "AggregateException") & _col(inner_kind).isNotNull(), _col(inner_kind)).otherwise(kind)
    code = F.lit(None).cast("int") if code is None else _col(code)
    full = F.lit(False) if message is None else says_disk_full(message)
    posix = _by_code(code, "posix", "IoFailure")
    out = F.when(kind == "SqlException", _by_code(code, "sql", "Unknown"))
    out = out.when(kind == "SocketException", F.when(code == 10060, F.lit("SqlTimeout")).when(code == 10013, F.lit("PermissionDenied")).otherwise(F.lit("NetworkInterruption")))
    out = out.when(kind.isin("IOException", "FileNotFoundException", "DirectoryNotFoundException"), F.when((posix == "IoFailure") & full, F.lit("DiskFull")).otherwise(posix))
    out = out.when(kind == "Win32Exception", _by_code(code, "win32", "IoFailure"))
    for name, category in FAILURE_KINDS.items():
        out = out.when(kind == name, F.lit(category))
    return out.otherwise(F.lit("Unknown"))


def is_retryable(category) -> Column:
    return _col(category).isin(*RETRYABLE)


def is_transient_sql(code) -> Column:
    return _col(code).isin(*TRANSIENT_SQL)


HEALTH = ("Unhealthy", "Suspect", "Unknown", "Stopped", "Healthy")


def health_label(status, heartbeat, age, stale_after: int = 120) -> Column:
    status = _col(status)
    return (
        F.when(status == "Stopped", F.lit("Stopped")).when(status.isin("Failed", "Stalled"), F.lit("Unhealthy"))
        .when(_col(heartbeat).isNull(), F.lit("Unknown")).when(_col(age) > stale_after, F.lit("Suspect")).otherwise(F.lit("Healthy"))
    )


def health_rank(label) -> Column:
    out = F.lit(None).cast("int")
    for i, name in enumerate(HEALTH):
        out = F.when(_col(label) == name, F.lit(i + 1)).otherwise(out)
    return out
