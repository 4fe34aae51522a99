"""Checks of arguments and options, before any plan is built."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.schemas import TERMINAL

# The ranges of numeric options, ends included.
RANGES: dict[str, tuple[float, float]] = {
    "batch_size": (1, 10_000), "backoff_seconds": (0, 3_600), "reclaim_rows": (1, 100_000), "audit_take": (1, 10_000), "page_size": (50, 100_000),
    "shard_depth": (1, 4), "concurrency": (1, 256), "outcome_batch": (1, 10_000), "run_batch_size": (1, 100_000), "parallelism": (1, 512),
    "failure_threshold": (0, 1), "file_name_length": (16, 255), "path_length": (64, 32_767), "retry_attempts": (1, 100), "retry_base_ms": (0, 60_000),
    "retry_cap_seconds": (0, 3_600),
}
HEARTBEATS = ("Active", "Idle", "Stalled")
RESOLUTIONS = ("Resolved", "Ignored")
_MANY = float("inf")
_KEYS = {"item_id": "above", "token": "given"}
# Arguments and options by kind, each with what it must lie within (ends included), "above" (greater than 0), "given" (not
# blank), "free" (null or 0 and more), or the values that it may have.
OPTIONS: dict[str, dict[str, tuple | str]] = {
    "claim": {"job_id": "above", "worker_id": "above", "batch_size": RANGES["batch_size"], "lease_seconds": (1, 3_600)},
    "complete": _KEYS | {"output_path": "given", "checksum": "given", "bytes_written": "free"},
    "fail": _KEYS | {"reason": "given", "backoff_seconds": RANGES["backoff_seconds"]},
    "renew": _KEYS | {"extend_by": (1, 3_600)},
    "reclaim": {"backoff_seconds": RANGES["backoff_seconds"], "reclaim_rows": RANGES["reclaim_rows"]},
    "start_job": {"name": "given", "server": "given", "database": "given", "partition": "given", "expected": "free"},
    "complete_job": {"job_id": "above", "status": TERMINAL},
    "register": {"job_id": "above", "worker_name": "given", "machine": "given", "partition": "given", "concurrency": RANGES["concurrency"]},
    "heartbeat": {"worker_id": "above", "status": HEARTBEATS},
    "checkpoint": {"job_id": "above", "partition": "given"},
    "log_error": {"job_id": "above", "severity": "given", "category": "given", "source": "given", "message": "given", "attempt": "above"},
    "resolve": {"error_id": "above", "status": RESOLUTIONS, "by": "given"},
    "audit_take": {"audit_take": RANGES["audit_take"]},
    "source": {"connection": "given", "command_timeout": "above", "page_size": RANGES["page_size"], "partition": "given", "versions_table": "given", "files_table": "given", "contents_table": "given"},
    "storage": {"root": "given", "manifest": "given", "shard_depth": RANGES["shard_depth"], "write_buffer": (4_096, _MANY), "rotation_entries": "above", "free_space_gb": (0, _MANY)},
    "pipeline": {
        "scan_capacity": "above", "content_capacity": "above", "reader_concurrency": RANGES["concurrency"], "sink_concurrency": RANGES["concurrency"], "outcome_batch": RANGES["outcome_batch"],
        "report_interval": "above", "flush_interval": "above",
    },
    "batch": {"run_batch_size": RANGES["run_batch_size"], "parallelism": RANGES["parallelism"], "timeout": "above", "pause": (0, _MANY), "failure_threshold": RANGES["failure_threshold"]},
    "file": {
        "root": "given", "shard_depth": RANGES["shard_depth"], "buckets": "above", "date_pattern": "given", "file_name_length": RANGES["file_name_length"], "path_length": RANGES["path_length"],
        "write_buffer": (4_096, _MANY), "default_title": "given",
    },
    "metadata": {"directory": "given", "csv_name": "given", "json_name": "given", "manifest_name": "given", "delimiter": "given", "flush_records": "above"},
    "retry": {"attempts": RANGES["retry_attempts"], "base_ms": RANGES["retry_base_ms"], "cap_seconds": RANGES["retry_cap_seconds"], "timeout_seconds": (0, _MANY), "jitter": (0, 1)},
    "job": {
        "partition": "given", "batch_size": RANGES["page_size"], "reader_concurrency": RANGES["concurrency"], "sink_concurrency": RANGES["concurrency"], "max_document_mb": (0, _MANY),
        "report_interval": "above", "flush_interval": "above",
    },
}


def within(name: str, value) -> None:
    low, high = RANGES[name]
    if value is None or not low <= value <= high:
        raise ValueError(f"{name}: {value} is not within {low} to {high}")


def positive(**values) -> None:
    for name, x in values.items():
        if x is None or x <= 0:
            raise ValueError(f"{name}: {x} is not above 0")


def not_negative(**values) -> None:
    for name, x in values.items():
        if x is not None and x < 0:
            raise ValueError(f"{name}: {x} is below 0")


def given(**values) -> None:
    for name, x in values.items():
        if x is None or not str(x).strip():
            raise ValueError(f"{name} is required")


def one_of(name: str, value, allowed) -> None:
    if value not in allowed:
        raise ValueError(f"{name}: {value} is none of {', '.join(allowed)}")


def claim(job_id, worker_id, batch_size, lease_seconds) -> None:
    positive(job_id=job_id, worker_id=worker_id, lease_seconds=lease_seconds)
    within("batch_size", batch_size)
    if lease_seconds > 3_600:
        raise ValueError(f"lease_seconds: {lease_seconds} is above 3600")


def complete(item_id, token, output_path, checksum, bytes_written) -> None:
    positive(item_id=item_id)
    given(token=token, output_path=output_path, checksum=checksum)
    not_negative(bytes_written=bytes_written)


def fail(item_id, token, reason, backoff_seconds) -> None:
    positive(item_id=item_id)
    given(token=token, reason=reason)
    within("backoff_seconds", backoff_seconds)


def renew(item_id, token, extend_by) -> None:
    positive(item_id=item_id, extend_by=extend_by)
    given(token=token)
    if extend_by > 3_600:
        raise ValueError(f"extend_by: {extend_by} is above 3600")


def start_job(name, server, database, partition, expected) -> None:
    given(name=name, server=server, database=database, partition=partition)
    not_negative(expected=expected)


def complete_job(job_id, status) -> None:
    positive(job_id=job_id)
    one_of("status", status, TERMINAL)


def register(job_id, worker_name, machine, partition, concurrency) -> None:
    positive(job_id=job_id)
    given(worker_name=worker_name, machine=machine, partition=partition)
    within("concurrency", concurrency)


def heartbeat(worker_id, status) -> None:
    positive(worker_id=worker_id)
    one_of("status", status, HEARTBEATS)


def checkpoint(job_id, partition) -> None:
    positive(job_id=job_id)
    given(partition=partition)


def resolve(error_id, status, by) -> None:
    positive(error_id=error_id)
    one_of("status", status, RESOLUTIONS)
    given(by=by)


def _is_choice(rule) -> bool:
    return not isinstance(rule, str) and isinstance(rule[0], str)


def failures(kind: str, values: dict) -> list[str]:
    """What is wrong with arguments or options of a kind: "name:REQUIRED", "name:RANGE" or "name:VALUE", in their order. Those that are not named
    are missing."""
    out = []
    for name, rule in OPTIONS[kind].items():
        x = values.get(name)
        if rule == "given":
            bad = "REQUIRED" if x is None or not str(x).strip() else None
        elif _is_choice(rule):
            bad = "VALUE" if x not in rule else None
        elif rule == "free":
            bad = "RANGE" if x is not None and x < 0 else None
        elif rule == "above":
            bad = "RANGE" if x is None or not x > 0 else None
        else:
            bad = "RANGE" if x is None or not rule[0] <= x <= rule[1] else None
        if bad:
            out.append(f"{name}:{bad}")
    return out


def options(kind: str, **values) -> None:
    """Raises if options of a kind are wrong or not known."""
    unknown = sorted(set(values) - set(OPTIONS[kind]))
    found = [f"{x}:UNKNOWN" for x in unknown] + failures(kind, values)
    if found:
        raise ValueError(f"{kind} options: {', '.join(found)}")


def failed_options(kind: str, options: DataFrame) -> Column:
    """failures() of each row of a table of options, joined by commas: one expression, without Python."""
    said = []
    for name, rule in OPTIONS[kind].items():
        c = F.col(name) if name in options.columns else F.lit(None)
        if rule == "given":
            said.append(F.when(c.isNull() | (F.trim(c.cast("string")) == ""), f"{name}:REQUIRED"))
        elif _is_choice(rule):
            said.append(F.when(~F.coalesce(c.isin(*rule), F.lit(False)), f"{name}:VALUE"))
        elif rule == "free":
            said.append(F.when(c < 0, f"{name}:RANGE"))
        else:
            ok = c > 0 if rule == "above" else (c >= rule[0]) & (c <= rule[1]) if rule[1] != _MANY else c >= rule[0]
            said.append(F.when(~F.coalesce(ok, F.lit(False)), f"{name}:RANGE"))
    return F.concat_ws(",", *said)


def log_error(job_id, severity, category, source, message, attempt=1) -> None:
    positive(job_id=job_id, attempt=attempt)
    given(severity=severity, category=category, source=source, message=message)
