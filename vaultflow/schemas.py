"""Relations, value domains and state machines."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(), "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(), "decimal(18,4)": T.DecimalType(18, 4),
}


def _S(columns: str) -> T.StructType:  # noqa: N802
    """As StructType.fromDDL, for a module that is imported where no session is."""
    return T.StructType([T.StructField(n, _TYPES[kind]) for n, kind in (c.split(" ") for c in columns.split(", "))])


# The relations' columns.
RELATIONS: dict[str, T.StructType] = {
    "document_file_version": _S("part bigint, ver int, dfv bigint, title string, extension string"),
    "data_file_version": _S("part bigint, dfv bigint, logical_size bigint, physical_size bigint, last_write timestamp_ntz, committed boolean"),
    "data_file_version_bytes": _S("part bigint, dfv bigint, data binary"),
    "jobs": _S("job_id bigint, job_name string, source_server string, source_database string, partition_key string, expected bigint, started timestamp_ntz, completed timestamp_ntz, cancellation_reason string, status string"),
    "workers": _S("worker_id bigint, job_id bigint, worker_name string, machine_name string, process_id int, assigned_partition string, concurrency int, started timestamp_ntz, heartbeat timestamp_ntz, stopped timestamp_ntz, status string"),
    "progress": _S("progress_id bigint, job_id bigint, snapshot timestamp_ntz, recorded bigint, succeeded bigint, failed bigint, skipped bigint, bytes_written bigint, docs_per_sec decimal(18,4), mib_per_sec decimal(18,4), last_part bigint, last_ver bigint, status string"),
    "metrics": _S("metric_id bigint, job_id bigint, metric_name string, value double, unit string, tags string, captured timestamp_ntz, status string"),
    "errors": _S("error_id bigint, job_id bigint, worker_id bigint, part bigint, ver bigint, dfv bigint, idempotency_key string, severity string, category string, source string, exception_type string, message string, stack_trace string, attempt int, occurred timestamp_ntz, resolved timestamp_ntz, resolved_by string, notes string, status string"),
    "checkpoints": _S("checkpoint_id bigint, job_id bigint, partition_key string, last_part bigint, last_ver bigint, processed bigint, checkpoint_at timestamp_ntz, status string"),
    "audit": _S("audit_id bigint, job_id bigint, entity_type string, entity_id bigint, action string, previous_status string, new_status string, details string, actor_name string, actor_type string, occurred timestamp_ntz, status string"),
    "work_items": _S("item_id bigint, job_id bigint, idempotency_key string, part bigint, ver bigint, dfv bigint, priority int, status string, worker_id bigint, token string, claimed timestamp_ntz, expires timestamp_ntz, attempts int, max_attempts int, failure_reason string, failed_at timestamp_ntz, next_eligible timestamp_ntz, completed timestamp_ntz, output_path string, checksum string, bytes_written bigint"),
    "outcomes": _S("idempotency_key string, part bigint, ver bigint, dfv bigint, status int, bytes_written bigint, output_path string, checksum string, failure_reason string, observed timestamp_ntz, attempt int"),
    "cursors": _S("partition_key string, last_part bigint, last_ver bigint, updated timestamp_ntz"),
}

# Status and other domains.
DOMAINS: dict[tuple[str, str], tuple[str, ...]] = {
    ("jobs", "status"): ("Pending", "Running", "Paused", "Completed", "Failed", "Cancelled", "Archived"),
    ("workers", "status"): ("Registered", "Active", "Idle", "Stalled", "Stopped", "Failed", "Archived"),
    ("progress", "status"): ("Snapshot", "Historical", "Archived"),
    ("metrics", "status"): ("Live", "RolledUp", "Archived"),
    ("errors", "severity"): ("Warning", "Error", "Critical"),
    ("errors", "category"): ("Transient", "Deterministic", "Configuration", "Security", "Storage", "Unknown"),
    ("errors", "status"): ("New", "Acknowledged", "Investigating", "Resolved", "Ignored", "Archived"),
    ("checkpoints", "status"): ("Active", "Superseded", "Rolled Back", "Archived"),
    ("audit", "entity_type"): ("ExportJobs", "ExportWorkers", "ExportProgress", "ExportMetrics", "ExportErrors", "ExportCheckpoints", "Configuration"),
    ("audit", "action"): (
        "Created", "Updated", "Deleted", "Started", "Completed", "Failed", "Cancelled", "Paused", "Resumed", "Registered", "HeartbeatReceived",
        "Stalled", "Stopped", "CheckpointSaved", "CheckpointRolledBack", "ErrorRaised", "ErrorResolved", "Archived", "Purged", "Restored",
        "StatusChanged", "ConfigurationChanged",
    ),
    ("audit", "actor_type"): ("System", "Worker", "Scheduler", "User", "Service"),
    ("audit", "status"): ("Recorded", "Archived"),
    ("work_items", "status"): ("Available", "Claimed", "Completed", "Failed", "DeadLettered"),
}

# Allowed moves of a job.
JOB_MOVES: tuple[tuple[str, str], ...] = (
    ("Pending", "Running"), ("Pending", "Cancelled"), ("Running", "Paused"), ("Running", "Completed"), ("Running", "Failed"), ("Running", "Cancelled"),
    ("Paused", "Running"), ("Paused", "Cancelled"), ("Completed", "Archived"), ("Failed", "Archived"), ("Cancelled", "Archived"),
)

TERMINAL = ("Completed", "Failed", "Cancelled")
# Outcomes by number.
OUTCOMES = ("Unknown", "Pending", "Succeeded", "Failed", "Skipped")
UNKNOWN, PENDING, SUCCEEDED, FAILED, SKIPPED = range(5)
#: The key before all keys.
ORIGIN = (-(2**63), -(2**63))


def empty(spark, name: str):
    return spark.createDataFrame([], RELATIONS[name])
