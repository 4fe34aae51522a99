"""Changes of jobs, workers, errors, checkpoints: pure functions from old rows to new rows and audit rows.

Every "now" is the argument as_of. Ids of new rows follow the greatest id there is."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.functions import guards
from vaultflow.operators.numbering import numbered
from vaultflow.schemas import JOB_MOVES, TERMINAL


class Change(NamedTuple):
    """The table after the change, the audit rows it makes, and what it returns."""

    table: DataFrame
    audit: DataFrame
    out: DataFrame


class NotFound(ValueError):
    pass


class NotAllowed(ValueError):
    pass


def _ts(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def _next_id(df: DataFrame, col: str) -> int:
    return (df.agg(F.max(col)).first()[0] or 0) + 1


def _row(df: DataFrame, **values) -> DataFrame:
    """One row of df's columns; those not named are null."""
    spark = df.sparkSession
    cells = [(values[f.name] if isinstance(values.get(f.name), Column) else F.lit(values.get(f.name))).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return spark.range(1).select(*cells)


def audit_rows(changed: DataFrame, entity_type: str, action, previous, new, as_of: str, details=None, actor: str = "system", actor_type: str = "System", id_col: str = "id", job_col: str = "job_id") -> DataFrame:
    """Audit rows of changed rows, in the audit relation's columns; audit ids are given by append_audit."""
    wide = lambda x: x if isinstance(x, Column) else F.lit(x).cast("string")
    return changed.select(
        F.lit(None).cast("bigint").alias("audit_id"), F.col(job_col).cast("bigint").alias("job_id"), F.lit(entity_type).alias("entity_type"), F.col(id_col).cast("bigint").alias("entity_id"),
        wide(action).alias("action"), wide(previous).alias("previous_status"), wide(new).alias("new_status"), (wide(details)).alias("details"),
        F.lit(actor).alias("actor_name"), F.lit(actor_type).alias("actor_type"), _ts(as_of).alias("occurred"), F.lit("Recorded").alias("status"),
    )


def append_audit(audit: DataFrame, new: DataFrame) -> DataFrame:
    """audit and new rows, numbered on from the greatest id."""
    return audit.unionByName(numbered(new.drop("audit_id"), "audit_id", _next_id(audit, "audit_id"), "entity_type", "entity_id", "action"))


def start_job(jobs: DataFrame, as_of: str, name: str, server: str, database: str, partition: str = "default", expected: int | None = None, actor: str = "system") -> Change:
    guards.start_job(name, server, database, partition, expected)
    if not jobs.filter((F.col("job_name") == name) & (F.col("partition_key") == partition)).isEmpty():
        raise NotAllowed(f"job {name} of partition {partition} exists")
    row = _row(jobs, job_id=_next_id(jobs, "job_id"), job_name=name, source_server=server, source_database=database, partition_key=partition, expected=expected, started=_ts(as_of), status="Running")
    details = F.to_json(F.struct(F.col("job_name").alias("JobName"), F.col("partition_key").alias("PartitionKey"), F.col("source_server").alias("SourceServer"), F.col("source_database").alias("SourceDatabase")))
    return Change(jobs.unionByName(row), audit_rows(row, "ExportJobs", "Started", "Pending", "Running", as_of, details, actor, id_col="job_id"), row.select("job_id"))


def move_allowed(previous: Column, new: Column) -> Column:
    out = F.lit(False)
    for a, b in JOB_MOVES:
        out = out | ((previous == a) & (new == b))
    return out


def complete_job(jobs: DataFrame, as_of: str, job_id: int, status: str, reason: str | None = None, strict: bool = True, actor: str = "system") -> Change:
    """strict: only moves of the state machine; else any job may be given a terminal status."""
    guards.complete_job(job_id, status)
    found = jobs.filter(F.col("job_id") == job_id).select("job_id", "status").first()
    if found is None:
        raise NotFound(f"no job {job_id}")
    if strict and (found["status"], status) not in JOB_MOVES:
        raise NotAllowed(f"job {job_id}: {found['status']} to {status}")
    own = F.col("job_id") == job_id
    new = jobs.withColumns({
        "status": F.when(own, F.lit(status)).otherwise(F.col("status")), "completed": F.when(own, _ts(as_of)).otherwise(F.col("completed")),
        "cancellation_reason": F.when(own & F.lit(status == "Cancelled"), F.lit(reason).cast("string")).otherwise(F.col("cancellation_reason")),
    })
    details = F.lit(None).cast("string") if reason is None else F.to_json(F.struct(F.lit(reason).alias("Reason")))
    changed = jobs.filter(own)
    return Change(new, audit_rows(changed, "ExportJobs", status, F.col("status"), status, as_of, details, actor, id_col="job_id"), new.filter(own))


def complete_jobs(jobs: DataFrame, moves: DataFrame, as_of: str) -> Change:
    """Many at once: moves has job_id, new_status, reason; moves the state machine forbids stay out, and out says so."""
    asked = jobs.join(moves, "job_id")
    ok = move_allowed(F.col("status"), F.col("new_status")) & F.col("new_status").isin(*TERMINAL)
    good = asked.filter(ok).select("job_id", F.col("new_status").alias("__new"), F.col("reason").alias("__reason"))
    after = jobs.join(good, "job_id", "left").withColumns({
        "status": F.coalesce("__new", "status"), "completed": F.when(F.col("__new").isNotNull(), _ts(as_of)).otherwise(F.col("completed")),
        "cancellation_reason": F.when(F.col("__new") == "Cancelled", F.col("__reason")).otherwise(F.col("cancellation_reason")),
    }).select(*jobs.columns)
    details = F.when(F.col("reason").isNotNull(), F.to_json(F.struct(F.col("reason").alias("Reason"))))
    done = asked.filter(ok)
    return Change(after, audit_rows(done, "ExportJobs", F.col("new_status"), F.col("status"), F.col("new_status"), as_of, details, id_col="job_id"), asked.select("job_id", "status", "new_status", ok.alias("allowed")))


def register_worker(workers: DataFrame, as_of: str, job_id: int, name: str, machine: str, partition: str, concurrency: int = 1, process_id: int | None = None, actor: str = "system") -> Change:
    guards.register(job_id, name, machine, partition, concurrency)
    own = (F.col("job_id") == job_id) & (F.col("assigned_partition") == partition) & (F.col("worker_name") == name) & (F.col("machine_name") == machine)
    known = workers.filter(own).select("worker_id").first()
    now = _ts(as_of)
    if known is None:
        row = _row(workers, worker_id=_next_id(workers, "worker_id"), job_id=job_id, worker_name=name, machine_name=machine, process_id=process_id, assigned_partition=partition, concurrency=concurrency, started=now, heartbeat=now, status="Active")
        table = workers.unionByName(row)
    else:
        put = lambda c, v: F.when(own, v).otherwise(F.col(c)).cast(workers.schema[c].dataType)
        table = workers.withColumns({
            "process_id": put("process_id", F.lit(process_id)), "concurrency": put("concurrency", F.lit(concurrency)), "started": put("started", now), "heartbeat": put("heartbeat", now),
            "stopped": put("stopped", F.lit(None)), "status": put("status", F.lit("Active")),
        })
        row = table.filter(own)
    details = F.to_json(F.struct(F.col("worker_name").alias("WorkerName"), F.col("machine_name").alias("MachineName"), F.col("assigned_partition").alias("Partition"), F.col("concurrency").alias("Concurrency")))
    return Change(table, audit_rows(row, "ExportWorkers", "Registered", None, "Active", as_of, details, actor, "Worker", id_col="worker_id"), row.select("worker_id"))


def heartbeats(workers: DataFrame, beats: DataFrame, as_of: str) -> DataFrame:
    """workers after beats (worker_id, new_status); unknown ids do nothing; missing and negative ids, and statuses other than Active, Idle, Stalled raise."""
    _refuse(beats, F.coalesce("worker_id", F.lit(-1)) < 0, "worker_id", "heartbeats need a worker")
    bad = F.raise_error(F.concat(F.lit("not a heartbeat's status: "), F.col("__s"))).cast("string")
    status = F.when(F.col("__s").isNull(), F.col("status")).when(F.col("__s").isin(*guards.HEARTBEATS), F.col("__s")).otherwise(bad)
    b = beats.groupBy("worker_id").agg(F.max("new_status").alias("__s"))
    return workers.join(b, "worker_id", "left").withColumns({"heartbeat": F.when(F.col("__s").isNotNull(), _ts(as_of)).otherwise(F.col("heartbeat")), "status": status}).select(*workers.columns)


def stop_worker(workers: DataFrame, as_of: str, worker_id: int, reason: str | None = None, actor: str = "system") -> Change:
    own = F.col("worker_id") == worker_id
    before = workers.filter(own)
    if before.isEmpty():
        raise NotFound(f"no worker {worker_id}")
    table = workers.withColumns({"status": F.when(own, F.lit("Stopped")).otherwise(F.col("status")), "stopped": F.when(own, _ts(as_of)).otherwise(F.col("stopped"))})
    details = F.lit(None).cast("string") if reason is None else F.to_json(F.struct(F.lit(reason).alias("Reason")))
    return Change(table, audit_rows(before, "ExportWorkers", "Stopped", F.col("status"), "Stopped", as_of, details, actor, "Worker", id_col="worker_id"), table.filter(own))


def mark_stalled(workers: DataFrame, as_of: str, stale_after: int = 120) -> Change:
    """Active and idle workers without a heartbeat for stale_after seconds become Stalled."""
    late = F.col("status").isin("Active", "Idle") & (F.col("heartbeat") < _ts(as_of) - F.make_dt_interval(secs=F.lit(stale_after)))
    late = F.coalesce(late, F.lit(False))
    changed = workers.filter(late)
    details = F.to_json(F.struct(F.lit(stale_after).alias("StaleAfterSeconds")))
    return Change(workers.withColumn("status", F.when(late, F.lit("Stalled")).otherwise(F.col("status"))), audit_rows(changed, "ExportWorkers", "Stalled", F.col("status"), "Stalled", as_of, details, id_col="worker_id"), changed)


def _refuse(rows: DataFrame, bad: Column, id_col: str, why: str) -> None:
    """Raises if any row is bad, before a plan is built on them."""
    found = rows.filter(bad).select(id_col).first()
    if found is not None:
        raise ValueError(f"{why}; {id_col} {found[0]}")


def append(table: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    """table and rows (metrics, progress, errors), numbered on from the greatest id."""
    rest = [c for c in table.columns if c != id_col]
    full = rows.select(*(F.col(c) if c in rows.columns else F.lit(None).cast(table.schema[c].dataType).alias(c) for c in rest))
    return table.unionByName(numbered(full, id_col, _next_id(table, id_col), *rest).select(*table.columns))


def log_errors(errors: DataFrame, new: DataFrame, as_of: str) -> Change:
    """errors with new ones, status New, and an audit row for each with its severity, category and source. A new one without a job,
    severity, category, source or message raises."""
    blank = F.coalesce("job_id", F.lit(-1)) < 0
    for c in ("severity", "category", "source", "message"):
        blank = blank | (F.coalesce(F.trim(c), F.lit("")) == "")
    _refuse(new, blank, "job_id", "errors need a job, severity, category, source and message")
    table = append(errors, new.withColumns({"occurred": _ts(as_of), "status": F.lit("New"), "attempt": F.coalesce("attempt", F.lit(1)) if "attempt" in new.columns else F.lit(1)}), "error_id")
    added = table.join(errors.select("error_id"), "error_id", "left_anti")
    details = F.to_json(F.struct(F.col("severity").alias("Severity"), F.col("category").alias("Category"), F.col("source").alias("Source")))
    return Change(table, audit_rows(added, "ExportErrors", "ErrorRaised", None, "New", as_of, details, id_col="error_id"), added.select("error_id"))


def resolve_error(errors: DataFrame, as_of: str, error_id: int, status: str = "Resolved", notes: str | None = None, by: str = "system") -> Change:
    guards.resolve(error_id, status, by)
    own = F.col("error_id") == error_id
    before = errors.filter(own)
    if before.isEmpty():
        raise NotFound(f"no error {error_id}")
    put = lambda c, v: F.when(own, v).otherwise(F.col(c)).cast(errors.schema[c].dataType)
    table = errors.withColumns({"status": put("status", F.lit(status)), "resolved": put("resolved", _ts(as_of)), "resolved_by": put("resolved_by", F.lit(by)), "notes": put("notes", F.lit(notes))})
    return Change(table, audit_rows(before, "ExportErrors", "ErrorResolved", F.col("status"), status, as_of, None, by, id_col="error_id"), table.filter(own))


def save_checkpoints(checkpoints: DataFrame, candidates: DataFrame, as_of: str) -> Change:
    """candidates (job_id, partition_key, last_part, last_ver, processed), one for each job and partition: where one is
    strictly after the active checkpoint, it becomes the active one and the old one superseded; else nothing changes."""
    _refuse(candidates, (F.coalesce("job_id", F.lit(-1)) < 0) | (F.coalesce(F.trim("partition_key"), F.lit("")) == ""), "job_id", "checkpoints need a job and a partition")
    active = checkpoints.filter("status = 'Active'").select("job_id", "partition_key", F.struct("last_part", "last_ver").alias("__now"))
    asked = candidates.join(active, ["job_id", "partition_key"], "left").withColumn("advanced", F.col("__now").isNull() | (F.struct("last_part", "last_ver") > F.col("__now")))
    going = asked.filter("advanced")
    marks = going.select("job_id", "partition_key", F.lit(True).alias("__old"))
    old = checkpoints.join(marks, ["job_id", "partition_key"], "left").withColumn("status", F.when(F.col("__old") & (F.col("status") == "Active"), F.lit("Superseded")).otherwise(F.col("status"))).select(*checkpoints.columns)
    going = numbered(going, "checkpoint_id", _next_id(checkpoints, "checkpoint_id"), "job_id", "partition_key")
    new = going.withColumns({"checkpoint_at": _ts(as_of), "status": F.lit("Active")}).select(*checkpoints.columns)
    details = F.to_json(F.struct(F.col("last_part").alias("DocumentFilePartId"), F.col("last_ver").alias("VersionPartId")))
    return Change(old.unionByName(new), audit_rows(new, "ExportCheckpoints", "CheckpointSaved", None, "Active", as_of, details, id_col="checkpoint_id"), asked.select("job_id", "partition_key", F.col("advanced").cast("int").alias("advanced")))


def recent_audit(audit: DataFrame, take: int, job_id: int | None = None) -> DataFrame:
    guards.within("audit_take", take)
    rows = audit if job_id is None else audit.filter(F.col("job_id") == job_id)
    return rows.orderBy(F.col("occurred").desc(), F.col("audit_id").desc()).limit(take)


