"""The lease queue. Every change is one pass over the items; a writer is alone with its partition of the queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.functions import guards
from vaultflow.operators.numbering import numbered
from vaultflow.operators.tracking import Change, NotAllowed, _next_id, _ts


def _put(df: DataFrame, own: Column, **values) -> DataFrame:
    return df.withColumns({c: F.when(own, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in values.items()})


def _no_audit(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "entity_id bigint")


_FREE = {"worker_id": None, "token": None, "expires": None}


def enqueue(items: DataFrame, new: DataFrame, job_id: int, as_of: str, strict: bool = False, max_attempts: int = 5) -> Change:
    """items and those of new (idempotency_key, part, ver, dfv, priority) whose key the job does not have yet.
    Repeated keys within new count once, or raise if strict."""
    if strict and not new.groupBy("idempotency_key").count().filter("count > 1").isEmpty():
        raise NotAllowed("keys are repeated within the batch")
    fresh = new.dropDuplicates(["idempotency_key"]).join(items.filter(F.col("job_id") == job_id).select("idempotency_key"), "idempotency_key", "left_anti")
    rows = numbered(fresh, "item_id", _next_id(items, "item_id"), "idempotency_key").withColumns({"job_id": F.lit(job_id).cast("bigint"), "status": F.lit("Available"), "attempts": F.lit(0), "max_attempts": F.lit(max_attempts), "next_eligible": _ts(as_of)})
    rows = rows.select(*((F.col(c) if c in rows.columns else F.lit(None)).cast(items.schema[c].dataType).alias(c) for c in items.columns))
    return Change(items.unionByName(rows), _no_audit(items), rows)


def eligible(job_id: int, as_of: str) -> Column:
    return (F.col("job_id") == job_id) & (F.col("status") == "Available") & (F.col("next_eligible") <= _ts(as_of)) & (F.col("attempts") < F.col("max_attempts"))


def claim(items: DataFrame, job_id: int, worker_id: int, n: int, token: str, as_of: str, lease_seconds: int = 300) -> Change:
    """Up to n eligible items, by priority and then id, under one token. The n ids, 10 000 at most, go out by broadcast."""
    guards.claim(job_id, worker_id, n, lease_seconds)
    taken = items.filter(eligible(job_id, as_of)).orderBy(F.col("priority").desc(), "item_id").limit(n).select("item_id", F.lit(True).alias("__own"))
    marked = items.join(F.broadcast(taken), "item_id", "left")
    own = F.coalesce(F.col("__own"), F.lit(False))
    after = _put(marked, own, status="Claimed", worker_id=worker_id, token=token, claimed=_ts(as_of), expires=_ts(as_of) + F.make_dt_interval(secs=F.lit(lease_seconds)), attempts=F.col("attempts") + 1)
    out = after.filter(own).select("item_id", "idempotency_key", "part", "ver", "dfv", "attempts", "max_attempts", "token", "expires")
    return Change(after.select(*items.columns), _no_audit(items), out)


def _held(item_id: int, token: str) -> Column:
    return F.coalesce((F.col("item_id") == item_id) & (F.col("token") == token) & (F.col("status") == "Claimed"), F.lit(False))


def _done(items: DataFrame, own: Column, name: str, **more: Column) -> DataFrame:
    g = items.filter(own)
    return g.agg(F.count(F.lit(1)).cast("int").alias(name), *(F.max(v).alias(k) for k, v in more.items()))


def renew(items: DataFrame, item_id: int, token: str, extend_by: int, as_of: str) -> Change:
    """The lease runs for extend_by seconds from now on; out: extended (0 for a stale token) and expires."""
    guards.renew(item_id, token, extend_by)
    own, until = _held(item_id, token), _ts(as_of) + F.make_dt_interval(secs=F.lit(extend_by))
    return Change(_put(items, own, expires=until), _no_audit(items), _done(items, own, "extended", expires=until))


def complete(items: DataFrame, item_id: int, token: str, output_path: str, checksum: str, bytes_written: int, as_of: str) -> Change:
    guards.complete(item_id, token, output_path, checksum, bytes_written)
    own = _held(item_id, token)
    table = _put(items, own, status="Completed", completed=_ts(as_of), output_path=output_path, checksum=checksum, bytes_written=bytes_written, **_FREE)
    return Change(table, _no_audit(items), _done(items, own, "completed"))


def fail(items: DataFrame, item_id: int, token: str, reason: str, as_of: str, permanent: bool = False, backoff_seconds: int = 60) -> Change:
    """Permanent: Failed. Else Available again after a wait, or DeadLettered after the last attempt."""
    guards.fail(item_id, token, reason, backoff_seconds)
    own = _held(item_id, token)
    status = F.lit("Failed") if permanent else F.when(F.col("attempts") >= F.col("max_attempts"), F.lit("DeadLettered")).otherwise(F.lit("Available"))
    due = F.col("next_eligible") if permanent else _ts(as_of) + F.make_dt_interval(secs=F.lit(backoff_seconds))
    table = _put(items, own, status=status, failure_reason=reason, failed_at=_ts(as_of), next_eligible=due, **_FREE)
    return Change(table, _no_audit(items), _done(items, own, "recorded"))


def reclaim(items: DataFrame, as_of: str, backoff_seconds: int = 30, max_rows: int = 5000) -> Change:
    """Up to max_rows claims whose lease has run out become Available, the oldest lease first. Those at their last attempt too: see stuck()."""
    guards.within("backoff_seconds", backoff_seconds)
    guards.within("reclaim_rows", max_rows)
    over = items.filter((F.col("status") == "Claimed") & (F.col("expires") < _ts(as_of))).orderBy("expires", "item_id").limit(max_rows)
    marked = items.join(F.broadcast(over.select("item_id", F.lit(True).alias("__own"))), "item_id", "left")
    own = F.coalesce(F.col("__own"), F.lit(False))
    after = _put(marked, own, status="Available", failure_reason="Lease expired", failed_at=_ts(as_of), next_eligible=_ts(as_of) + F.make_dt_interval(secs=F.lit(backoff_seconds)), **_FREE)
    return Change(after.select(*items.columns), _no_audit(items), after.filter(own).select("item_id", "attempts", "max_attempts", "next_eligible"))


def stuck(items: DataFrame) -> DataFrame:
    """Available items without an attempt left: nothing claims them, nothing ends them."""
    return items.filter((F.col("status") == "Available") & (F.col("attempts") >= F.col("max_attempts")))
