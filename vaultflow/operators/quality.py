"""Constraints as queries: each is a predicate in a table, and its violations are rows for which it is false.

As a CHECK constraint passes where its predicate is unknown, a violation is "is false", not "is not true"."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow.schemas import DOMAINS, JOB_MOVES

HEX_KEY = "^[0-9a-f]{64}$"


def _isjson(col: str) -> str:
    """Objects and arrays only."""
    return f"({col} IS NULL OR (try_parse_json({col}) IS NOT NULL AND {col} RLIKE '^\\\\s*[\\\\[{{]'))"


# The relations' rules.
CHECKS: dict[str, tuple[str, str]] = {
    "c_completed_after_start": ("jobs", "completed IS NULL OR started IS NULL OR completed >= started"),
    "c_concurrency_range": ("workers", "concurrency BETWEEN 1 AND 256"),
    "c_counters_nonneg": ("progress", "recorded >= 0 AND succeeded >= 0 AND failed >= 0 AND skipped >= 0 AND bytes_written >= 0"),
    "c_counters_consistent": ("progress", "recorded >= succeeded + failed + skipped OR recorded = 0"),
    "c_json_tags": ("metrics", _isjson("tags")),
    "c_json_details": ("audit", _isjson("details")),
    "c_attempt_min": ("errors", "attempt >= 1"),
    "c_attempt_bounds": ("work_items", "attempts >= 0 AND max_attempts >= 1 AND attempts <= max_attempts"),
    "c_resolved_shape": ("errors", "(status IN ('Resolved', 'Ignored') AND resolved IS NOT NULL AND resolved_by IS NOT NULL) OR (status NOT IN ('Resolved', 'Ignored') AND resolved IS NULL)"),
    "c_hex_key_errors": ("errors", f"idempotency_key IS NULL OR idempotency_key RLIKE '{HEX_KEY}'"),
    "c_hex_key_items": ("work_items", f"idempotency_key RLIKE '{HEX_KEY}'"),
    "c_claimed_shape": ("work_items", "status <> 'Claimed' OR (worker_id IS NOT NULL AND token IS NOT NULL AND claimed IS NOT NULL AND expires IS NOT NULL)"),
    "c_completed_shape": ("work_items", "status <> 'Completed' OR (completed IS NOT NULL AND output_path IS NOT NULL AND checksum IS NOT NULL AND bytes_written IS NOT NULL)"),
} | {
    f"c_domain_{table}_{col}": (table, f"{col} IN ({', '.join(repr(v) for v in values)})") for (table, col), values in DOMAINS.items()
}

#: Unique keys; the last among active rows only.
UNIQUE: dict[str, tuple[str, tuple[str, ...], str | None]] = {
    "c_unique_jobs": ("jobs", ("job_name", "partition_key"), None),
    "c_unique_workers": ("workers", ("job_id", "assigned_partition", "worker_name", "machine_name"), None),
    "c_unique_items": ("work_items", ("job_id", "idempotency_key"), None),
    "c_unique_active_checkpoint": ("checkpoints", ("job_id", "partition_key"), "status = 'Active'"),
}
FOREIGN: dict[str, tuple[str, str, str, str]] = {
    f"c_fk_{child}_{col}": (child, col, parent, col)
    for child, col, parent in (
        ("workers", "job_id", "jobs"), ("progress", "job_id", "jobs"), ("metrics", "job_id", "jobs"), ("errors", "job_id", "jobs"), ("checkpoints", "job_id", "jobs"),
        ("audit", "job_id", "jobs"), ("work_items", "job_id", "jobs"), ("errors", "worker_id", "workers"), ("work_items", "worker_id", "workers"),
    )
}


def violations(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows that break a rule; of a unique key the keys and how often they stand."""
    if name in CHECKS:
        table, predicate = CHECKS[name]
        return tables[table].filter(f"({predicate}) IS FALSE")
    if name in UNIQUE:
        table, cols, where = UNIQUE[name]
        rows = tables[table].filter(where) if where else tables[table]
        return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if name in FOREIGN:
        child, col, parent, key = FOREIGN[name]
        return tables[child].filter(F.col(col).isNotNull()).join(tables[parent].select(F.col(key).alias(col)), col, "left_anti")
    raise ValueError(f"no rule {name}")


def all_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """rule, table, rows, violations: every predicate of a table in one pass over it."""
    out = None
    for table, df in tables.items():
        own = {k: p for k, (t, p) in CHECKS.items() if t == table}
        if not own:
            continue
        sums = df.agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(F.expr(f"CASE WHEN ({p}) IS FALSE THEN 1 ELSE 0 END")), F.lit(0)).alias(k) for k, p in own.items()))
        rows = sums.select("n", F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), F.col(k).cast("bigint").alias("violations")) for k in own))).alias("x"))
        rows = rows.select("x.rule", F.lit(table).alias("relation"), F.col("n").alias("n_rows"), "x.violations")
        out = rows if out is None else out.unionByName(rows)
    return out


def all_rules(tables: dict[str, DataFrame]) -> DataFrame:
    """all_checks(), and of every unique key and reference how many keys or rows break it: one pass over its table for each."""
    out = all_checks(tables)
    found = []
    for rule, (table, cols, where) in UNIQUE.items():
        if table in tables:
            own = F.count(F.lit(1)) if where is None else F.count(F.when(F.expr(where), 1))
            keys = tables[table].groupBy(*cols).agg(F.count(F.lit(1)).alias("every"), own.alias("n"))
            found.append((rule, table, keys.agg(F.coalesce(F.sum("every"), F.lit(0)).alias("n_rows"), F.count(F.when(F.col("n") > 1, 1)).alias("violations"))))
    for rule, (child, col, parent, key) in FOREIGN.items():
        if child in tables and parent in tables:
            known = tables[parent].select(F.col(key).alias(col)).distinct().withColumn("known", F.lit(True))
            rows = tables[child].select(col).join(known, col, "left")
            found.append((rule, child, rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col(col).isNotNull() & F.col("known").isNull(), 1)).alias("violations"))))
    for rule, table, row in found:
        out = out.unionByName(row.select(F.lit(rule).alias("rule"), F.lit(table).alias("relation"), "n_rows", "violations"))
    return out


def forbidden_moves(moves: DataFrame) -> DataFrame:
    """Rows (previous, new) that the job's state machine does not know."""
    known = moves.sparkSession.createDataFrame(list(JOB_MOVES), "previous string, new string")
    return moves.join(F.broadcast(known), ["previous", "new"], "left_anti")
