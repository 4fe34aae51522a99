"""More queries by name: single functions, validators, sinks and streams, and the SQL that each must equal."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow import schemas
from vaultflow.functions import keys as k
from vaultflow.functions import measures as m
from vaultflow.functions import paths as p
from vaultflow.operators import quality, scan, state, tracking, validation
from vaultflow.plans import metrics
from vaultflow.plans.catalogue import _HEALTH, AS_OF, NOW, _as_of, _bad, _batched, _faulty, _pct, _query, _records
from vaultflow.plans.mapping import Relations
from vaultflow.sources import sinks
from vaultflow.streaming import export

_PROGRESS = "SELECT progress_id, {} AS x FROM progress"


def _of_progress(name: str, column, sql: str) -> None:
    _query(name, lambda r: r.progress.select("progress_id", column(r).alias("x")), "progress", _PROGRESS.format(sql))


_SECONDS = "failed % 100"
_of_progress("fn_docs_per_sec", lambda r: F.round(m.docs_per_second("recorded", F.col("failed") % 100), 6), f"CASE WHEN {_SECONDS} > 0 THEN round(recorded / ({_SECONDS}), 6) ELSE 0.0 END")
_of_progress("fn_mib_per_sec", lambda r: F.round(m.mib_per_second("bytes_written", F.col("failed") % 100), 6), f"CASE WHEN {_SECONDS} > 0 THEN round(bytes_written / ({_SECONDS}) / 1048576.0, 6) ELSE 0.0 END")
_of_progress("fn_failure_ratio", lambda r: F.round(m.ratio("failed", "recorded"), 8), "CASE WHEN recorded > 0 THEN round(failed / recorded, 8) ELSE 0.0 END")
_of_progress("fn_pct_of_total", lambda r: m.percent("skipped", "recorded"), f"CASE WHEN recorded <> 0 THEN {_pct('skipped', 'recorded')} END")
_of_progress("fn_remaining", lambda r: m.remaining(F.when(F.col("progress_id") % 3 > 0, F.lit(100_000)), "recorded"), "CASE WHEN progress_id % 3 > 0 THEN 100000 - recorded END")
_of_progress("fn_eta_dashboard", lambda r: F.round(m.eta_dashboard(F.lit(200_000), "recorded", F.col("failed") % 100), 6), f"CASE WHEN {_SECONDS} <= 0 THEN NULL WHEN recorded >= 200000 THEN 0.0 ELSE round((200000 - recorded) / ({_SECONDS}), 6) END")
_of_progress("fn_utilization", lambda r: F.round(m.utilization("failed", F.col("recorded") % 50), 6), "CASE WHEN recorded % 50 > 0 THEN round(failed / (recorded % 50), 6) ELSE 0.0 END")
_of_progress("fn_backoff_domain", lambda r: m.backoff_policy((F.col("progress_id") % 12).cast("int"), 2.0, 2.0, 300.0), "least(2.0 * pow(2.0, progress_id % 12), CAST(300 AS DOUBLE))")
_of_progress("fn_backoff_sql", lambda r: m.backoff_conflict_ms((F.col("progress_id") % 5).cast("int")), "250.0 * pow(2.0, greatest(progress_id % 5, 1) - 1)")
_query("fn_failure_rate_batch", lambda r: _rates(r, "failure_rate"), "outcomes", "SELECT part // 100 AS batch_no, round(sum(CASE WHEN status = 3 THEN 1 ELSE 0 END) / count(*), 8) AS x FROM outcomes GROUP BY 1")
_query("fn_items_per_sec", lambda r: _rates(r, "items_per_sec"), "outcomes", "SELECT part // 100 AS batch_no, round(count(*) / 2.0, 8) AS x FROM outcomes GROUP BY 1")


def _rates(r: Relations, column: str) -> DataFrame:
    from vaultflow.operators import batches

    return batches.batch_results(_batched(r)).select("batch_no", F.round(column, 8).alias("x"))


_query("fn_truncate", lambda r: r.vault.versions.select("part", p.truncated("title", 30).alias("t")), "versions", "SELECT part, CASE WHEN length(title) > 30 THEN left(title, 27) || '…' ELSE title END AS t FROM versions")
_query("fn_checksum_sha1", lambda r: r.vault.contents.select("part", k.checksum("data", "sha1").alias("h")), "contents", "SELECT part, sha1(data) AS h FROM contents")
_query("fn_checksum_md5", lambda r: r.vault.contents.select("part", k.checksum("data", "md5").alias("h")), "contents", "SELECT part, md5(data) AS h FROM contents")
_query("fn_checksum_none", lambda r: r.vault.contents.select("part", k.checksum("data", None).alias("h")), "contents", "SELECT part, CAST(NULL AS VARCHAR) AS h FROM contents")
_query("fn_wal_parse", lambda r: r.checkpoints.select("job_id", k.parse_wal(F.concat(k.wal_line("last_part", "last_ver", "processed", "checkpoint_at"), F.when(F.col("job_id") % 3 == 0, "x").otherwise(""))).alias("w")).select("job_id", "w.last_part"), "checkpoints",
       "SELECT job_id, CASE WHEN job_id % 3 <> 0 THEN last_part END AS last_part FROM checkpoints")
_query("fn_dateadd_backoff", lambda r: r.audit.select("audit_id", m.after_seconds("occurred", F.col("audit_id") % 500).alias("t")), "audit", "SELECT audit_id, occurred + to_seconds(audit_id % 500) AS t FROM audit")
_query("fn_now", lambda r: r.jobs.select("job_id", _as_of().alias("now")), "jobs", f"SELECT job_id, {NOW} AS now FROM jobs")
_query("fn_json_null_when_absent", lambda r: r.jobs.select("job_id", m.json_or_null("expected").alias("j")), "jobs", "SELECT job_id, CASE WHEN expected IS NOT NULL THEN '{\"expected\":' || expected || '}' END AS j FROM jobs")
_query("fn_health_label", lambda r: r.workers.select("worker_id", m.health_label("status", F.when(F.col("worker_id") % 5 > 0, F.col("heartbeat")), m.seconds_between("heartbeat", _as_of())).alias("h")), "workers",
       f"SELECT worker_id, {_HEALTH} AS h FROM (SELECT * REPLACE (CASE WHEN worker_id % 5 > 0 THEN heartbeat END AS heartbeat) FROM workers) w")
_query("fn_outcome_name", lambda r: r.table("part").select("p_partkey", k.outcome_name((F.col("p_partkey") % 5).cast("int")).alias("name")), "", "SELECT p_partkey, ['Unknown', 'Pending', 'Succeeded', 'Failed', 'Skipped'][p_partkey % 5 + 1] AS name FROM part")

# Constraints that the catalogue does not have yet.
_ID = {"workers": "worker_id", "metrics": "metric_id", "errors": "error_id", "audit": "audit_id", "work_items": "item_id", "progress": "progress_id", "checkpoints": "checkpoint_id"}
#: Domains that _faulty leaves whole: every third row, by its id, gets a value that is in no domain.
_ODD = {("workers", "status"), ("metrics", "status"), ("errors", "severity"), ("errors", "status"), ("audit", "action"), ("audit", "actor_type"), ("audit", "status"), ("work_items", "status"), ("progress", "status"), ("checkpoints", "status")}
for (_table, _col), _values in schemas.DOMAINS.items():
    if (_table, _col) in _ODD:
        _query(f"c_domain_{_table}_{_col}", lambda r, t=_table, c=_col: quality.violations(f"c_domain_{t}_{c}", {t: r.tables[t].withColumn(c, F.when(F.col(_ID[t]) % 3 == 0, "Odd").otherwise(F.col(c)))}).select(_ID[t]), _table, f"SELECT {_ID[_table]} FROM {_table} WHERE {_ID[_table]} % 3 = 0")
        continue
    _sql = f"SELECT job_id FROM {_bad(_table)} WHERE {_col} NOT IN ({', '.join(repr(v) for v in _values)})"
    _query(f"c_domain_{_table}_{_col}", lambda r, n=f"c_domain_{_table}_{_col}": quality.violations(n, _faulty(r)).select("job_id"), "jobs workers metrics errors audit work_items", _sql)
for _name, (_child, _key, _parent, _) in quality.FOREIGN.items():
    if _parent == "workers":  # every fifth row names a worker that there is not
        _query(_name, lambda r, n=_name, t=_child: quality.violations(n, {t: r.tables[t].withColumn("worker_id", F.when(F.col(_ID[t]) % 5 == 0, F.lit(10**12)).otherwise(F.col("worker_id"))), "workers": r.workers}).select(_ID[t]), f"{_child} workers",
               f"SELECT {_ID[_child]} FROM {_child} WHERE {_ID[_child]} % 5 = 0 OR worker_id NOT IN (SELECT worker_id FROM workers)")
        continue
    _gone = "SELECT job_id FROM jobs WHERE job_id % 23 <> 0" if _parent == "jobs" else "SELECT worker_id FROM workers"
    _from = _bad(_child) if _child != "checkpoints" else "(SELECT * FROM checkpoints UNION ALL SELECT * FROM checkpoints WHERE job_id % 3 = 0)"
    _query(_name, lambda r, n=_name: quality.violations(n, _faulty(r)).select("job_id"), "jobs workers progress metrics errors checkpoints audit work_items", f"SELECT job_id FROM {_from} WHERE {_key} IS NOT NULL AND {_key} NOT IN ({_gone})")
_query("c_completed_shape", lambda r: quality.violations("c_completed_shape", {"work_items": r.work_items.withColumn("checksum", F.when(F.col("item_id") % 7 > 0, F.col("checksum")))}).select("item_id"), "work_items", "SELECT item_id FROM work_items WHERE status = 'Completed' AND item_id % 7 = 0")
_query("c_json_details", lambda r: quality.violations("c_json_details", {"audit": r.audit.withColumn("details", F.when(F.col("audit_id") % 9 == 0, "[1").otherwise(F.col("details")))}).select("audit_id"), "audit", "SELECT audit_id FROM audit WHERE audit_id % 9 = 0")
_query("c_unique_workers", lambda r: quality.violations("c_unique_workers", {"workers": r.workers.unionByName(r.workers.filter("worker_id % 2 = 0"))}).select("worker_name", "n"), "workers", "SELECT worker_name, CAST(2 AS BIGINT) AS n FROM workers WHERE worker_id % 2 = 0")
_query("try_advance", lambda r: r.checkpoints.select("job_id", state.advances(F.col("last_part") + F.col("job_id") % 2, "last_ver", "last_part", "last_ver").alias("advanced")), "checkpoints", "SELECT job_id, job_id % 2 > 0 AS advanced FROM checkpoints")


# Validators, over payloads that stand for files.
def _validated(r: Relations) -> DataFrame:
    path = F.concat(F.lit("/out/"), F.col("part").cast("string"), F.lit(".txt"))
    files = r.vault.contents.filter("part % 7 <> 0").select(path.alias("path"), F.octet_length("data").cast("bigint").alias("length"), F.col("data").alias("content"), (F.col("part") % 11 != 0).alias("readable"))
    o = r.vault.contents.select(
        "part", F.when(F.col("part") % 13 == 0, "").otherwise(path).alias("path"), (F.octet_length("data") + F.when(F.col("part") % 5 == 0, 1).otherwise(0)).cast("bigint").alias("expected_size"),
        F.when(F.col("part") % 3 == 0, F.lit("00")).otherwise(F.sha2("data", 256)).alias("expected_checksum"), F.when(F.col("part") % 17 == 0, "pdf").otherwise("TXT").alias("expected_extension"),
        F.when(F.col("part") % 2 == 0, F.lit("/other")).alias("meta_path"), F.octet_length("data").cast("bigint").alias("meta_size"), F.lit(None).cast("string").alias("meta_checksum"),
    )
    return validation.validate(o, files, "/out")


_FIRST = {
    "v_exists": "part % 13 = 0 OR part % 7 = 0", "v_extension": "part % 17 = 0", "v_size": "part % 5 = 0", "v_readable": "part % 11 = 0", "v_checksum": "part % 3 = 0", "v_metadata": "part % 2 = 0",
}
_before: list[str] = []
for _name, _fails in _FIRST.items():
    _where = " AND ".join([f"({_fails})", *(f"NOT ({x})" for x in _before)])
    _query(_name, lambda r, n=_name[2:]: _validated(r).filter(F.col("failed_check") == n).select("part", "retryable"), "contents", f"SELECT part, {'part % 13 <> 0' if _name == 'v_exists' else 'true' if _name == 'v_readable' else 'false'} AS retryable FROM contents WHERE {_where}")
    _before.append(_fails)
_query("v_folder", lambda r: validation.validate(_outside(r), _outside(r).select("path", F.lit(1).cast("bigint").alias("length"), F.lit(b"x").alias("content")), "/out").filter("failed_check = 'folder'").select("part"), "versions", "SELECT part FROM versions WHERE part % 4 = 0")
_query("sort_validators", lambda r: r.spark.createDataFrame([(10 * i, n) for i, n in enumerate(validation.ORDER)], "position int, name string"), "",
       "SELECT CAST(10 * i AS INTEGER) AS position, ['exists', 'folder', 'extension', 'size', 'readable', 'checksum', 'metadata'][i + 1] AS name FROM range(7) t(i)")


def _outside(r: Relations) -> DataFrame:
    path = F.concat(F.when(F.col("part") % 4 == 0, "/elsewhere/").otherwise("/out/"), F.col("part").cast("string"), F.lit(".txt"))
    none = F.lit(None).cast("string")
    return r.vault.versions.select("part", path.alias("path"), F.lit(1).cast("bigint").alias("expected_size"), none.alias("expected_checksum"), F.lit("txt").alias("expected_extension"), none.alias("meta_path"), F.lit(None).cast("bigint").alias("meta_size"), none.alias("meta_checksum"))


# Sinks.
def _folder(r: Relations, name: str) -> str:
    return f"{r.spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_{name}-{uuid.uuid4().hex}"


def _written(r: Relations) -> DataFrame:
    """Writes the payloads and returns their outcomes, with paths from the root on."""
    root = urlparse(_folder(r, "export")).path
    rows = scan.attach_content(scan.scan_documents(r.vault), r.vault).withColumns({"title": F.lit(""), "logical_size": F.octet_length("data").cast("bigint")})
    done = sinks.write_documents(rows, root)
    return done.select("part", "status", "bytes_written", "checksum", F.substring("output_path", len(root) + 2, 200).alias("path"))


_query("sink_content_addressed", _written, "descr contents",
       """SELECT d.part, CAST(CASE WHEN c.data IS NULL THEN 4 ELSE 2 END AS INTEGER) AS status, CAST(coalesce(strlen(c.data), 0) AS BIGINT) AS bytes_written, sha256(c.data) AS checksum,
       CASE WHEN c.data IS NOT NULL THEN substring(d.idempotency_key, 1, 2) || '/' || substring(d.idempotency_key, 3, 2) || '/' || d.idempotency_key || '.' || d.extension END AS path FROM descr d LEFT JOIN contents c ON c.part = d.part AND c.dfv = d.dfv""")
_query("sink_original_name", lambda r: p.resolve_duplicates(scan.scan_documents(r.vault).select(F.concat_ws("/", p.folder_category(F.lit(None).cast("string"), "extension"), p.sanitize(p.left("title", 4), "extension")).alias("path"), F.col("idempotency_key").alias("key"), "part"), "hash_suffix").groupBy("path").agg(F.count(F.lit(1)).alias("n")))
_query("sink_json_metadata", lambda r: _back(r, "json").select("value"))
_query("sink_jsonl_manifest", lambda r: _manifest_back(r), "outcomes", "SELECT part AS \"DocumentFilePartId\", ['Unknown', 'Pending', 'Succeeded', 'Failed', 'Skipped'][status + 1] AS \"Status\" FROM outcomes")
_query("sink_metadata_fanout", lambda r: r.spark.createDataFrame(sinks.write_metadata(_records(r), _folder(r, "metadata")), "relative_path string, format string, record_count bigint"), "descr outcomes",
       "SELECT 'metadata.' || f AS relative_path, f AS format, (SELECT count(*) FROM descr d JOIN outcomes o ON o.idempotency_key = d.idempotency_key) AS record_count FROM (VALUES ('csv'), ('json')) t(f)")
_query("sink_outcomes_upsert", lambda r: state.counters(state.upsert_outcomes(r.outcomes.limit(0), r.outcomes.withColumn("seq", F.lit(1)))), "outcomes",
       "SELECT count(*) AS total_recorded, CAST(sum(CAST(status = 2 AS INTEGER)) AS BIGINT) AS total_succeeded, CAST(sum(CAST(status = 3 AS INTEGER)) AS BIGINT) AS total_failed, CAST(sum(CAST(status = 4 AS INTEGER)) AS BIGINT) AS total_skipped, CAST(sum(bytes_written) AS BIGINT) AS total_bytes_written FROM outcomes")
_query("sink_outcomes_conflict", lambda r: state.counters(state.upsert_outcomes(r.outcomes.filter("part % 3 > 0").withColumns({"status": F.lit(3), "bytes_written": F.lit(7).cast("bigint")}), r.outcomes.filter("part % 2 = 0").withColumn("seq", F.lit(1)))), "outcomes",
       """SELECT count(*) AS total_recorded, CAST(sum(CAST(s = 2 AS INTEGER)) AS BIGINT) AS total_succeeded, CAST(sum(CAST(s = 3 AS INTEGER)) AS BIGINT) AS total_failed, CAST(sum(CAST(s = 4 AS INTEGER)) AS BIGINT) AS total_skipped, CAST(sum(b) AS BIGINT) AS total_bytes_written
       FROM (SELECT CASE WHEN part % 2 = 0 THEN status ELSE 3 END AS s, CASE WHEN part % 2 = 0 THEN bytes_written ELSE 7 END AS b FROM outcomes WHERE part % 2 = 0 OR part % 3 > 0)""")
_query("sink_tvp_batch", lambda r: tracking.append(r.errors, r.errors.filter("error_id % 50 = 0"), "error_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("error_id").alias("ids")), "errors", "SELECT count(*) + (SELECT count(*) FROM errors WHERE error_id % 50 = 0) AS n, count(*) + (SELECT count(*) FROM errors WHERE error_id % 50 = 0) AS ids FROM errors")
_query("sink_console_report", lambda r: r.spark.createDataFrame([(x,) for x in sinks.console_table(r.workers.orderBy("worker_id").select("worker_id", "status", "stopped"), 16).split("\n")], "line string"))
_query("sink_audit_log", lambda r: _audit_back(r), "audit", "SELECT action, actor_name AS actor, entity_type || '/' || entity_id AS subject, strftime(occurred, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS time FROM audit")
_query("sink_metrics_prom_otlp", lambda r: sinks.exposition(r.metrics.groupBy("metric_name").agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.concat("metric_name", F.lit(".total")).alias("name"), F.lit("counter").alias("kind"), F.create_map(F.lit("unit"), F.lit("ms")).alias("labels"), "value")), "metrics",
       "SELECT '# TYPE vaultflow_' || metric_name || '_total counter' AS value FROM metrics GROUP BY metric_name UNION ALL SELECT 'vaultflow_' || metric_name || '_total{unit=\"ms\"} ' || CAST(CAST(count(*) AS DOUBLE) AS VARCHAR) FROM metrics GROUP BY metric_name")


def _back(r: Relations, kind: str) -> DataFrame:
    root = _folder(r, kind)
    {"json": sinks.write_json, "csv": sinks.write_csv}[kind](_records(r), root)
    return r.spark.read.text(root)


def _manifest_back(r: Relations) -> DataFrame:
    root = _folder(r, "manifest")
    sinks.write_manifest_lines(r.outcomes, root)
    return r.spark.read.json(root).select("DocumentFilePartId", "Status")


def _audit_back(r: Relations) -> DataFrame:
    root = _folder(r, "audit")
    sinks.write_audit_log(r.audit, root)
    return r.spark.read.json(root).select("action", "actor", "subject", "time")


# Streams, and what they compute as batches.
def _streamed(r: Relations) -> DataFrame:
    """Runs the export as a stream over Parquet files of descriptors, one file a batch, and returns the recorded totals."""
    root = _folder(r, "stream")
    rows = scan.scan_documents(r.vault)
    rows.repartition(3, "part").write.parquet(f"{root}/source")

    def process(batch: DataFrame) -> DataFrame:
        none = F.lit(None).cast("string")
        return batch.select("idempotency_key", "part", "ver", "dfv", F.when(F.col("part") % 9 == 1, schemas.FAILED).otherwise(schemas.SUCCEEDED).alias("status"), F.col("logical_size").alias("bytes_written"), none.alias("output_path"), none.alias("checksum"), none.alias("failure_reason"), F.lit(1).alias("attempt"))

    s = export.ExportStream(r.spark, f"{root}/state", process)
    s.start(export.descriptor_stream(r.spark, f"{root}/source", rows.schema), f"{root}/checkpoint").awaitTermination()
    return state.counters(s.recorded()).select("total_recorded", "total_succeeded", "total_failed").crossJoin(F.broadcast(s.cursors.read().select("last_part")))


_query("st_micro_batch_flush", _streamed, "descr", "SELECT count(*) AS total_recorded, count(*) - CAST(sum(CAST(part % 9 = 1 AS INTEGER)) AS BIGINT) AS total_succeeded, CAST(sum(CAST(part % 9 = 1 AS INTEGER)) AS BIGINT) AS total_failed, max(part) AS last_part FROM descr")


def _watermarked(r: Relations) -> DataFrame:
    """Events by five-minute windows as a stream, with all windows in the end."""
    source = r.spark.readStream.schema(r.table("events").schema).parquet(f"{r.sf_dir}/events.parquet*")
    name = f"rates_{uuid.uuid4().hex}"
    w = export.rates(source.withColumn("ts", F.col("ts").cast("timestamp"))).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True)
    w.start().awaitTermination()
    return r.spark.table(name).select(F.col("bucket").cast("timestamp_ntz").alias("bucket"), "n", F.round("per_second", 8).alias("per_second"))


_query("st_rate", _watermarked, "metrics", "SELECT time_bucket(INTERVAL 5 MINUTE, captured) AS bucket, count(*) AS n, round(count(*) / 300.0, 8) AS per_second FROM metrics GROUP BY 1")
_query("st_quantile", lambda r: metrics.quantiles(r.metrics, "value", ("job_id",), (0.5, 0.9), exact=True).select("job_id", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90")), "metrics", "SELECT job_id, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90 FROM metrics GROUP BY 1")
_query("st_clamp", lambda r: r.metrics.select("metric_id", F.greatest("value", F.lit(1.0)).alias("v")), "metrics", "SELECT metric_id, greatest(value, 1.0) AS v FROM metrics")
_query("st_checkpoint_timer", lambda r: state.high_water(r.outcomes.filter("status IN (2, 4)")), "outcomes", "SELECT part AS last_part, ver AS last_ver FROM outcomes WHERE status IN (2, 4) ORDER BY part DESC, ver DESC LIMIT 1")
_query("fn_json_manifest_doc", lambda r: sinks.manifest_document(r.jobs.filter("job_id = 12"), state.counters(r.outcomes), r.spark.createDataFrame([("m.csv", "csv", 3)], "relative_path string, format string, record_count long"), AS_OF))
