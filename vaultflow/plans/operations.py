"""More queries by name: argument and option guards, dashboard panels, streams as streams, durability, statistics, and all constraints at once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow.functions import guards, paths
from vaultflow.operators import maintenance, quality, scan
from vaultflow.plans import metrics
from vaultflow.plans.catalogue import _B5, _VIOLATIONS, _bad, _faulty, _query
from vaultflow.plans.extras import _folder, _streamed
from vaultflow.plans.mapping import Relations
from vaultflow.schemas import DOMAINS
from vaultflow.sources import wal
from vaultflow.streaming import export

# Guards, over tables of arguments and options: each column is an expression that Spark and the SQL share, and the rule is said anew in the SQL.
_BLANK = "CASE WHEN p_partkey % {0} = 0 THEN '' WHEN p_partkey % {0} = 1 THEN '  ' WHEN p_partkey % {0} = 2 THEN NULL ELSE p_brand END"


def _given(name: str, n: int) -> tuple[str, str, str]:
    return name, _BLANK.format(n), f"CASE WHEN trim(coalesce({name}, '')) = '' THEN '{name}:REQUIRED' END"


def _above(name: str, n: int) -> tuple[str, str, str]:
    return name, f"CAST(CASE WHEN p_partkey % {n} = 1 THEN NULL ELSE p_partkey % {n} END AS BIGINT)", f"CASE WHEN {name} IS NULL OR {name} <= 0 THEN '{name}:RANGE' END"


def _free(name: str, n: int) -> tuple[str, str, str]:
    return name, f"CAST(CASE WHEN p_partkey % {n} = 1 THEN NULL ELSE p_partkey % {n} - 3 END AS BIGINT)", f"CASE WHEN {name} < 0 THEN '{name}:RANGE' END"


def _range(name: str, low: float, high: float | None, n: int) -> tuple[str, str, str]:
    """Values below, at and above both ends."""
    top = low + 7 if high is None else high
    made = f"CAST(CASE p_partkey % {n} WHEN 0 THEN {low} WHEN 1 THEN {top} WHEN 2 THEN {low} - 1 WHEN 3 THEN {top} + 1 WHEN 4 THEN NULL ELSE ({low} + {top}) / 2 END AS DOUBLE)"
    return name, made, f"CASE WHEN {name} IS NULL OR {name} < {low}" + (f" OR {name} > {high}" if high is not None else "") + f" THEN '{name}:RANGE' END"


def _choice(name: str, values: tuple[str, ...], n: int) -> tuple[str, str, str]:
    made = "CASE p_partkey % {} WHEN 0 THEN 'Odd' WHEN 1 THEN NULL {} ELSE '{}' END".format(n, " ".join(f"WHEN {i + 2} THEN '{v}'" for i, v in enumerate(values)), values[0])
    return name, made, f"CASE WHEN {name} IS NULL OR {name} NOT IN ({', '.join(repr(v) for v in values)}) THEN '{name}:VALUE' END"


_GUARDS: dict[str, tuple[str, list[tuple[str, str, str]]]] = {
    "g_claim": ("claim", [_above("job_id", 5), _above("worker_id", 6), _range("batch_size", 1, 10_000, 7), _range("lease_seconds", 1, 3_600, 8)]),
    "g_complete": ("complete", [_above("item_id", 5), _given("token", 6), _given("output_path", 7), _given("checksum", 8), _free("bytes_written", 9)]),
    "g_fail": ("fail", [_above("item_id", 5), _given("token", 6), _given("reason", 7), _range("backoff_seconds", 0, 3_600, 8)]),
    "g_renew": ("renew", [_above("item_id", 5), _given("token", 6), _range("extend_by", 1, 3_600, 7)]),
    "g_reclaim": ("reclaim", [_range("backoff_seconds", 0, 3_600, 7), _range("reclaim_rows", 1, 100_000, 8)]),
    "g_start_job": ("start_job", [_given("name", 5), _given("server", 6), _given("database", 7), _given("partition", 8), _free("expected", 9)]),
    "g_complete_job": ("complete_job", [_above("job_id", 5), _choice("status", ("Completed", "Failed", "Cancelled"), 7)]),
    "g_register": ("register", [_above("job_id", 5), _given("worker_name", 6), _given("machine", 7), _given("partition", 8), _range("concurrency", 1, 256, 9)]),
    "g_heartbeat": ("heartbeat", [_above("worker_id", 5), _choice("status", ("Active", "Idle", "Stalled"), 7)]),
    "g_checkpoint": ("checkpoint", [_above("job_id", 5), _given("partition", 6)]),
    "g_log_error": ("log_error", [_above("job_id", 5), _given("severity", 6), _given("category", 7), _given("source", 8), _given("message", 9), _above("attempt", 10)]),
    "g_resolve": ("resolve", [_above("error_id", 5), _choice("status", ("Resolved", "Ignored"), 6), _given("by", 7)]),
    "g_audit_take": ("audit_take", [_range("audit_take", 1, 10_000, 7)]),
    "g_source_opts": ("source", [_given("connection", 5), _above("command_timeout", 6), _range("page_size", 50, 100_000, 7), _given("partition", 8), _given("versions_table", 9), _given("files_table", 10), _given("contents_table", 11)]),
    "g_storage_opts": ("storage", [_given("root", 5), _given("manifest", 6), _range("shard_depth", 1, 4, 7), _range("write_buffer", 4_096, None, 8), _above("rotation_entries", 9), _range("free_space_gb", 0, None, 10)]),
    "g_pipeline_opts": ("pipeline", [_above("scan_capacity", 5), _above("content_capacity", 6), _range("reader_concurrency", 1, 256, 7), _range("sink_concurrency", 1, 256, 8), _range("outcome_batch", 1, 10_000, 9), _above("report_interval", 10), _above("flush_interval", 11)]),
    "g_batch_opts": ("batch", [_range("run_batch_size", 1, 100_000, 7), _range("parallelism", 1, 512, 8), _above("timeout", 5), _range("pause", 0, None, 9), _range("failure_threshold", 0, 1, 10)]),
    "g_file_opts": ("file", [_given("root", 5), _range("shard_depth", 1, 4, 7), _above("buckets", 6), _given("date_pattern", 8), _range("file_name_length", 16, 255, 9), _range("path_length", 64, 32_767, 10), _range("write_buffer", 4_096, None, 11), _given("default_title", 12)]),
    "g_metadata_opts": ("metadata", [_given("directory", 5), _given("csv_name", 6), _given("json_name", 7), _given("manifest_name", 8), _given("delimiter", 9), _above("flush_records", 10)]),
    "g_retry_opts": ("retry", [_range("attempts", 1, 100, 7), _range("base_ms", 0, 60_000, 8), _range("cap_seconds", 0, 3_600, 9), _range("timeout_seconds", 0, None, 10), _range("jitter", 0, 1, 11)]),
    "g_job_config": ("job", [_given("partition", 5), _range("batch_size", 50, 100_000, 7), _range("reader_concurrency", 1, 256, 8), _range("sink_concurrency", 1, 256, 9), _range("max_document_mb", 0, None, 10), _above("report_interval", 11), _above("flush_interval", 12)]),
}
for _name, (_kind, _columns) in _GUARDS.items():
    _query(_name, lambda r, k=_kind, cs=_columns: (lambda df: df.select("p_partkey", guards.failed_options(k, df).alias("failed")))(r.table("part").select("p_partkey", *(F.expr(e).alias(c) for c, e, _ in cs))), "",
           f"SELECT p_partkey, concat_ws(',', {', '.join(w for *_, w in _columns)}) AS failed FROM (SELECT p_partkey, {', '.join(f'{e} AS "{c}"' for c, e, _ in _columns)} FROM part)".replace("CASE WHEN trim(coalesce(by,", 'CASE WHEN trim(coalesce("by",'))  # by is a keyword

# Panels. Kinds of events stand for the names of counters and gauges.
_B1 = "time_bucket(INTERVAL 1 MINUTE, captured)"


def _panel_rate(name: str, minutes: int, event: str | None, value: str | None = None, by: tuple[str, ...] = ()) -> None:
    own = lambda r: r.metrics if event is None else r.metrics.filter(F.col("metric_name") == event)
    total, where, bucket = f"sum({value})" if value else "count(*)", f"WHERE metric_name = '{event}'" if event else "", f"time_bucket(INTERVAL {minutes} MINUTE, captured)"
    _query(name, lambda r: metrics.rate(own(r), "captured", minutes, value, by).select("bucket", *by, F.round("per_second", 6).alias("per_second")), "metrics",
           f"SELECT {', '.join([f'{bucket} AS bucket', *by])}, round({total} / {60.0 * minutes}, 6) AS per_second FROM metrics {where} GROUP BY {', '.join([bucket, *by])}")


def _panel_gauge(name: str, event: str, by: str) -> None:
    """The last sample of each label."""
    _query(name, lambda r: metrics.latest(r.metrics.filter(F.col("metric_name") == event), "captured", "metric_id", by), "metrics", f"SELECT {by}, value FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY captured DESC, metric_id DESC) AS rn FROM metrics WHERE metric_name = '{event}') WHERE rn = 1")


_panel_rate("g_export_speed", 5, "purchase")
_panel_rate("g_docs_rate", 1, None, None, ("metric_name",))
_panel_rate("g_bytes_rate", 1, "view", "value")
_panel_rate("g_retries_rate", 5, "error", None, ("job_id",))
_panel_rate("g_cpu", 1, "click", "value")
for _name, _event in (("g_queue_depth", "click"), ("g_queue_saturation", "view"), ("g_worker_utilization", "purchase"), ("g_memory", "login"), ("g_disk_free", "error")):
    _panel_gauge(_name, _event, "job_id")
for _name, _column in (("g_exported_total", "succeeded"), ("g_failed_total", "failed"), ("g_skipped_total", "skipped")):
    _query(_name, lambda r, c=_column: r.latest.agg(F.sum(c).alias("value")), "latest", f"SELECT CAST(sum({_column}) AS BIGINT) AS value FROM latest")
_query("g_eta", lambda r: r.latest.join(r.jobs, "job_id").filter("expected > recorded AND docs_per_sec > 0").agg(F.round(F.max((F.col("expected") - F.col("recorded")) / F.col("docs_per_sec").cast("double")), 6).alias("value")), "latest jobs",
       "SELECT round(max((expected - recorded) / CAST(docs_per_sec AS DOUBLE)), 6) AS value FROM latest l JOIN jobs j ON j.job_id = l.job_id WHERE expected > recorded AND docs_per_sec > 0")
_query("g_workers_state", lambda r: r.workers.groupBy("status").agg(F.count(F.lit(1)).alias("n")).filter("status IN ('Active', 'Stalled')"), "workers", "SELECT status, count(*) AS n FROM workers WHERE status IN ('Active', 'Stalled') GROUP BY 1")
_query("g_sql_latency", lambda r: metrics.quantiles(r.metrics.withColumn("bucket", metrics.bucket("captured", 5)), "value", ("bucket",), exact=True).select("bucket", *(F.round(c, 6).alias(c) for c in ("p50", "p95", "p99"))), "metrics",
       f"SELECT {_B5} AS bucket, {', '.join(f'round(quantile_cont(value, {q / 100}), 6) AS p{q}' for q in (50, 95, 99))} FROM metrics GROUP BY 1")

# All constraints at once.
_DOMAIN_SQL = {f"c_domain_{t}_{c}": (t, f"{c} NOT IN ({', '.join(repr(v) for v in vs)})") for (t, c), vs in DOMAINS.items()}


def _all_sql() -> str:
    """Every predicate, key and reference of the relations with faults, with the SQL of each."""
    where = _DOMAIN_SQL | {k: v for k, v in _VIOLATIONS.items() if k in quality.CHECKS and k not in _DOMAIN_SQL} | {"c_completed_shape": ("work_items", "FALSE"), "c_json_details": ("audit", "FALSE")}
    # The mapped relations keep no more of these columns than one valid value.
    where |= {f"c_domain_{t}_{c}": (t, "FALSE") for t, c in (("progress", "status"), ("audit", "status"), ("audit", "actor_type"))}
    twice = "SELECT * FROM checkpoints UNION ALL SELECT * FROM checkpoints WHERE job_id % 3 = 0"
    of = lambda t: f"({twice})" if t == "checkpoints" else _bad(t) if t != "progress" else _bad("progress")
    parts = [f"SELECT '{k}' AS rule, '{t}' AS relation, (SELECT count(*) FROM {of(t)}) AS n_rows, (SELECT count(*) FROM {of(t)} WHERE {w}) AS violations" for k, (t, w) in where.items() if k in quality.CHECKS]
    for k, (t, cols, when) in quality.UNIQUE.items():
        keys = ", ".join(cols)
        parts.append(f"SELECT '{k}', '{t}', (SELECT count(*) FROM {of(t)}), (SELECT count(*) FROM (SELECT {keys} FROM {of(t)} {f'WHERE {when}' if when else ''} GROUP BY {keys} HAVING count(*) > 1))")
    for k, (t, col, parent, key) in quality.FOREIGN.items():
        parts.append(f"SELECT '{k}', '{t}', (SELECT count(*) FROM {of(t)}), (SELECT count(*) FROM {of(t)} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {key} FROM {of(parent)}))")
    return "\nUNION ALL ".join(parts)


_query("c_all", lambda r: quality.all_rules(_faulty(r)), "jobs workers progress metrics errors checkpoints audit work_items", _all_sql())


# Streams as streams, to their end.
_STATE = "spark.sql.streaming.stateStore.providerClass"


def _ended(r: Relations, df: DataFrame, mode: str) -> DataFrame:
    """What the stream df brings, as Parquet that its executors write; each batch is a folder, in complete mode the last alone. State lies
    in RocksDB, so that neither rows nor keys need to fit a heap."""
    root, seen = _folder(r, "stream"), []

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/{n}")
        seen.append(f"{root}/{n}")

    before = r.spark.conf.get(_STATE)
    r.spark.conf.set(_STATE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{root}-checkpoint").trigger(availableNow=True).start()
    finally:
        r.spark.conf.set(_STATE, before)
    query.awaitTermination()
    folders = dict.fromkeys(seen if mode == "append" else seen[-1:])
    return r.spark.read.schema(df.schema).parquet(*folders) if folders else r.spark.createDataFrame([], df.schema)


def _event_stream(r: Relations) -> DataFrame:
    rows = r.table("events")
    return r.spark.readStream.schema(rows.schema).parquet(f"{r.sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


def _outcome_stream(r: Relations, root: str) -> DataFrame:
    r.outcomes.repartition(4, "part").write.parquet(root)
    return r.spark.readStream.schema(r.outcomes.schema).option("maxFilesPerTrigger", 1).parquet(root)


_query("st_dedupe_stream", lambda r: _ended(r, export.deduplicated(_event_stream(r).select("ts", F.explode(F.array("event_id", "event_id")).alias("key")), "key").select("key"), "append"), "", "SELECT event_id AS key FROM events")
_query("st_counters_stream", lambda r: _ended(r, export.counters(_outcome_stream(r, _folder(r, "counters"))), "complete"), "outcomes", "SELECT status, count(*) AS n, CAST(sum(bytes_written) AS BIGINT) AS bytes_written FROM outcomes GROUP BY 1")
_query("st_heartbeat_sessions", lambda r: _ended(r, export.heartbeat_sessions(_event_stream(r).withColumn("worker_id", F.col("user_id")), gap="12 hours"), "complete").select("worker_id", F.col("started").cast("timestamp_ntz").alias("started"), F.col("silent_since").cast("timestamp_ntz").alias("silent_since"), "beats"), "",
       """SELECT worker_id, min(t) AS started, max(t) + INTERVAL 12 HOUR AS silent_since, count(*) AS beats FROM (SELECT *, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY worker_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS s
       FROM (SELECT user_id AS worker_id, CAST(ts AS TIMESTAMP) AS t, coalesce(CAST(ts AS TIMESTAMP) >= lag(CAST(ts AS TIMESTAMP)) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR, true) AS apart FROM events)) GROUP BY worker_id, s""")


def _bounded(r: Relations) -> DataFrame:
    """Batches of one file each, as a channel of that capacity would bring them: how many rows each brought."""
    root = _folder(r, "bounded")
    rows = scan.scan_documents(r.vault)
    rows.withColumn("share", F.pmod("part", F.lit(4))).repartition(4, "share").write.partitionBy("share").parquet(root)
    brought: list[tuple[int]] = []
    stream = export.descriptor_stream(r.spark, f"{root}/*", rows.schema)
    stream.writeStream.foreachBatch(lambda b, _: brought.append((b.count(),))).option("checkpointLocation", f"{root}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return r.spark.createDataFrame(brought, "n bigint")


_query("st_bounded_channels", _bounded, "descr", "SELECT count(*) AS n FROM descr GROUP BY part % 4")


def _published(r: Relations) -> DataFrame:
    """What a listener publishes of the export as a stream, summed up."""
    said: list[dict] = []
    publisher = export.ProgressPublisher(said.append)
    r.spark.streams.addListener(publisher)
    try:
        _streamed(r)
        publisher.ended.wait(60)
    finally:
        r.spark.streams.removeListener(publisher)
    return r.spark.createDataFrame([(sum(x["rows"] for x in said), publisher.failed)], "n bigint, failed int")


_query("st_progress_publish", _published, "descr", "SELECT count(*) AS n, CAST(0 AS INTEGER) AS failed FROM descr")


# Durability.
def _wal_back(r: Relations) -> DataFrame:
    """Writes the write-ahead record of each partition (four of them) and reads the files."""
    root = _folder(r, "wal")
    for x in r.checkpoints.groupBy("partition_key").agg(F.max(F.struct("last_part", "last_ver")).alias("c"), F.sum("processed").alias("n")).limit(256).collect():
        wal.put_wal(r.spark, root, x["partition_key"], 0, 0, 0, "2024-01-30T00:00:00.000Z")  # replaced as a whole
        wal.put_wal(r.spark, root, x["partition_key"], x["c"]["last_part"], x["c"]["last_ver"], x["n"], "2024-01-31T00:00:00.000Z")
    return wal.read_wal(r.spark, f"{root}/*.wal").select(F.regexp_replace("file", r"\.wal$", "").alias("partition_key"), "last_part", "last_ver", "processed")


_WAL_SQL = "SELECT partition_key, max(last_part) AS last_part, arg_max(last_ver, last_part * 100 + last_ver) AS last_ver, CAST(sum(processed) AS BIGINT) AS processed FROM checkpoints GROUP BY 1"
_query("sink_wal", _wal_back, "checkpoints", _WAL_SQL)
_query("read_wal_files", lambda r: _wal_back(r).select("partition_key", "last_part", "last_ver"), "checkpoints", f"SELECT partition_key, last_part, last_ver FROM ({_WAL_SQL})")


def _three_layers(r: Relations) -> DataFrame:
    """An export whose process ended after its write-ahead record and before the table: what diverged, and what recovery leaves."""
    root = _folder(r, "durable")
    rows = scan.scan_documents(r.vault)
    none = F.lit(None).cast("string")
    make = lambda b: b.select("idempotency_key", "part", "ver", "dfv", F.lit(2).alias("status"), F.col("logical_size").alias("bytes_written"), none.alias("output_path"), none.alias("checksum"), none.alias("failure_reason"), F.lit(1).alias("attempt"))
    s = export.ExportStream(r.spark, root, make)
    s.on_batch(rows.filter("part % 2 = 0"), 0)
    top = rows.agg(F.max("part").alias("p")).first()["p"]
    if top is not None:
        wal.put_wal(r.spark, f"{root}/wal", "default", top + 1, 1, 1, "2024-01-31T00:00:00.000Z")
    before = s.diverged().select("partition_key", "last_part", "source", "behind", F.lit("before").alias("step")).collect()
    s.recover()
    after = s.diverged().select("partition_key", "last_part", "source", "behind", F.lit("after").alias("step"))
    return r.spark.createDataFrame(before, after.schema).unionByName(after)


_query("st_three_layer_durability", _three_layers, "descr", "SELECT 'default' AS partition_key, max(part) + 1 AS last_part, unnest(['wal', 'both']) AS source, unnest(['table', NULL]) AS behind, unnest(['before', 'after']) AS step FROM descr")


def _analyzed(r: Relations) -> DataFrame:
    name = f"stats_{uuid.uuid4().hex}"
    r.checkpoints.select("checkpoint_id", "partition_key").write.saveAsTable(name)
    try:
        return maintenance.analyze(r.spark, name).select("column_name", "num_nulls", "n_rows")
    finally:
        r.spark.sql(f"DROP TABLE {name}")


_query("reindex_stats", _analyzed, "checkpoints", "SELECT unnest(['checkpoint_id', 'partition_key']) AS column_name, CAST(0 AS BIGINT) AS num_nulls, count(*) AS n_rows FROM checkpoints")
_query("fn_quote_ident", lambda r: r.table("part").select("p_partkey", paths.quoted(F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, "`x").otherwise(""))).alias("q")), "", "SELECT p_partkey, '`' || replace(p_name || CASE WHEN p_partkey % 3 = 0 THEN '`x' ELSE '' END, '`', '``') || '`' AS q FROM part")
