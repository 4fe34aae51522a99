"""The vault's and the tracking relations as fixed projections of the general tables, in Spark and in DuckDB's SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.functions.keys import idempotency_key
from vaultflow.operators.scan import Vault
from vaultflow.operators.state import latest_by

AS_OF = "2024-01-31 00:00:00"


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _plus(text: str, seconds: Column) -> Column:
    return _ts(text) + F.make_dt_interval(secs=seconds)


def _pick(values: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (n + 1).cast("int"))


class Relations:
    """Each relation is made when asked for; only the columns that a query uses are read."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def vault(self) -> Vault:
        d = self.table("documents")
        part, dfv = F.col("doc_id").alias("part"), (F.lit(5_000_000) + F.col("doc_id")).alias("dfv")
        versions = d.select(part, F.lit(1).alias("ver"), dfv, F.substring("text", 1, 64).alias("title"), F.col("lang").alias("extension"))
        files = d.select(
            part, dfv, F.col("n_chars").alias("logical_size"), F.col("n_chars").alias("physical_size"), _plus("2024-01-01", F.col("doc_id") * 60).alias("last_write"), (F.pmod("doc_id", F.lit(10)) != 0).alias("committed")
        )
        contents = d.filter(F.pmod("doc_id", F.lit(37)) != 0).select(part, dfv, F.encode("text", "UTF-8").alias("data"))
        return Vault(versions, files, contents)

    @cached_property
    def outcomes(self) -> DataFrame:
        status = F.when(F.col("toxic") == 1, 3).when(F.col("quality") == 1, 2).otherwise(4)
        d = self.table("labels").join(self.table("documents"), "doc_id").withColumns({"s": status, "dfv": F.lit(5_000_000) + F.col("doc_id")})
        return d.select(
            idempotency_key("doc_id", F.lit(1), "dfv").alias("idempotency_key"), F.col("doc_id").alias("part"), F.lit(1).cast("bigint").alias("ver"), "dfv", F.col("s").alias("status"),
            F.when(F.col("s") == 2, F.col("n_chars")).otherwise(F.lit(0)).cast("bigint").alias("bytes_written"), F.lit(None).cast("string").alias("output_path"), F.lit(None).cast("string").alias("checksum"),
            F.when(F.col("s") == 3, "toxic").alias("failure_reason"), _plus("2024-01-01", F.col("doc_id")).alias("observed"), (F.pmod("doc_id", F.lit(3)) + 1).cast("int").alias("attempt"),
        )

    @cached_property
    def jobs(self) -> DataFrame:
        c = self.table("customer")
        status = F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Running").when(F.col("c_mktsegment") == "BUILDING", "Completed").when(F.col("c_mktsegment") == "FURNITURE", "Failed").when(F.col("c_mktsegment") == "HOUSEHOLD", "Paused").otherwise("Cancelled")
        c = c.withColumns({"status": status, "started": _plus("2024-01-01", F.col("c_custkey"))})
        return c.select(
            F.col("c_custkey").alias("job_id"), F.col("c_name").alias("job_name"), F.lit("vault").alias("source_server"), F.lit("main").alias("source_database"), F.col("c_nationkey").cast("string").alias("partition_key"),
            F.when(F.pmod("c_custkey", F.lit(7)) != 0, F.lit(1_000_000) + F.col("c_custkey") * 100).alias("expected"), "started",
            F.when(F.col("status").isin("Completed", "Failed", "Cancelled"), F.col("started") + F.make_dt_interval(hours=F.lit(1))).alias("completed"), F.lit(None).cast("string").alias("cancellation_reason"), "status",
        )

    @cached_property
    def progress(self) -> DataFrame:
        """Snapshots with ties in time."""
        r = F.floor("o_totalprice").cast("bigint")
        o = self.table("orders").withColumns({"r": r, "s": F.expr("floor(o_totalprice) * 8 div 10"), "f": F.expr("floor(o_totalprice) div 10")})
        return o.select(
            F.col("o_orderkey").alias("progress_id"), F.col("o_custkey").alias("job_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("snapshot"), F.col("r").alias("recorded"), F.col("s").alias("succeeded"), F.col("f").alias("failed"),
            (F.col("r") - F.col("s") - F.col("f")).alias("skipped"), (F.col("r") * 1000).alias("bytes_written"), (F.col("r") / 1000).cast("decimal(18,4)").alias("docs_per_sec"), (F.col("r") / 2000).cast("decimal(18,4)").alias("mib_per_sec"),
            F.col("o_orderkey").alias("last_part"), F.lit(1).cast("bigint").alias("last_ver"), F.lit("Snapshot").alias("status"),
        )

    @cached_property
    def hourly(self) -> DataFrame:
        """Cumulative snapshots of ten jobs."""
        rate = F.col("value").cast("decimal(18,4)")
        return self.table("events").select(
            F.col("event_id").alias("progress_id"), F.pmod("user_id", F.lit(10)).alias("job_id"), F.col("ts").cast("timestamp_ntz").alias("snapshot"), F.col("event_id").alias("recorded"), F.col("event_id").alias("succeeded"),
            (F.col("event_id") * 1000).alias("bytes_written"), rate.alias("docs_per_sec"), rate.alias("mib_per_sec"),
        )

    @cached_property
    def workers(self) -> DataFrame:
        g = self.table("events").groupBy("user_id").agg(F.min("ts").cast("timestamp_ntz").alias("a"), F.max("ts").cast("timestamp_ntz").alias("b"))
        status = _pick(("Registered", "Active", "Idle", "Stalled", "Stopped", "Failed", "Archived"), F.pmod("user_id", F.lit(7)))
        return g.withColumn("status", status).select(
            F.col("user_id").alias("worker_id"), F.col("user_id").alias("job_id"), F.concat(F.lit("worker-"), F.col("user_id").cast("string")).alias("worker_name"), F.concat(F.lit("host-"), F.pmod("user_id", F.lit(8)).cast("string")).alias("machine_name"),
            F.lit(None).cast("int").alias("process_id"), F.pmod("user_id", F.lit(4)).cast("string").alias("assigned_partition"), (F.pmod("user_id", F.lit(16)) + 1).cast("int").alias("concurrency"),
            F.col("a").alias("started"), F.col("b").alias("heartbeat"), F.when(F.col("status") == "Stopped", F.col("b")).alias("stopped"), "status",
        )

    @cached_property
    def errors(self) -> DataFrame:
        e = F.col("event_id")
        d = self.table("events").filter("event_type = 'error'").withColumns({
            "status": _pick(("New", "Acknowledged", "Investigating", "Resolved", "Ignored"), F.pmod(e, F.lit(5))), "dfv": e + 5_000_000, "t": F.col("ts").cast("timestamp_ntz")})
        ended = F.col("status").isin("Resolved", "Ignored")
        return d.select(
            e.alias("error_id"), F.col("user_id").alias("job_id"), F.col("user_id").alias("worker_id"), e.alias("part"), F.lit(1).cast("bigint").alias("ver"), "dfv", idempotency_key(e, F.lit(1), "dfv").alias("idempotency_key"),
            _pick(("Warning", "Error", "Critical"), F.pmod(e, F.lit(3))).alias("severity"), _pick(("Transient", "Deterministic", "Configuration", "Security", "Storage", "Unknown"), F.pmod(e, F.lit(6))).alias("category"),
            F.lit("reader").alias("source"), F.lit(None).cast("string").alias("exception_type"), F.col("props").alias("message"), F.lit(None).cast("string").alias("stack_trace"), (F.pmod(e, F.lit(3)) + 1).cast("int").alias("attempt"),
            F.col("t").alias("occurred"), F.when(ended, F.col("t") + F.make_dt_interval(hours=F.lit(1))).alias("resolved"), F.when(ended, "ops").alias("resolved_by"), F.lit(None).cast("string").alias("notes"), "status",
        )

    @cached_property
    def metrics(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("metric_id"), F.col("user_id").alias("job_id"), F.col("event_type").alias("metric_name"), "value", F.lit("ms").alias("unit"), F.col("props").alias("tags"), F.col("ts").cast("timestamp_ntz").alias("captured"), F.lit("Live").alias("status"))

    @cached_property
    def audit(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("audit_id"), F.col("user_id").alias("job_id"), F.col("event_type").alias("entity_type"), F.col("event_id").alias("entity_id"), F.lit("Updated").alias("action"), F.lit(None).cast("string").alias("previous_status"),
            F.lit(None).cast("string").alias("new_status"), F.col("props").alias("details"), F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("actor_name"), F.lit("User").alias("actor_type"), F.col("ts").cast("timestamp_ntz").alias("occurred"), F.lit("Recorded").alias("status"))

    @cached_property
    def checkpoints(self) -> DataFrame:
        g = self.table("lineitem").groupBy("l_suppkey").agg(F.max(F.struct(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"))).alias("c"), F.count(F.lit(1)).alias("processed"))
        return g.select(
            F.col("l_suppkey").alias("checkpoint_id"), F.col("l_suppkey").alias("job_id"), F.pmod("l_suppkey", F.lit(4)).cast("string").alias("partition_key"), F.col("c.o").alias("last_part"), F.col("c.n").cast("bigint").alias("last_ver"),
            "processed", _plus("2024-01-30", F.col("l_suppkey")).alias("checkpoint_at"), F.when(F.pmod("l_suppkey", F.lit(5)) == 0, "Superseded").otherwise("Active").alias("status"))

    @cached_property
    def work_items(self) -> DataFrame:
        g = self.table("lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.min("l_suppkey").alias("job_id"), F.max("l_quantity").alias("q"))
        i = F.col("l_orderkey") * 1_000_000_000 + F.col("l_partkey") * 10 + F.col("l_linenumber")
        g = g.withColumn("item_id", i).withColumn("status", _pick(("Available", "Claimed", "Completed", "Failed", "Available"), F.pmod("item_id", F.lit(5))))
        s, held = F.col("status"), F.col("status") == "Claimed"
        done, o = s == "Completed", F.col("l_orderkey")
        none = lambda kind: F.lit(None).cast(kind)
        return g.select(
            "item_id", "job_id", idempotency_key("l_orderkey", "l_linenumber", "l_partkey").alias("idempotency_key"), o.alias("part"), F.col("l_linenumber").cast("bigint").alias("ver"), F.col("l_partkey").alias("dfv"),
            F.floor("q").cast("int").alias("priority"), "status", F.when(held, F.pmod(o, F.lit(15))).alias("worker_id"), F.when(held, F.concat(F.lit("t"), F.pmod(o, F.lit(100)).cast("string"))).alias("token"),
            F.when(held, _ts("2024-01-30")).alias("claimed"), F.when(held, _plus("2024-01-30 12:00:00", F.pmod(o, F.lit(86_400)))).alias("expires"), F.pmod("item_id", F.lit(4)).cast("int").alias("attempts"), F.lit(3).alias("max_attempts"),
            none("string").alias("failure_reason"), none("timestamp_ntz").alias("failed_at"), _plus("2024-01-30", F.pmod(o, F.lit(172_800))).alias("next_eligible"),
            F.when(done, _ts("2024-01-30")).alias("completed"), F.when(done, "out").alias("output_path"), F.when(done, "c").alias("checksum"), F.when(done, F.col("l_partkey")).alias("bytes_written"),
        )

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in ("jobs", "workers", "progress", "metrics", "errors", "checkpoints", "audit", "work_items")}

    @cached_property
    def latest(self) -> DataFrame:
        return latest_by(self.progress, ["job_id"], "snapshot", "progress_id")


_KEY = "sha256(unhex(lpad(hex({}), 16, '0') || lpad(hex({}), 16, '0') || lpad(hex({}), 16, '0')))"

#: The same relations for DuckDB, by name; each may use those before it.
SQL: dict[str, str] = {
    "versions": "SELECT doc_id AS part, CAST(1 AS INTEGER) AS ver, 5000000 + doc_id AS dfv, substring(text, 1, 64) AS title, lang AS extension FROM documents",
    "files": "SELECT doc_id AS part, 5000000 + doc_id AS dfv, n_chars AS logical_size, n_chars AS physical_size, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS last_write, doc_id % 10 <> 0 AS committed FROM documents",
    "contents": "SELECT doc_id AS part, 5000000 + doc_id AS dfv, text AS data FROM documents WHERE doc_id % 37 <> 0",
    "descr": f"""SELECT v.part, CAST(v.ver AS BIGINT) AS ver, v.dfv, coalesce(v.title, '') AS title, coalesce(v.extension, '') AS extension, f.logical_size, f.physical_size,
        coalesce(f.last_write, TIMESTAMP '1970-01-01') AS last_write, {_KEY.format('v.part', 'v.ver', 'v.dfv')} AS idempotency_key
        FROM versions v JOIN files f ON f.part = v.part AND f.dfv = v.dfv WHERE f.committed""",
    "outcomes": f"""SELECT {_KEY.format('d.doc_id', '1', '5000000 + d.doc_id')} AS idempotency_key, d.doc_id AS part, CAST(1 AS BIGINT) AS ver, 5000000 + d.doc_id AS dfv,
        CAST(CASE WHEN toxic = 1 THEN 3 WHEN quality = 1 THEN 2 ELSE 4 END AS INTEGER) AS status, CAST(CASE WHEN toxic <> 1 AND quality = 1 THEN n_chars ELSE 0 END AS BIGINT) AS bytes_written,
        CASE WHEN toxic = 1 THEN 'toxic' END AS failure_reason, TIMESTAMP '2024-01-01' + to_seconds(d.doc_id) AS observed, CAST(d.doc_id % 3 + 1 AS INTEGER) AS attempt
        FROM labels l JOIN documents d ON d.doc_id = l.doc_id""",
    "jobs0": """SELECT c_custkey AS job_id, c_name AS job_name, 'vault' AS source_server, 'main' AS source_database, CAST(c_nationkey AS VARCHAR) AS partition_key,
        CASE WHEN c_custkey % 7 <> 0 THEN 1000000 + c_custkey * 100 END AS expected, TIMESTAMP '2024-01-01' + to_seconds(c_custkey) AS started,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Running' WHEN 'BUILDING' THEN 'Completed' WHEN 'FURNITURE' THEN 'Failed' WHEN 'HOUSEHOLD' THEN 'Paused' ELSE 'Cancelled' END AS status FROM customer""",
    "jobs": "SELECT *, CASE WHEN status IN ('Completed', 'Failed', 'Cancelled') THEN started + INTERVAL 1 HOUR END AS completed FROM jobs0",
    "progress": """SELECT o_orderkey AS progress_id, o_custkey AS job_id, CAST(o_orderdate AS TIMESTAMP) AS snapshot, r AS recorded, r * 8 // 10 AS succeeded, r // 10 AS failed, r - r * 8 // 10 - r // 10 AS skipped, r * 1000 AS bytes_written,
        CAST(r / 1000 AS DECIMAL(18,4)) AS docs_per_sec, CAST(r / 2000 AS DECIMAL(18,4)) AS mib_per_sec, o_orderkey AS last_part, CAST(1 AS BIGINT) AS last_ver
        FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS r FROM orders)""",
    "latest": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY snapshot DESC, progress_id DESC) AS rn FROM progress) WHERE rn = 1",
    "hourly": """SELECT event_id AS progress_id, user_id % 10 AS job_id, CAST(ts AS TIMESTAMP) AS snapshot, event_id AS recorded, event_id AS succeeded, event_id * 1000 AS bytes_written,
        CAST(value AS DECIMAL(18,4)) AS docs_per_sec, CAST(value AS DECIMAL(18,4)) AS mib_per_sec FROM events""",
    "workers": """SELECT user_id AS worker_id, user_id AS job_id, 'worker-' || CAST(user_id AS VARCHAR) AS worker_name, 'host-' || CAST(user_id % 8 AS VARCHAR) AS machine_name, CAST(user_id % 4 AS VARCHAR) AS assigned_partition,
        CAST(user_id % 16 + 1 AS INTEGER) AS concurrency, CAST(min(ts) AS TIMESTAMP) AS started, CAST(max(ts) AS TIMESTAMP) AS heartbeat, CASE WHEN user_id % 7 = 4 THEN CAST(max(ts) AS TIMESTAMP) END AS stopped,
        CASE user_id % 7 WHEN 0 THEN 'Registered' WHEN 1 THEN 'Active' WHEN 2 THEN 'Idle' WHEN 3 THEN 'Stalled' WHEN 4 THEN 'Stopped' WHEN 5 THEN 'Failed' ELSE 'Archived' END AS status FROM events GROUP BY user_id""",
    "errors": f"""SELECT event_id AS error_id, user_id AS job_id, user_id AS worker_id, event_id AS part, CAST(1 AS BIGINT) AS ver, event_id + 5000000 AS dfv, {_KEY.format('event_id', '1', 'event_id + 5000000')} AS idempotency_key,
        CASE event_id % 3 WHEN 0 THEN 'Warning' WHEN 1 THEN 'Error' ELSE 'Critical' END AS severity,
        CASE event_id % 6 WHEN 0 THEN 'Transient' WHEN 1 THEN 'Deterministic' WHEN 2 THEN 'Configuration' WHEN 3 THEN 'Security' WHEN 4 THEN 'Storage' ELSE 'Unknown' END AS category,
        CASE event_id % 5 WHEN 0 THEN 'New' WHEN 1 THEN 'Acknowledged' WHEN 2 THEN 'Investigating' WHEN 3 THEN 'Resolved' ELSE 'Ignored' END AS status, props AS message, CAST(event_id % 3 + 1 AS INTEGER) AS attempt,
        CAST(ts AS TIMESTAMP) AS occurred, CASE WHEN event_id % 5 >= 3 THEN CAST(ts AS TIMESTAMP) + INTERVAL 1 HOUR END AS resolved, CASE WHEN event_id % 5 >= 3 THEN 'ops' END AS resolved_by FROM events WHERE event_type = 'error'""",
    "metrics": "SELECT event_id AS metric_id, user_id AS job_id, event_type AS metric_name, value, props AS tags, CAST(ts AS TIMESTAMP) AS captured, 'Live' AS status FROM events",
    "audit": "SELECT event_id AS audit_id, user_id AS job_id, event_type AS entity_type, event_id AS entity_id, 'Updated' AS action, props AS details, 'user-' || CAST(user_id AS VARCHAR) AS actor_name, 'User' AS actor_type, CAST(ts AS TIMESTAMP) AS occurred FROM events",
    "checkpoints": """SELECT l_suppkey AS checkpoint_id, l_suppkey AS job_id, CAST(l_suppkey % 4 AS VARCHAR) AS partition_key, max(l_orderkey) AS last_part, CAST(arg_max(l_linenumber, l_orderkey * 100 + l_linenumber) AS BIGINT) AS last_ver,
        count(*) AS processed, TIMESTAMP '2024-01-30' + to_seconds(l_suppkey) AS checkpoint_at, CASE WHEN l_suppkey % 5 = 0 THEN 'Superseded' ELSE 'Active' END AS status FROM lineitem GROUP BY l_suppkey""",
    "items0": """SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_orderkey * 1000000000 + l_partkey * 10 + l_linenumber AS item_id, min(l_suppkey) AS job_id, CAST(floor(max(l_quantity)) AS INTEGER) AS priority
        FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey""",
    "work_items": f"""SELECT item_id, job_id, {_KEY.format('o', 'n', 'p')} AS idempotency_key, o AS part, CAST(n AS BIGINT) AS ver, p AS dfv, priority,
        CASE item_id % 5 WHEN 0 THEN 'Available' WHEN 1 THEN 'Claimed' WHEN 2 THEN 'Completed' WHEN 3 THEN 'Failed' ELSE 'Available' END AS status, CASE WHEN item_id % 5 = 1 THEN o % 15 END AS worker_id,
        CASE WHEN item_id % 5 = 1 THEN 't' || CAST(o % 100 AS VARCHAR) END AS token, CASE WHEN item_id % 5 = 1 THEN TIMESTAMP '2024-01-30 12:00:00' + to_seconds(o % 86400) END AS expires,
        CAST(item_id % 4 AS INTEGER) AS attempts, CAST(3 AS INTEGER) AS max_attempts, TIMESTAMP '2024-01-30' + to_seconds(o % 172800) AS next_eligible FROM items0""",
}

_USES = {
    "descr": ("versions", "files"), "jobs": ("jobs0",), "latest": ("progress",), "work_items": ("items0",),
}


def with_relations(names: str, body: str) -> str:
    """body, after those relations that it names (separated by blanks) and what they use."""
    wanted: set[str] = set()
    for n in names.split():
        wanted |= {n, *_USES.get(n, ())}
    ctes = ",\n".join(f"{n} AS ({q})" for n, q in SQL.items() if n in wanted)
    return f"WITH {ctes}\n{body}" if ctes else body
