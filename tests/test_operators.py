import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultflow import schemas
from vaultflow.operators import batches, maintenance, quality, scan, state, tracking, validation, workqueue
from vaultflow.plans import metrics, reports, views
from vaultflow.plans.mapping import AS_OF, Relations
from vaultflow.sources.vault import seeded_vault


@pytest.fixture(scope="module")
def rel(spark, data):
    return Relations(spark, data)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_scan_is_pushed_down_and_pruned(rel):
    text = plan(rel.vault.versions.filter(scan.after((100, 1))).select("part"))
    assert "PushedFilters" in text and "GreaterThan(doc_id,100)" in text and "ReadSchema: struct<doc_id:bigint>" in text
    late = plan(scan.plan_export(rel.vault, rel.outcomes).select("part"))
    assert "encode(" not in late


def test_pages_join_to_the_whole(spark):
    vault = seeded_vault(spark, 230, uncommitted_every=10)
    every = [(r["part"], r["ver"]) for r in scan.scan_documents(vault).orderBy("part", "ver").collect()]
    got, cursor = [], schemas.ORIGIN
    while page := scan.scan_page(vault, cursor, 50).collect():
        got += [(r["part"], r["ver"]) for r in page]
        cursor = got[-1]
    assert got == every and len(every) == 207
    pages = {(r["part"], r["ver"]): r["page"] for r in scan.numbered_pages(scan.scan_documents(vault), 50).collect()}
    assert pages == {x: i // 50 for i, x in enumerate(every)}
    assert scan.count_remaining(vault, every[99]).first()["remaining"] == len(every) - 100
    assert [(r["part"], r["ver"]) for r in scan.stream_documents(vault, every[-3])] == every[-2:]


def test_descriptor_nulls_and_negative_sizes(spark):
    v = spark.createDataFrame([(1, 1, 5, None, None)], schemas.RELATIONS["document_file_version"])
    f = lambda n: spark.createDataFrame([(1, 5, n, n, None, True)], schemas.RELATIONS["data_file_version"])
    r = scan.scan_documents(scan.Vault(v, f(3), None)).first()
    assert (r["title"], r["extension"], r["last_write"]) == ("", "", dt.datetime(1970, 1, 1))
    with pytest.raises(Exception, match="negative"):
        scan.scan_documents(scan.Vault(v, f(-3), None)).collect()


def test_oversize_is_dropped_without_an_outcome(spark):
    vault = seeded_vault(spark, 40, max_bytes=3 * 2**20)
    rows, gone = scan.drop_oversize(scan.scan_documents(vault), 1)
    assert rows.count() + gone.count() == 40 and gone.filter("logical_size <= 1048576").count() == 0
    assert scan.drop_oversize(rows, 0)[0].count() == rows.count()


def outcomes(spark, rows):
    return spark.createDataFrame([(f"{p:064d}", p, v, 0, s, b, None, None, None, dt.datetime(2024, 1, 1), 1) for p, v, s, b in rows], schemas.RELATIONS["outcomes"])


def test_state(spark):
    old = outcomes(spark, [(1, 1, 3, 0)])
    twice = outcomes(spark, [(1, 9, 2, 100)]).withColumn("seq", F.lit(2)).unionByName(outcomes(spark, [(1, 8, 3, 7)]).withColumn("seq", F.lit(1)))
    new = state.upsert_outcomes(old, twice)
    r = new.collect()
    assert len(r) == 1 and (r[0]["status"], r[0]["bytes_written"], r[0]["ver"]) == (2, 100, 1)
    c = state.counters(new).first()
    assert (c["total_recorded"], c["total_succeeded"], c["total_bytes_written"]) == (1, 1, 100)
    assert state.counters(new.limit(0)).first()["total_recorded"] == 0
    t = lambda n: dt.datetime(2024, 1, n)
    cur = lambda *rows: spark.createDataFrame(list(rows), schemas.RELATIONS["cursors"])
    now = cur(("p", 5, 5, t(1)))
    for row in (("p", 3, 100, t(2)), ("p", 5, 6, t(3)), ("p", 1, 1, t(4))):
        now = state.advance_cursors(now, cur(row))
    assert tuple(now.first()) == ("p", 5, 6, t(4))
    o = state.read_cursor(now, "other").first()
    assert (o["last_part"], o["last_ver"]) == schemas.ORIGIN


def test_gap_free_cursor_skips_nothing(spark):
    docs = spark.createDataFrame([(f"{p:064d}", p, 1, 0) for p in range(1, 8)], "idempotency_key string, part long, ver long, dfv long")
    for done, want in (([(1, 1, 2, 0), (2, 1, 4, 0), (4, 1, 2, 0)], 2), ([], schemas.ORIGIN[0]), ([(p, 1, 2, 0) for p in range(1, 8)], 7), ([(1, 1, 3, 0), (2, 1, 2, 0)], schemas.ORIGIN[0])):
        assert state.gap_free_cursor(docs, outcomes(spark, done)).first()["last_part"] == want


def test_recovery(spark):
    w = spark.createDataFrame([("a", 5, 5), ("b", 1, 1), ("c", 3, 3)], "partition_key string, last_part long, last_ver long")
    t = spark.createDataFrame([("a", 5, 4), ("b", 1, 2), ("c", 3, 3), ("d", 9, 9)], w.schema)
    got = {r["partition_key"]: tuple(r)[1:] for r in state.recover(w, t).collect()}
    assert got == {"a": (5, 5, "wal", "table"), "b": (1, 2, "table", "wal"), "c": (3, 3, "both", None), "d": (9, 9, "table", "wal")}


def test_latest_both_ways(rel):
    a = {tuple(r) for r in rel.latest.select("job_id", "progress_id").collect()}
    b = {tuple(r) for r in state.latest_by_window(rel.progress, ["job_id"], "snapshot", "progress_id").select("job_id", "progress_id").collect()}
    assert a == b


def test_jobs(spark, rel):
    jobs = schemas.empty(spark, "jobs")
    c = tracking.start_job(jobs, AS_OF, "n", "s", "d", expected=5)
    assert c.out.first()["job_id"] == 1 and c.audit.first()["details"] == '{"JobName":"n","PartitionKey":"default","SourceServer":"s","SourceDatabase":"d"}'
    with pytest.raises(tracking.NotAllowed):
        tracking.start_job(c.table, AS_OF, "n", "s", "d")
    done = tracking.complete_job(c.table, AS_OF, 1, "Cancelled", "why")
    assert tuple(done.table.select("status", "cancellation_reason").first()) == ("Cancelled", "why") and done.audit.first()["previous_status"] == "Running"
    with pytest.raises(tracking.NotAllowed):
        tracking.complete_job(done.table, AS_OF, 1, "Completed")
    assert tracking.complete_job(done.table, AS_OF, 1, "Completed", strict=False).table.first()["status"] == "Completed"
    with pytest.raises(tracking.NotFound):
        tracking.complete_job(jobs, AS_OF, 7, "Failed")
    audit = tracking.append_audit(tracking.append_audit(schemas.empty(spark, "audit"), c.audit), done.audit)
    assert [r["audit_id"] for r in audit.orderBy("audit_id").collect()] == [1, 2]
    assert {(a, b) for a in schemas.DOMAINS["jobs", "status"] for b in schemas.DOMAINS["jobs", "status"] if spark.range(1).select(tracking.move_allowed(F.lit(a), F.lit(b)).alias("x")).first()["x"]} == set(schemas.JOB_MOVES)


def test_workers_and_errors(spark):
    w = tracking.register_worker(schemas.empty(spark, "workers"), AS_OF, 1, "w", "m", "p", 4).table
    again = tracking.register_worker(w, "2024-02-01 00:00:00", 1, "w", "m", "p", 9)
    assert again.table.count() == 1 and again.table.first()["concurrency"] == 9
    late = tracking.mark_stalled(w, "2024-01-31 00:02:01", 120)
    assert late.table.first()["status"] == "Stalled" and late.audit.first()["previous_status"] == "Active"
    assert tracking.mark_stalled(w, "2024-01-31 00:02:00", 120).out.count() == 0
    beats = spark.createDataFrame([(1, "Idle"), (77, "Idle")], "worker_id long, new_status string")
    assert tracking.heartbeats(w, beats, AS_OF).first()["status"] == "Idle"
    with pytest.raises(Exception, match="not a heartbeat"):
        tracking.heartbeats(w, beats.withColumn("new_status", F.lit("Odd")), AS_OF).collect()
    with pytest.raises(tracking.NotFound):
        tracking.stop_worker(w, AS_OF, 5)
    new = spark.createDataFrame([(1, "Error", "Storage", "sink", "m")], "job_id long, severity string, category string, source string, message string")
    e = tracking.log_errors(schemas.empty(spark, "errors"), new, AS_OF)
    assert e.table.first()["attempt"] == 1 and e.audit.first()["action"] == "ErrorRaised"
    r = tracking.resolve_error(e.table, AS_OF, 1, "Ignored", "known", "me").table.first()
    assert (r["status"], r["resolved_by"], r["notes"]) == ("Ignored", "me", "known")


def test_checkpoints_only_advance(spark):
    table = schemas.empty(spark, "checkpoints")
    for part, ver, advanced in ((5, 5, 1), (3, 100, 0), (5, 5, 0), (5, 6, 1)):
        new = spark.createDataFrame([(1, "p", part, ver, 0)], "job_id long, partition_key string, last_part long, last_ver long, processed long")
        c = tracking.save_checkpoints(table, new, AS_OF)
        assert c.out.first()["advanced"] == advanced
        table = spark.createDataFrame(c.table.collect(), table.schema)
    assert [tuple(r) for r in table.filter("status = 'Active'").select("last_part", "last_ver").collect()] == [(5, 6)] and table.count() == 2


def test_queue(spark):
    items = schemas.empty(spark, "work_items")
    new = spark.createDataFrame([(f"{i:064d}", i, 1, i, i % 3) for i in range(20)], "idempotency_key string, part long, ver long, dfv long, priority int")
    with pytest.raises(tracking.NotAllowed):
        workqueue.enqueue(items, new.unionByName(new), 1, AS_OF, strict=True)
    table = workqueue.enqueue(items, new.unionByName(new), 1, AS_OF, max_attempts=2).table
    table = spark.createDataFrame(table.collect(), items.schema)
    assert table.count() == 20 and workqueue.enqueue(table, new, 1, AS_OF).out.count() == 0
    seen = []
    for k in range(4):  # disjoint claims, by priority
        c = workqueue.claim(table, 1, k + 1, 6, f"t{k}", AS_OF)
        seen += [r["item_id"] for r in c.out.collect()]
        table = spark.createDataFrame(c.table.collect(), items.schema)
    assert len(seen) == len(set(seen)) == 20
    first = table.filter("token = 't0'").orderBy("item_id").first()
    i = first["item_id"]
    assert first["priority"] == 2
    assert workqueue.complete(table, i, "stale", "p", "c", 1, AS_OF).out.first()["completed"] == 0
    done = workqueue.complete(table, i, "t0", "p", "c", 1, AS_OF)
    assert done.out.first()["completed"] == 1 and quality.violations("c_completed_shape", {"work_items": done.table}).count() == 0
    r = workqueue.renew(table, i, "t0", 60, AS_OF).out.first()
    assert (r["extended"], r["expires"]) == (1, dt.datetime(2024, 1, 31, 0, 1))
    assert workqueue.renew(table, i, "no", 60, AS_OF).out.first()["expires"] is None
    status = lambda df: df.filter(F.col("item_id") == i).first()["status"]
    assert status(workqueue.fail(table, i, "t0", "x", AS_OF).table) == "Available" and status(workqueue.fail(table, i, "t0", "x", AS_OF, permanent=True).table) == "Failed"
    last = table.withColumn("attempts", F.lit(2))
    assert status(workqueue.fail(last, i, "t0", "x", AS_OF).table) == "DeadLettered"
    back = workqueue.reclaim(last, "2024-01-31 01:00:00")
    assert back.out.count() == 20 and workqueue.stuck(back.table).count() == 20
    assert workqueue.claim(back.table, 1, 1, 5, "t", "2024-02-01 00:00:00").out.count() == 0


def test_archive(rel):
    live, old = maintenance.archive(rel.tables, AS_OF, 29, 1000)
    assert old["jobs"].count() > 0
    for n, df in old.items():
        assert df.count() + live[n].count() == rel.tables[n].count()
    ids = {r["job_id"] for r in old["jobs"].collect()}
    assert not ids & {r["job_id"] for r in live["work_items"].select("job_id").distinct().collect()}
    assert maintenance.purge({"jobs": old["jobs"]}, "2030-01-01 00:00:00", 30)["jobs"].count() == 0


def test_unknown_predicates_pass(spark):
    jobs = spark.createDataFrame([(1, None, None, "Running"), (2, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1), "Odd")], "job_id long, started timestamp_ntz, completed timestamp_ntz, status string")
    assert [r["job_id"] for r in quality.violations("c_completed_after_start", {"jobs": jobs}).collect()] == [2]
    assert [r["job_id"] for r in quality.violations("c_domain_jobs_status", {"jobs": jobs}).collect()] == [2]


def test_job_without_anything(spark):
    e = lambda n: schemas.empty(spark, n)
    jobs = tracking.start_job(e("jobs"), AS_OF, "n", "s", "d").table
    s = views.job_summary(jobs, e("progress"), e("workers"), e("errors"), AS_OF)
    r = s.first()
    assert (r["total_workers"], r["active_workers"], r["open_errors"], r["recorded"]) == (0, None, None, None)
    one = reports.status_summary(s, reports.target_job(jobs)).first()
    assert (one["processed"], one["pct_complete"], one["eta_seconds"]) == (0, None, None)
    assert reports.target_job(jobs.withColumn("status", F.lit("Failed"))).count() == 0
    assert reports.target_job(jobs.withColumn("status", F.lit("Failed")), any_status=True).count() == 1


def test_failure_gate(spark):
    rows = [(b, 3 if i < f else 2, 10, 1.0) for b, f in ((1, 0), (2, 2), (3, 6), (4, 0)) for i in range(10)]
    r = batches.batch_results(spark.createDataFrame(rows, "batch_no long, status int, bytes_written long, seconds double"))
    assert tuple(batches.run_summary(r, 0.5).select("batches", "failed", "stopped_at", "stopped").first()) == (3, 8, 3, True)
    assert tuple(batches.run_summary(r, 0.6).select("batches", "stopped").first()) == (4, False)


def test_retries_never_raise_attempts(spark):
    f = spark.createDataFrame([("k", c, a) for c in ("SqlDeadlock", "DiskFull", "Permanent") for a in range(1, 10)], "key string, category string, attempt int")
    n = {c: batches.retry_schedule(f, batches.RetryProfile(attempts=5)).filter(f"retry AND category = '{c}'").count() for c in ("SqlDeadlock", "DiskFull", "Permanent")}
    assert n == {"SqlDeadlock": 4, "DiskFull": 1, "Permanent": 0}


def test_breaker(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", i, t0 + dt.timedelta(seconds=s), ok) for i, (s, ok) in enumerate([(0, True), (1, False), (2, False), (3, False), (5, True), (40, False), (50, True), (71, True), (72, True)])]
    rows += [("b", 100, t0, True)]
    calls = spark.createDataFrame(rows, "operation string, id long, ts timestamp_ntz, ok boolean")
    got = [(r["id"], r["allowed"], r["state"]) for r in batches.replay_breaker(calls, batches.BreakerSettings(4, 0.5, 30.0, 30.0)).orderBy("operation", "ts").collect()]
    assert got == [(0, True, "Closed"), (1, True, "Closed"), (2, True, "Closed"), (3, True, "Open"), (4, False, "Open"), (5, True, "Open"), (6, False, "Open"), (7, True, "Closed"), (8, True, "Closed"), (100, True, "Closed")]


def test_validation(spark):
    import hashlib

    good = hashlib.sha256(b"abc").hexdigest()
    rows = [(k, path, size, h, "txt", None, None, None) for k, path, size, h in (
        ("ok", "/r/a.txt", 3, good.upper()), ("size", "/r/b.txt", 4, good), ("sum", "/r/c.txt", 3, "00"), ("gone", "/r/x.txt", 3, good), ("blank", "", 3, good), ("out", "/q/d.txt", 3, good), ("ext", "/r/e.pdf", 3, good))]
    o = spark.createDataFrame(rows, "key string, path string, expected_size long, expected_checksum string, expected_extension string, meta_path string, meta_size long, meta_checksum string")
    f = spark.createDataFrame([(f"file:{p}", 3, b"abc") for p in ("/r/a.txt", "/r/b.txt", "/r/c.txt", "/q/d.txt", "/r/e.pdf")], "path string, length long, content binary")
    got = {r["key"]: (r["status"], r["failed_check"], r["retryable"]) for r in validation.validate(o, f, "/r").collect()}
    assert got == {"ok": ("Passed", None, False), "size": ("Failed", "size", False), "sum": ("Failed", "checksum", False), "gone": ("Failed", "exists", True), "blank": ("Failed", "exists", False), "out": ("Failed", "folder", False), "ext": ("Failed", "extension", False)}
    assert {r["key"] for r in validation.validate(o, f, "/r", extension_may_differ=True).filter("status = 'Passed'").collect()} == {"ok", "ext"}


def test_alert_islands(spark):
    t0 = dt.datetime(2024, 1, 1)
    series = spark.createDataFrame([(t0 + dt.timedelta(minutes=i), v) for i, v in enumerate([0.0, 0.2, 0.3, 0.0, 0.1, 0.1, 0.1, 0.1, 0.1])], "bucket timestamp_ntz, value double")
    got = [(r["samples"], r["fired"], r["peak"]) for r in metrics.alert("a_high_failure_rate", series).orderBy("started").collect()]
    assert got == [(2, False, 0.3), (5, True, 0.1)]
