import csv
import datetime as dt
import glob
import hashlib
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from vaultflow import schemas
from vaultflow.operators import scan, state
from vaultflow.plans import catalogue, operations  # noqa: F401  operations adds to the catalogue
from vaultflow.sources import sinks, wal
from vaultflow.sources.tables import Conflict, SnapshotTable, retry_on_conflict
from vaultflow.sources.vault import parquet_vault, seeded_vault
from vaultflow.streaming import export


def read(pattern):
    return "".join(open(p, encoding="utf-8", newline="").read() for p in sorted(glob.glob(pattern)))


def test_documents_are_written_whole(spark, tmp_path):
    vault = seeded_vault(spark, 60, max_bytes=70_000)
    vault = scan.Vault(vault.versions, vault.files, vault.contents.filter("part % 10 <> 3"))
    rows = scan.attach_content(scan.scan_documents(vault), vault)
    got = sinks.write_documents(rows, f"{tmp_path}/out").collect()
    assert {r["status"] for r in got} == {schemas.SUCCEEDED, schemas.SKIPPED} and sum(r["status"] == schemas.SKIPPED for r in got) == 6
    for r in got:
        if r["status"] == schemas.SUCCEEDED:
            data = open(r["output_path"], "rb").read()
            assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes_written"], r["checksum"])
            assert r["output_path"].startswith(f"{tmp_path}/out/{r['idempotency_key'][:2]}/{r['idempotency_key'][2:4]}/{r['idempotency_key']}__doc_")
    assert not glob.glob(f"{tmp_path}/out/**/.*partial", recursive=True)
    short = sinks.write_documents(rows.withColumn("logical_size", F.col("logical_size") + 1), f"{tmp_path}/out2").filter("status = 3").first()
    assert "bytes" in short["failure_reason"]
    sink = sinks.write_documents(rows.limit(1), "/proc/nowhere").first()
    assert sink["status"] in (schemas.FAILED, schemas.SKIPPED)


@pytest.fixture(scope="module")
def records(spark):
    o = dt.datetime(2024, 1, 2, 3, 4, 5, 678_000)
    docs = spark.createDataFrame([("k1", 1, 1, 9, 'a, "b"', "txt", 3, 3, o), ("k2", 2, 1, 9, "line\nbreak", "pdf", 4, 4, o)], "idempotency_key string, part long, ver long, dfv long, title string, extension string, logical_size long, physical_size long, last_write timestamp_ntz")
    out = spark.createDataFrame([("k1", 1, 1, 9, 2, 3, "p/1", "c1", None, o, 2), ("k2", 2, 1, 9, 3, 0, None, None, "x", o, 1)], schemas.RELATIONS["outcomes"])
    return sinks.metadata_records(docs, out, 7)


def test_csv(records, tmp_path):
    sinks.write_csv(records.coalesce(1), f"{tmp_path}/m", bom=True)
    text = read(f"{tmp_path}/m/part-*")
    assert text.startswith("﻿DocumentPartId,") and text.count("\r\n") == 3
    rows = list(csv.DictReader(io.StringIO(text.lstrip("﻿"), newline="")))
    one = next(r for r in rows if r["DocumentPartId"] == "1")
    assert (one["Title"], one["LastWriteTime"], one["ExportStatus"], one["RetryCount"], one["IdempotencyKey"]) == ('a, "b"', "2024-01-02T03:04:05.678Z", "Succeeded", "1", "k1")
    assert next(r for r in rows if r["DocumentPartId"] == "2")["Title"] == "line\nbreak"
    sinks.write_csv(records.coalesce(1), f"{tmp_path}/n", ";", header=False, extensions=False)
    assert len(next(csv.reader(io.StringIO(read(f"{tmp_path}/n/part-*"), newline=""), delimiter=";"))) == 13


def test_json(records, tmp_path):
    sinks.write_json(records.coalesce(1), f"{tmp_path}/m")
    doc = json.loads(read(f"{tmp_path}/m/part-*"))
    assert doc["schemaVersion"] == "1.0" and len(doc["records"]) == 2
    two = next(r for r in doc["records"] if r["documentPartId"] == 2)
    assert two["exportPath"] is None and two["workerId"] == 7 and list(two)[:4] == ["documentPartId", "versionPart", "title", "extension"]
    sinks.write_json(records.limit(0).coalesce(1), f"{tmp_path}/none")
    assert json.loads(read(f"{tmp_path}/none/part-*") or '{"records": []}')["records"] == []
    assert sinks.write_metadata(records, f"{tmp_path}/all") == [("metadata.csv", "csv", 2), ("metadata.json", "json", 2)]


def test_manifests(spark, tmp_path):
    o = spark.createDataFrame([(f"{i}", i, 1, 1, 2, 5, "p", None, None, dt.datetime(2024, 1, 1), 1) for i in range(25)], schemas.RELATIONS["outcomes"])
    sinks.write_manifest_lines(o.coalesce(1), f"{tmp_path}/lines", rotate=10)
    files = sorted(glob.glob(f"{tmp_path}/lines/*.json"))
    rows = [json.loads(x) for p in files for x in open(p)]
    assert [sum(1 for _ in open(p)) for p in files] == [10, 10, 5] and "Checksum" not in rows[0] and rows[0]["Status"] == "Succeeded"
    jobs = spark.createDataFrame([(1, "n", "s", "d", "p", 5, dt.datetime(2024, 1, 1), None, None, "Running")], schemas.RELATIONS["jobs"])
    doc = json.loads(sinks.manifest_document(jobs, state.counters(o), spark.createDataFrame([("m.csv", "csv", 25)], "relative_path string, format string, record_count long"), "now").first()["value"])
    assert doc["totals"]["documentsExpected"] == 25 and doc["job"]["completedAtUtc"] is None and doc["artifacts"] == [{"relativePath": "m.csv", "format": "csv", "recordCount": 25}]


def test_console_and_exposition(spark):
    df = spark.createDataFrame([("a", None), ("b" * 80, 2)], "x string, y int")
    lines = sinks.console_table(df).split("\n")
    assert lines[2].split() == ["a", "-"] and "b" * 57 + "…" in lines[3]
    m = spark.createDataFrame([("docs.done", "counter", {"op": 'a"b'}, 3.0), ("depth", "gauge", {}, 1.5)], "name string, kind string, labels map<string,string>, value double")
    assert [r["value"] for r in sinks.exposition(m).collect()] == ["# TYPE vaultflow_depth gauge", "vaultflow_depth 1.5", "# TYPE vaultflow_docs_done counter", 'vaultflow_docs_done{op="a\\"b"} 3.0']


def test_wal(spark, tmp_path):
    root = f"{tmp_path}/wal"
    wal.write_wal(root, "p/1", 5, 6, 7, "2024-01-01T00:00:00.000Z")
    wal.write_wal(root, "two", -1, 2, 3, "2024-01-01T00:00:01.500Z")
    for name, text in (("bad", "1|2|3|2024-01-01T00:00:00.000Z|00000000"), ("short", "1|2|3"), ("blank", " \n\n"), ("word", "x|2|3|2024-01-01T00:00:00.000Z|1")):
        with open(f"{root}/{name}.wal", "w") as f:
            f.write(text)
    got = {r["file"]: (r["last_part"], r["last_ver"], r["processed"], r["at"]) for r in wal.read_wal(spark, root).collect()}
    assert got == {"p_1.wal": (5, 6, 7, dt.datetime(2024, 1, 1)), "two.wal": (-1, 2, 3, dt.datetime(2024, 1, 1, 0, 0, 1, 500_000))}
    wal.write_wal(root, "two", 9, 9, 9, "2024-01-01T00:00:02.000Z")
    assert wal.read_wal(spark, f"{root}/two.wal").first()["last_part"] == 9


def test_snapshots(spark, tmp_path):
    t = SnapshotTable(spark, f"{tmp_path}/t", schemas.RELATIONS["cursors"])
    assert t.version() == 0 and t.read().count() == 0
    row = spark.createDataFrame([("p", 1, 1, dt.datetime(2024, 1, 1))], schemas.RELATIONS["cursors"])
    assert t.commit(row) == 1 and t.commit(t.read().unionByName(row), expected=1) == 2 and t.read().count() == 2 and t.read(1).count() == 1
    with pytest.raises(RuntimeError):
        t.commit(row, expected=1)
    t.commit(row)
    t.prune(1)
    assert not glob.glob(f"{tmp_path}/t/v=00000001*") and t.read().count() == 1


def test_snapshots_of_writers_that_die_or_meet(spark, tmp_path):
    path, schema = f"{tmp_path}/t", schemas.RELATIONS["cursors"]
    t = SnapshotTable(spark, path, schema)
    row = spark.createDataFrame([("p", 1, 1, dt.datetime(2024, 1, 1))], schema)
    t.commit(row)
    row.write.parquet(f"{path}/v=00000002-dead")  # died before the pointer
    assert t.version() == 1 and t.read().count() == 1
    open(f"{path}/_at.00000002", "w").close()  # died, or is about, to say which folder
    assert t.version() == 1
    with pytest.raises(Conflict):
        t.commit(row)
    t.DEAD_AFTER = 0
    assert t.commit(t.read().unionByName(row)) == 3 and t.read().count() == 2
    waits, first = [], iter([True])

    def change(rows):
        if next(first, False):  # another writer comes in between
            other = SnapshotTable(spark, path, schema)
            other.DEAD_AFTER = 0
            other.commit(other.read().unionByName(row))
        return rows.unionByName(row)

    assert retry_on_conflict(t, change, sleep=waits.append) == 5 and waits == [0.25] and t.read().count() == 4
    with pytest.raises(Conflict):
        retry_on_conflict(t, lambda rows: (t.commit(rows), rows)[1], attempts=2, sleep=waits.append)


def test_parquet_vault(spark, tmp_path):
    v = seeded_vault(spark, 10)
    for n, df in zip(("document_file_version", "data_file_version", "data_file_version_bytes"), v):
        df.write.parquet(f"{tmp_path}/{n}")
    assert scan.scan_documents(parquet_vault(spark, str(tmp_path))).count() == 10


def test_stream_resumes_and_does_nothing_twice(spark, tmp_path):
    vault = seeded_vault(spark, 90)
    rows = scan.scan_documents(vault)
    source = f"{tmp_path}/source"
    rows.filter("part % 3 = 0").coalesce(1).write.mode("append").parquet(source)
    seen = spark.sparkContext.accumulator(0)

    def process(batch):
        seen.add(batch.count())
        return batch.select("idempotency_key", "part", "ver", "dfv", F.when(F.col("part") % 2 == 0, 2).otherwise(3).alias("status"), F.col("logical_size").alias("bytes_written"), F.lit(None).cast("string").alias("output_path"),
                            F.lit(None).cast("string").alias("checksum"), F.lit(None).cast("string").alias("failure_reason"), F.lit(1).alias("attempt"))

    def run():
        s = export.ExportStream(spark, f"{tmp_path}/state", process)
        q = s.start(export.descriptor_stream(spark, source, rows.schema), f"{tmp_path}/checkpoint")
        q.awaitTermination()
        return s

    s = run()
    assert s.recorded().count() == 30 and seen.value == 30
    rows.coalesce(1).write.mode("append").parquet(source)  # all, those known among them
    s = run()
    done = s.recorded()
    assert done.count() == 90 and seen.value == 30 + 60 + 15  # failed ones run again
    assert s.cursors.read().first()["last_part"] == 1_000_089


@pytest.mark.parametrize("step", ["process", "batch", "wal", "table"])
def test_stream_that_dies_between_any_two_steps(spark, tmp_path, monkeypatch, step):
    rows = scan.scan_documents(seeded_vault(spark, 20))
    rows.coalesce(1).write.parquet(f"{tmp_path}/source")
    calls = []

    def process(batch):
        calls.append(batch.count())
        return batch.select("idempotency_key", "part", "ver", "dfv", F.when(F.col("part") % 2 == 0, 2).otherwise(3).alias("status"), F.col("logical_size").alias("bytes_written"), *(F.lit(None).cast("string").alias(c) for c in ("output_path", "checksum", "failure_reason")), F.lit(1).alias("attempt"))

    def run():
        s = export.ExportStream(spark, f"{tmp_path}/state", process, merge_every=2)
        s.start(export.descriptor_stream(spark, f"{tmp_path}/source", rows.schema), f"{tmp_path}/checkpoint").awaitTermination()
        return s

    def die(*_):
        raise OSError("dies")

    with monkeypatch.context() as m:
        if step == "process":
            m.setattr(export, "drop_done", die)
        elif step == "batch":
            m.setattr(export.ExportStream, "_move", die)
        elif step == "wal":
            m.setattr(SnapshotTable, "commit", die)
        else:
            m.setattr(SnapshotTable, "prune", die)
        with pytest.raises(Exception, match="dies"):
            run()
    s = export.ExportStream(spark, f"{tmp_path}/state", process)
    said = [(r["source"], r["behind"]) for r in s.diverged().collect()]
    assert said == {"process": [], "batch": [], "wal": [("wal", "table")], "table": [("both", None)]}[step]
    if step == "wal":
        assert len(s.recover()) == 1 and s.cursors.read().first()["last_part"] == 1_000_019
        assert [(r["source"], r["behind"]) for r in s.diverged().collect()] == [("both", None)]
    s = run()
    assert s.recorded().count() == 20 and calls == [20] and s.cursors.read().first()["last_part"] == 1_000_019
    assert [r["source"] for r in s.diverged().collect()] == ["both"]
    s.merge()
    assert s.recorded().count() == 20 and s.merged.read().count() == 20 and not s._batches()


def test_progress_is_published(spark, tmp_path):
    rows = scan.scan_documents(seeded_vault(spark, 30))
    rows.repartition(3).write.parquet(f"{tmp_path}/source")
    said = []
    publisher = export.ProgressPublisher(said.append)
    spark.streams.addListener(publisher)
    try:
        export.descriptor_stream(spark, f"{tmp_path}/source", rows.schema).writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
        assert publisher.ended.wait(30)
    finally:
        spark.streams.removeListener(publisher)
    assert sum(x["rows"] for x in said) == 30 and not publisher.failed and {x["batch"] for x in said} >= {0, 1, 2}


def test_event_time_streams(spark, data):
    events = spark.readStream.schema(spark.read.parquet(f"{data}/events.parquet").schema).parquet(data + "/events.parqu*")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    for name, df, mode in (("r", export.rates(events, by=("event_type",)), "append"), ("d", export.deduplicated(events, "event_id"), "append"), ("h", export.heartbeat_sessions(events.withColumn("worker_id", F.col("user_id"))), "append")):
        q = df.writeStream.outputMode(mode).format("memory").queryName(f"out_{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(f"out_{name}").count() > 0
    n = spark.read.parquet(f"{data}/events.parquet").count()
    assert spark.table("out_d").count() == n


@pytest.mark.parametrize("name", ["st_dedupe_stream", "st_counters_stream", "st_heartbeat_sessions"])
def test_streams_leave_rows_with_executors(spark, data, name):
    """Their rows are files, of none of which the driver held the rows."""
    df = catalogue.QUERIES[name](spark, data)
    assert df.inputFiles() and df.count() > 0
