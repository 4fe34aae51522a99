"""Exports as a stream: micro-batches of descriptors are matched against recorded outcomes, processed, and recorded.

A batch's outcomes are a folder of their own, whole or not there; now and then they are merged into a snapshot. Then the write-ahead record of the
cursor is replaced, then the table of cursors. A batch that runs again after a failure finds its outcomes and only moves the cursors,
and recover() brings the two stores of cursors together."""

from __future__ import annotations

import datetime
import json
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from vaultflow.functions import guards
from vaultflow.operators.scan import drop_done
from vaultflow.operators.state import advance_cursors, high_water, recover, upsert_outcomes
from vaultflow.schemas import RELATIONS
from vaultflow.sources.tables import SnapshotTable
from vaultflow.sources.wal import put_wal, read_wal


class ExportStream:
    """process takes descriptors and returns outcomes without their time; it must be safe to run twice."""

    def __init__(self, spark: SparkSession, state_dir: str, process: Callable[[DataFrame], DataFrame], partition_key: str = "default", merge_every: int = 32):
        guards.positive(merge_every=merge_every)
        guards.given(partition_key=partition_key)
        self.spark, self.process, self.partition_key, self.merge_every = spark, process, partition_key, merge_every
        self.state_dir = state_dir.rstrip("/")
        self.merged = SnapshotTable(spark, f"{self.state_dir}/outcomes", RELATIONS["outcomes"])
        self.cursors = SnapshotTable(spark, f"{self.state_dir}/cursors", RELATIONS["cursors"])
        self._path, self._fs = self.merged._path, self.merged._fs
        self._schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in RELATIONS['outcomes'].fields)}, seq bigint"

    def _folder(self, run: str, batch_id: int) -> str:
        return f"{self.state_dir}/batches/{run}-{batch_id:012d}"

    def _run_of(self, checkpoint: str) -> str:
        """The id that a stream keeps in its checkpoint: another checkpoint numbers its batches anew."""
        stream = self._fs.open(self._path(f"{checkpoint}/metadata"))
        try:
            return json.loads(stream.readLine())["id"]
        finally:
            stream.close()

    def _batches(self) -> list[str]:
        """Folders of batches that are whole."""
        found = self._fs.globStatus(self._path(f"{self.state_dir}/batches/*/_SUCCESS")) or []
        return sorted(s.getPath().getParent().toString() for s in found)

    def _added(self) -> DataFrame | None:
        folders = self._batches()
        return self.spark.read.schema(self._schema).parquet(*folders) if folders else None

    def recorded(self) -> DataFrame:
        """The last outcome of each key, of the snapshot and the batches after it."""
        added = self._added()
        return self.merged.read() if added is None else upsert_outcomes(self.merged.read(), added)

    def _known(self) -> DataFrame:
        """Key and last status alone; a batch reads no more of what is recorded."""
        added, cols = self._added(), ["idempotency_key", "status"]
        base = self.merged.read().select(*cols, F.lit(-1).cast("bigint").alias("seq"))
        every = base if added is None else base.unionByName(added.select(*cols, "seq"))
        return every.groupBy("idempotency_key").agg(F.max_by("status", "seq").alias("status"))

    def merge(self) -> None:
        """Batches into the snapshot; a crash in between repeats rows, which count once."""
        folders = self._batches()
        if folders:
            self.merged.commit(upsert_outcomes(self.merged.read(), self.spark.read.schema(self._schema).parquet(*folders)))
            for x in folders:
                self._fs.delete(self._path(x), True)
            self.merged.prune()

    def on_batch(self, batch: DataFrame, batch_id: int, run: str = "batch") -> None:
        folder = self._folder(run, batch_id)
        batch = batch.persist()  # descriptors alone; they are asked for several times
        try:
            if not self._fs.exists(self._path(f"{folder}/_SUCCESS")):
                todo = drop_done(batch.dropDuplicates(["idempotency_key"]), self._known())
                made = self.process(todo).withColumns({"observed": F.current_timestamp().cast("timestamp_ntz"), "seq": F.lit(time.time_ns() // 1000)})
                made.select(*(f.name for f in RELATIONS["outcomes"].fields), "seq").write.mode("overwrite").parquet(folder)
            made = self.spark.read.schema(self._schema).parquet(folder)
            # The cursor follows the batch's documents, not just those it had to process: a run that begins anew moves it all the same.
            at = high_water(batch.select("part", "ver").union(made.select("part", "ver"))).filter("last_part IS NOT NULL").first()
        finally:
            batch.unpersist()
        if at is not None:
            self._move(at["last_part"], at["last_ver"], made.count())
        if len(self._batches()) >= self.merge_every:
            self.merge()

    def _move(self, part: int, ver: int, docs: int) -> None:
        """Both stores of the cursor, the write-ahead record first; neither moves back."""
        now = datetime.datetime.now(datetime.UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")
        wal = self._wal().filter(F.col("partition_key") == self.partition_key).first()
        if wal is None or (wal["last_part"], wal["last_ver"]) < (part, ver):
            put_wal(self.spark, f"{self.state_dir}/wal", self.partition_key, part, ver, docs, now)
        at = self.spark.range(1).select(F.lit(self.partition_key).alias("partition_key"), F.lit(part).cast("bigint").alias("last_part"), F.lit(ver).cast("bigint").alias("last_ver"), F.current_timestamp().cast("timestamp_ntz").alias("updated"))
        self.cursors.commit(advance_cursors(self.cursors.read(), at))
        self.cursors.prune()

    def _wal(self) -> DataFrame:
        """partition_key (as in file names), last_part, last_ver of the write-ahead records."""
        if not self._fs.globStatus(self._path(f"{self.state_dir}/wal/*.wal")):
            return self.spark.createDataFrame([], "partition_key string, last_part bigint, last_ver bigint")
        return read_wal(self.spark, f"{self.state_dir}/wal/*.wal").select(F.regexp_replace("file", r"\.wal$", "").alias("partition_key"), "last_part", "last_ver")

    def diverged(self) -> DataFrame:
        """partition_key, last_part, last_ver, source, behind: of the write-ahead records and the table the greater cursor, and the store that is behind."""
        return recover(self._wal(), self.cursors.read())

    def recover(self) -> list:
        """Fills up the store that is behind; the rows of diverged() that had one."""
        rows = self.diverged().filter("behind IS NOT NULL").collect()  # one for each partition of an export
        for r in rows:
            if r["behind"] == "wal":
                put_wal(self.spark, f"{self.state_dir}/wal", r["partition_key"], r["last_part"], r["last_ver"], 0, datetime.datetime.now(datetime.UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z"))
        behind = [(r["partition_key"], r["last_part"], r["last_ver"]) for r in rows if r["behind"] == "table"]
        if behind:
            new = self.spark.createDataFrame(behind, "partition_key string, last_part bigint, last_ver bigint").withColumn("updated", F.current_timestamp().cast("timestamp_ntz"))
            self.cursors.commit(advance_cursors(self.cursors.read(), new))
        return rows

    def start(self, source: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """source: a streaming frame of descriptors. every: a processing time such as '2 seconds'; None: all there is, then the end."""
        w = source.writeStream.foreachBatch(lambda batch, n: self.on_batch(batch, n, self._run_of(checkpoint))).option("checkpointLocation", checkpoint)
        return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def descriptor_stream(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    """Descriptors from Parquet files as they arrive; max_files bounds a batch, as a channel's capacity would."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


class ProgressPublisher(StreamingQueryListener):
    """Publishes what each micro-batch of a query brought: publish gets dicts of query, batch, rows, rows_per_second and at. Register it with
    spark.streams.addListener; a publisher that raises does not stop the stream."""

    def __init__(self, publish: Callable[[dict], None]):
        self.publish, self.failed, self.ended = publish, 0, threading.Event()

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        try:
            self.publish({"query": str(p.id), "batch": p.batchId, "rows": p.numInputRows, "rows_per_second": float(p.processedRowsPerSecond or 0.0), "at": p.timestamp})
        except Exception:  # publishing is not worth a failed export
            self.failed += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def rates(events: DataFrame, ts: str = "ts", window: str = "5 minutes", late: str = "10 minutes", by: tuple[str, ...] = ()) -> DataFrame:
    """Events a second of each window, emitted when late rows are no longer waited for."""
    seconds = F.unix_timestamp(F.col("w.end").cast("timestamp")) - F.unix_timestamp(F.col("w.start").cast("timestamp"))
    g = events.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("bucket"), *by, "n", (F.col("n") / seconds).alias("per_second"))


def deduplicated(events: DataFrame, key: str, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """The first row of each key; keys are kept as long as late rows may repeat them."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def counters(outcomes: DataFrame) -> DataFrame:
    """Running totals by status; update or complete mode."""
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes_written").alias("bytes_written"))


def heartbeat_sessions(beats: DataFrame, ts: str = "ts", worker: str = "worker_id", gap: str = "120 seconds", late: str = "10 minutes") -> DataFrame:
    """Sessions of heartbeats; a worker whose session has ended was silent for gap."""
    g = beats.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), worker).agg(F.count(F.lit(1)).alias("beats"))
    return g.select(worker, F.col("w.start").alias("started"), F.col("w.end").alias("silent_since"), "beats")
