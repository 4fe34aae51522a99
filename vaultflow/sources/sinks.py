"""Where exports and their metadata go."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.functions.keys import iso_ms, outcome_name
from vaultflow.functions.paths import csv_cell, output_path
from vaultflow.schemas import FAILED, SKIPPED, SUCCEEDED

# Columns of the metadata files, in their order.
METADATA = (
    ("part", "DocumentPartId", "documentPartId"), ("ver", "VersionPart", "versionPart"), ("title", "Title", "title"), ("extension", "Extension", "extension"),
    ("logical_size", "LogicalFileSize", "logicalFileSize"), ("physical_size", "PhysicalFileSize", "physicalFileSize"), ("last_write", "LastWriteTime", "lastWriteTime"),
    ("output_path", "ExportPath", "exportPath"), ("checksum", "Checksum", "checksum"), ("export_status", "ExportStatus", "exportStatus"), ("observed", "ExportDate", "exportDate"),
    ("worker_id", "WorkerId", "workerId"), ("retries", "RetryCount", "retryCount"), ("idempotency_key", "IdempotencyKey", "idempotencyKey"), ("dfv", "DataFileVersionId", "dataFileVersionId"),
)
EXTENSION_COLUMNS = 2
_TIMES = ("last_write", "observed")

_OUTCOME = "idempotency_key string, part bigint, ver bigint, dfv bigint, status int, bytes_written bigint, output_path string, checksum string, failure_reason string, attempt int"


def write_documents(rows: DataFrame, root: str, depth: int = 2, path: Column | None = None, chunk: int = 1 << 20, attempts: int = 3) -> DataFrame:
    """Outcomes of writing data to files under root, a folder that all executors share.

    Each file is written beside its place, flushed, and renamed, so that a lost or repeated task leaves whole files;
    a repeated one replaces its own. Each attempt starts from the payload's first byte. Rows without data are Skipped.
    Payloads come in batches that spark.sql.execution.arrow.maxBytesPerBatch bounds (64 MB), or of one payload."""
    planned = rows.withColumn("__path", output_path(root, "idempotency_key", "title", "extension", depth) if path is None else path)
    wanted = planned.select("idempotency_key", "part", "ver", "dfv", "logical_size", "data", "__path")

    def write(data: bytes, target: str) -> str:
        folder, name = os.path.split(target)
        os.makedirs(folder, exist_ok=True)
        temp, digest = os.path.join(folder, f".{name}.partial"), hashlib.sha256()
        with open(temp, "wb") as f:
            for i in range(0, len(data), chunk):
                f.write(data[i : i + chunk])
                digest.update(data[i : i + chunk])
            f.flush()
            os.fsync(f.fileno())
        os.replace(temp, target)
        return digest.hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for r in df.itertuples(index=False):
                key, part, ver, dfv, size, data, target = r
                if data is None:
                    out.append((key, part, ver, dfv, SKIPPED, 0, None, None, "content is missing", 1))
                    continue
                for n in range(1, attempts + 1):
                    try:
                        digest = write(bytes(data), target)
                    except OSError as e:
                        done = (key, part, ver, dfv, FAILED, 0, None, None, f"{type(e).__name__}: {e.strerror}", n)
                        continue
                    short = size is not None and len(data) != size
                    done = (key, part, ver, dfv, FAILED, 0, target, digest, f"{len(data)} of {size} bytes", n) if short else (key, part, ver, dfv, SUCCEEDED, len(data), target, digest, None, n)
                    break
                out.append(done)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _OUTCOME.split(", ")])

    return wanted.mapInPandas(run, _OUTCOME)


def metadata_records(documents: DataFrame, outcomes: DataFrame, worker_id: int = 0) -> DataFrame:
    """Descriptors joined with their outcomes, in the columns of the metadata files."""
    o = outcomes.select("idempotency_key", "output_path", "checksum", outcome_name("status").alias("export_status"), "observed", F.lit(worker_id).cast("bigint").alias("worker_id"), (F.col("attempt") - 1).alias("retries"))
    return documents.join(o, "idempotency_key").select(*(c for c, _, _ in METADATA))


def _text(c: str) -> Column:
    return iso_ms(c) if c in _TIMES else F.col(c).cast("string")


def csv_lines(records: DataFrame, delimiter: str = ",", extensions: bool = True) -> DataFrame:
    """One column, value: a line for each record."""
    cols = METADATA if extensions else METADATA[:-EXTENSION_COLUMNS]
    return records.select(F.concat_ws(delimiter, *(csv_cell(_text(c), delimiter) for c, _, _ in cols)).alias("value"))


def _around(lines: DataFrame, first: str | None, last: str | None, between: str = "") -> DataFrame:
    """Each partition's lines after first and before last; between ends all lines but the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if first is not None:
            yield pa.RecordBatch.from_pydict({"value": [first]})
        held = None
        for b in batches:
            for x in b.column(0).to_pylist():
                if held is not None:
                    yield pa.RecordBatch.from_pydict({"value": [held + between]})
                held = x
        if held is not None:
            yield pa.RecordBatch.from_pydict({"value": [held]})
        if last is not None:
            yield pa.RecordBatch.from_pydict({"value": [last]})

    return lines.mapInArrow(run, "value string")


def write_csv(records: DataFrame, path: str, delimiter: str = ",", header: bool = True, bom: bool = False, extensions: bool = True) -> None:
    """Files of CRLF lines, each with the header."""
    cols = METADATA if extensions else METADATA[:-EXTENSION_COLUMNS]
    first = ("﻿" if bom else "") + delimiter.join(h for _, h, _ in cols)
    lines = csv_lines(records, delimiter, extensions)
    (_around(lines, first, None) if header else lines).write.mode("overwrite").option("lineSep", "\r\n").text(path)


def json_records(records: DataFrame, extensions: bool = True) -> DataFrame:
    cols = METADATA if extensions else METADATA[:-EXTENSION_COLUMNS]
    cells = [(_text(c) if c in _TIMES else F.col(c)).alias(name) for c, _, name in cols]
    return records.select(F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}).alias("value"))


def write_json(records: DataFrame, path: str, generator: str = "vaultflow", schema_version: str = "1.0", schema_id: str = "vaultflow/metadata", extensions: bool = True) -> None:
    """Files that are each one document {schemaVersion, schemaId, generator, records: [...]}."""
    head = json.dumps({"schemaVersion": schema_version, "schemaId": schema_id, "generator": generator})[:-1] + ', "records": ['
    _around(json_records(records, extensions), head, "]}", ",").write.mode("overwrite").text(path)


def manifest_document(job: DataFrame, totals: DataFrame, artifacts: DataFrame, generated_at: str, generator: str = "vaultflow", schema_version: str = "1.0", schema_id: str = "vaultflow/manifest") -> DataFrame:
    """One row, value: the manifest of a job (one row of jobs) with its totals (one row) and artifacts (relative_path, format, record_count; a few)."""
    a = artifacts.agg(F.sort_array(F.collect_list(F.struct(F.col("relative_path").alias("relativePath"), "format", F.col("record_count").alias("recordCount")))).alias("artifacts"))
    j = F.struct(F.col("job_id").alias("id"), F.col("job_name").alias("name"), F.col("partition_key").alias("partitionKey"), F.col("source_server").alias("sourceServer"), F.col("source_database").alias("sourceDatabase"), iso_ms("started").alias("startedAtUtc"), iso_ms("completed").alias("completedAtUtc"))
    t = F.struct(*(F.col(c).alias(n) for c, n in (("total_expected", "documentsExpected"), ("total_recorded", "documentsRecorded"), ("total_succeeded", "succeeded"), ("total_failed", "failed"), ("total_skipped", "skipped"), ("total_bytes_written", "totalBytesWritten"))))
    totals = totals if "total_expected" in totals.columns else totals.withColumn("total_expected", F.col("total_recorded"))
    one = job.limit(1).select(j.alias("job")).crossJoin(totals.select(t.alias("totals"))).crossJoin(a)
    doc = F.struct(F.lit(schema_version).alias("schemaVersion"), F.lit(schema_id).alias("schemaId"), F.lit(generator).alias("generator"), F.lit(generated_at).alias("generatedAt"), "job", "totals", "artifacts")
    return one.select(F.to_json(doc, {"ignoreNullFields": "false"}).alias("value"))


def manifest_lines(outcomes: DataFrame) -> DataFrame:
    """Outcomes in the columns of the line manifest."""
    return outcomes.select(
        F.col("idempotency_key").alias("IdempotencyKey"), F.col("part").alias("DocumentFilePartId"), F.col("ver").alias("VersionPartId"), F.col("dfv").alias("DataFileVersionId"),
        outcome_name("status").alias("Status"), F.col("bytes_written").alias("BytesWritten"), F.col("output_path").alias("OutputPath"), F.col("checksum").alias("Checksum"),
        F.col("failure_reason").alias("FailureReason"), iso_ms("observed").alias("ObservedAtUtc"), F.col("attempt").alias("AttemptNumber"),
    )


def write_manifest_lines(outcomes: DataFrame, path: str, rotate: int = 100_000) -> None:
    manifest_lines(outcomes).write.mode("append").option("maxRecordsPerFile", rotate).option("ignoreNullFields", "true").json(path)


def write_metadata(records: DataFrame, root: str, formats: tuple[str, ...] = ("csv", "json")) -> list[tuple[str, str, int]]:
    """All formats from one computation of records; (relative path, format, record count) of each."""
    records = records.persist()
    try:
        n = records.count()
        writers = {"csv": write_csv, "json": write_json}
        for f in formats:
            writers[f](records, f"{root.rstrip('/')}/metadata.{f}")
        return [(f"metadata.{f}", f, n) for f in formats]
    finally:
        records.unpersist()


def console_table(df: DataFrame, most_rows: int = 1000) -> str:
    """A table of fixed width: null is -, and values over 60 characters are cut."""
    rows = [["-" if v is None else str(v) for v in r] for r in df.limit(most_rows).collect()]
    rows = [[v if len(v) <= 60 else v[:57] + "…" for v in r] for r in rows]
    width = [max(map(len, col)) for col in zip(df.columns, *rows)]
    line = lambda r: "  ".join(v.ljust(w) for v, w in zip(r, width)).rstrip()
    return "\n".join([line(df.columns), "  ".join("-" * w for w in width), *map(line, rows)])


def write_audit_log(audit: DataFrame, path: str, correlation_id: str | None = None) -> None:
    """Audit rows appended as JSON lines."""
    audit.select(
        "action", F.col("actor_name").alias("actor"), F.concat_ws("/", "entity_type", F.col("entity_id").cast("string")).alias("subject"), F.col("new_status").alias("outcome"),
        iso_ms("occurred").alias("time"), F.lit(correlation_id).cast("string").alias("correlation_id"), "details",
    ).write.mode("append").json(path)


def exposition(metrics: DataFrame, prefix: str = "vaultflow_") -> DataFrame:
    """Metrics (name, kind, labels map, value) as lines of the text exposition format, a TYPE line before each name."""
    name = F.concat(F.lit(prefix), F.regexp_replace("name", "[^A-Za-z0-9_]", "_"))
    labels = F.concat_ws(",", F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit('="'), F.replace(e["value"], F.lit('"'), F.lit('\\"')), F.lit('"'))))
    line = F.concat(name, F.when(labels == "", F.lit("")).otherwise(F.concat(F.lit("{"), labels, F.lit("}"))), F.lit(" "), F.col("value").cast("string"))
    types = metrics.select(name.alias("n"), F.lit(0).alias("k"), F.concat(F.lit("# TYPE "), name, F.lit(" "), F.col("kind")).alias("value")).distinct()
    return types.unionByName(metrics.select(name.alias("n"), F.lit(1).alias("k"), line.alias("value"))).orderBy("n", "k", "value").select("value")
