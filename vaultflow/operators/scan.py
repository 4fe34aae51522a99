"""Scans of the vault: committed document versions in key order, and their payloads.

Metadata is decided first; payloads are joined to what is left, never sorted."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.functions import guards
from vaultflow.functions.keys import idempotency_key
from vaultflow.schemas import ORIGIN, SKIPPED, SUCCEEDED


class Vault(NamedTuple):
    """The three relations of a document vault."""

    versions: DataFrame
    files: DataFrame
    contents: DataFrame


def after(cursor: tuple[int, int] | None, part: str = "part", ver: str = "ver") -> Column:
    """Keys strictly after the cursor, as an OR that Parquet scans push down; a struct comparison they don't."""
    if cursor is None or tuple(cursor) == ORIGIN:
        return F.lit(True)
    p, v = cursor
    return (F.col(part) > F.lit(p)) | ((F.col(part) == F.lit(p)) & (F.col(ver) > F.lit(v)))


def committed(vault: Vault, cursor: tuple[int, int] | None = None) -> DataFrame:
    """Raw columns of committed versions after the cursor."""
    files = vault.files.filter(F.col("committed"))
    return vault.versions.filter(after(cursor)).join(files, ["part", "dfv"])


def descriptors(rows: DataFrame) -> DataFrame:
    """Raw columns with the null policy and the derived key: no title or extension is '', no time the epoch.

    Negative sizes raise when the plan runs."""
    size = lambda c: F.when(F.col(c) < 0, F.raise_error(F.concat(F.lit(f"negative {c} of part "), F.col("part").cast("string"))).cast("bigint")).otherwise(F.col(c)).alias(c)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return rows.select(
        "part", F.col("ver").cast("bigint").alias("ver"), "dfv", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("extension", F.lit("")).alias("extension"),
        size("logical_size"), size("physical_size"), F.coalesce("last_write", epoch).alias("last_write"), idempotency_key("part", "ver", "dfv").alias("idempotency_key"),
    )


def scan_documents(vault: Vault, cursor: tuple[int, int] | None = None) -> DataFrame:
    """All descriptors after the cursor, without an order: nothing that follows needs one."""
    return descriptors(committed(vault, cursor))


def scan_page(vault: Vault, cursor: tuple[int, int] | None = None, n: int = 1000) -> DataFrame:
    """The next n descriptors by (part, ver, dfv); dfv decides ties, so that no page cuts one in two unseen."""
    guards.within("page_size", n)
    return scan_documents(vault, cursor).orderBy("part", "ver", "dfv").limit(n)


def numbered_pages(rows: DataFrame, page_size: int) -> DataFrame:
    """rows with the number of the page, from 0, that a page-by-page scan would bring them in.

    Ranks come from ranges of part: a count for each range, and ranks within it - not from one sorted task."""
    guards.within("page_size", page_size)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(rows.agg(F.percentile_approx("part", [i / parts for i in range(1, parts)] or [1.0], 1000)).first()[0] or []))
    span = F.lit(0)
    if bounds:
        span = F.size(F.filter(F.array(*(F.lit(b) for b in bounds)), lambda b: b < F.col("part")))
    ranged = rows.withColumn("__range", span)
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nth = F.row_number().over(Window.partitionBy("__range").orderBy("part", "ver", "dfv"))
    out = ranged.withColumn("__nth", nth).join(F.broadcast(counts.select("__range", before.alias("__before"))), "__range")
    return out.withColumn("page", F.floor((F.col("__before") + F.col("__nth") - 1) / page_size).cast("bigint")).drop("__range", "__nth", "__before")


def stream_documents(vault: Vault, cursor: tuple[int, int] | None = None):
    """An iterator over descriptors in key order, a partition at a time on the driver."""
    yield from scan_documents(vault, cursor).orderBy("part", "ver", "dfv").toLocalIterator(prefetchPartitions=True)


def count_remaining(vault: Vault, cursor: tuple[int, int] | None = None) -> DataFrame:
    return committed(vault, cursor).agg(F.count(F.lit(1)).alias("remaining"))


def attach_content(rows: DataFrame, vault: Vault) -> DataFrame:
    """rows with data, and content_missing where the payload is null, absent or not committed."""
    ready = vault.contents.join(vault.files.filter("committed").select("part", "dfv"), ["part", "dfv"], "left_semi")
    return rows.join(ready, ["part", "dfv"], "left").withColumn("content_missing", F.col("data").isNull())


def drop_oversize(rows: DataFrame, max_mb: int | None) -> tuple[DataFrame, DataFrame]:
    """rows within max_mb MiB (0 or None: all), and those that are dropped without an outcome."""
    if not max_mb or max_mb <= 0:
        return rows, rows.limit(0)
    big = F.col("logical_size") > F.lit(max_mb * 1_048_576)
    return rows.filter(~F.coalesce(big, F.lit(False))), rows.filter(big)


def drop_done(rows: DataFrame, outcomes: DataFrame) -> DataFrame:
    """rows whose key is neither succeeded nor skipped; failed ones run again."""
    done = outcomes.filter(F.col("status").isin(SUCCEEDED, SKIPPED)).select("idempotency_key")
    return rows.join(done, "idempotency_key", "left_anti")


def plan_export(vault: Vault, outcomes: DataFrame, max_mb: int | None = None, cursor: tuple[int, int] | None = None) -> DataFrame:
    """What is left to export: scan, size filter, anti-join. Payloads are attached after it."""
    return drop_done(drop_oversize(scan_documents(vault, cursor), max_mb)[0], outcomes)
