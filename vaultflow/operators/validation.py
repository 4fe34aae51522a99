"""Checks of exported files against what was recorded, in order; the first that fails decides.

files has path, length, content and readable; spark.read.format("binaryFile") gives the first three."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultflow.functions.keys import checksum

# Checks in their order.
ORDER = ("exists", "folder", "extension", "size", "readable", "checksum", "metadata")


def _check(name: str, fails: Column, reason: Column | str, retryable: bool | Column = False, skipped: Column | None = None, warns: Column | None = None) -> Column:
    skip = F.lit(False) if skipped is None else F.coalesce(skipped, F.lit(False))
    bad = F.coalesce(fails, F.lit(False))
    warn = F.lit(False) if warns is None else F.coalesce(warns, F.lit(False))
    said = reason if isinstance(reason, Column) else F.lit(reason)
    status = F.when(skip, "Skipped").when(bad, "Failed").when(warn, "Warning").otherwise("Passed")
    again = retryable if isinstance(retryable, Column) else F.lit(retryable)
    return F.struct(F.lit(name).alias("name"), status.alias("status"), F.when(bad & ~skip, said).alias("reason"), F.when(bad & ~skip, again).otherwise(F.lit(False)).alias("retryable"))


def validate(outcomes: DataFrame, files: DataFrame, root: str, algorithm: str | None = "sha256", extension_may_differ: bool = False, fail_fast: bool = True) -> DataFrame:
    """outcomes (key, path, expected_size, expected_checksum, expected_extension, meta_path, meta_size, meta_checksum) with
    checks (all of them), status, failed_check, reason, retryable. The expected size is the source's, not the sink's own count."""
    names = set(files.columns)
    # Checksums are made where the files are read: no payload is shuffled.
    f = files.select(F.col("path").alias("__path"), F.col("length").alias("__length"), F.lower(checksum("content", algorithm)).alias("__hash"), (F.col("readable") if "readable" in names else F.lit(True)).alias("__readable"))
    df = outcomes.join(f, F.regexp_replace(F.col("path"), "^file:/*", "/") == F.regexp_replace(F.col("__path"), "^file:/*", "/"), "left")
    there, root = F.col("__path").isNotNull(), root.rstrip("/")
    blank = F.coalesce(F.trim("path") == "", F.lit(True))
    ext = F.lower(F.regexp_extract("path", "\\.([^./]*)$", 1))
    wrong_ext = ext != F.lower(F.coalesce("expected_extension", F.lit("")))
    hashed = F.col("__hash")
    none = F.lit(algorithm is None or algorithm == "none")
    checks = F.array(
        _check("exists", blank | ~there, F.when(blank, "empty path").otherwise("missing"), ~blank),
        _check("folder", ~F.col("path").startswith(root + "/"), "outside the root"),
        _check("extension", F.lit(False) if extension_may_differ else wrong_ext, "another extension", warns=wrong_ext if extension_may_differ else None),
        _check("size", F.col("__length") != F.col("expected_size"), "another size"),
        _check("readable", ~F.col("__readable"), "not readable", True),
        _check("checksum", hashed != F.lower("expected_checksum"), "another checksum", skipped=none | F.col("expected_checksum").isNull()),
        _check("metadata", (F.col("meta_path") != F.col("path")) | (F.col("meta_size") != F.col("__length")) | (F.lower("meta_checksum") != F.lower("expected_checksum")), "another record", skipped=F.col("meta_path").isNull()),
    )
    df = df.withColumn("checks", checks)
    first = F.try_element_at(F.filter("checks", lambda c: c["status"] == "Failed"), F.lit(1))
    if fail_fast:
        at = F.array_position(F.transform("checks", lambda c: c["status"]), "Failed")
        df = df.withColumn("checks", F.when(at > 0, F.slice("checks", F.lit(1), at.cast("int"))).otherwise(F.col("checks")))
    out = df.withColumns({"failed": first})
    return out.select(*outcomes.columns, "checks", F.when(F.col("failed").isNull(), "Passed").otherwise("Failed").alias("status"), F.col("failed.name").alias("failed_check"), F.col("failed.reason").alias("reason"), F.coalesce("failed.retryable", F.lit(False)).alias("retryable"))
