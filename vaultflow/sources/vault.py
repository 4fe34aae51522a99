"""Where vault relations come from: Parquet, or JDBC in ranges of the part id; and seeded ones for tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.functions.paths import quote_identifier
from vaultflow.operators.scan import Vault
from vaultflow.schemas import RELATIONS


def parquet_vault(spark: SparkSession, root: str) -> Vault:
    return Vault(*(spark.read.schema(RELATIONS[n]).parquet(f"{root}/{n}") for n in ("document_file_version", "data_file_version", "data_file_version_bytes")))


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str, low: int, high: int, parts: int, isolation: str = "READ_COMMITTED", session_init: str | None = None, **options: str) -> DataFrame:
    """A table read in parallel by ranges of partition_column; filters and columns are pushed to the server."""
    quote_identifier(table)
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=partition_column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts), isolationLevel=isolation, pushDownLimit="true", **options
    )
    return (reader.option("sessionInitStatement", session_init) if session_init else reader).load()


def seeded_vault(spark: SparkSession, n: int, seed: int = 42, uncommitted_every: int = 0, max_bytes: int = 524_288) -> Vault:
    """n documents: 60 % of 256 B to 4 KiB, 30 % to 64 KiB, 10 % to max_bytes; pdf, docx and txt in turn."""
    u = lambda k: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(k)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    low = F.when(u(1) < 0.6, 256).when(u(1) < 0.9, 4096).otherwise(65_536)
    high = F.when(u(1) < 0.6, 4096).when(u(1) < 0.9, 65_536).otherwise(max_bytes)
    rows = spark.range(n).select(
        (F.lit(1_000_000) + F.col("id")).alias("part"), F.lit(1).alias("ver"), (F.lit(5_000_000) + F.col("id")).alias("dfv"),
        F.format_string("doc_%08d_v1", F.lit(1_000_000) + F.col("id")).alias("title"),
        F.element_at(F.array(F.lit("pdf"), F.lit("docx"), F.lit("txt")), (F.pmod("id", F.lit(3)) + 1).cast("int")).alias("extension"),
        (low + F.floor(u(2) * (high - low))).cast("bigint").alias("size"),
        (F.lit(True) if not uncommitted_every else F.pmod("id", F.lit(uncommitted_every)) != 0).alias("committed"),
    )
    files = rows.select("part", "dfv", F.col("size").alias("logical_size"), F.col("size").alias("physical_size"), F.lit("2024-01-01").cast("timestamp_ntz").alias("last_write"), "committed")
    data = F.substring(F.repeat(F.sha2(F.col("part").cast("string"), 256), F.ceil(F.col("size") / 64).cast("int")), F.lit(1), F.col("size").cast("int")).cast("binary")
    return Vault(rows.select("part", "ver", "dfv", "title", "extension"), files, rows.select("part", "dfv", data.alias("data")))
