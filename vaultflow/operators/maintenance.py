"""Archiving, purging, compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.functions import guards
from vaultflow.operators.tracking import _ts
from vaultflow.schemas import TERMINAL

CHILDREN = ("audit", "checkpoints", "errors", "metrics", "progress", "work_items", "workers")


def archive_candidates(jobs: DataFrame, as_of: str, older_than_days: int = 180, n: int = 1000) -> DataFrame:
    """Up to n terminal jobs that ended more than older_than_days ago, the oldest first."""
    guards.positive(n=n)
    cut = _ts(as_of) - F.make_dt_interval(days=F.lit(older_than_days))
    return jobs.filter(F.col("status").isin(*TERMINAL) & (F.col("completed") < cut)).orderBy("completed", "job_id").limit(n).select("job_id")


def archive(tables: dict[str, DataFrame], as_of: str, older_than_days: int = 180, n: int = 1000) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(live tables, rows to archive): the jobs and all that belongs to them, work items too."""
    ids = F.broadcast(archive_candidates(tables["jobs"], as_of, older_than_days, n))
    stamp = lambda df: df.withColumn("archived", _ts(as_of))
    names = [x for x in ("jobs", *CHILDREN) if x in tables]
    return {x: tables[x].join(ids, "job_id", "left_anti") for x in names}, {x: stamp(tables[x].join(ids, "job_id", "left_semi")) for x in names}


def purge(archived: dict[str, DataFrame], as_of: str, after_days: int = 730) -> dict[str, DataFrame]:
    cut = _ts(as_of) - F.make_dt_interval(days=F.lit(after_days))
    return {k: df.filter(~F.coalesce(F.col("archived") < cut, F.lit(False))) for k, df in archived.items()}


def compact(df: DataFrame, path: str, files: int, *sort: str) -> None:
    """Rewrites df sorted into files of even size, for scans that prune by their keys' ranges."""
    df.repartitionByRange(files, *sort).sortWithinPartitions(*sort).write.mode("overwrite").parquet(path)


def analyze(spark: SparkSession, table: str, *columns: str) -> DataFrame:
    """Brings a table's statistics, and those of columns (none: all), up to date for the optimizer; column_name, distinct_count, num_nulls
    of each, and n_rows."""
    name = ".".join(f"`{x.replace('`', '``')}`" for x in table.split("."))
    which = "ALL COLUMNS" if not columns else "COLUMNS " + ", ".join(f"`{c.replace('`', '``')}`" for c in columns)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR {which}")
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'").first()["data_type"]
    n = int(rows.rpartition(", ")[2].split(" ")[0])
    out = None
    for c in columns or spark.table(table).columns:
        said = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {name} `{c.replace('`', '``')}`").collect()}
        count = lambda k, s=said: None if s.get(k) in (None, "NULL") else int(s[k])
        row = spark.range(1).select(F.lit(c).alias("column_name"), F.lit(count("distinct_count")).cast("bigint").alias("distinct_count"), F.lit(count("num_nulls")).cast("bigint").alias("num_nulls"), F.lit(n).cast("bigint").alias("n_rows"))
        out = row if out is None else out.unionByName(row)
    return out
