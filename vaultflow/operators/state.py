"""Export state: outcomes by key, counters, cursors, recovery.

Tables are immutable snapshots: every change takes old rows and new ones and returns the rows after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultflow.schemas import FAILED, ORIGIN, SKIPPED, SUCCEEDED


def upsert_outcomes(old: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    """The last outcome of each key, by seq; of a known key the document's ids stay as first recorded. new has seq, old counts before it."""
    cols = old.columns
    both = old.withColumn(seq, F.lit(None).cast("bigint")).unionByName(new.select(*cols, F.col(seq).cast("bigint").alias(seq)))
    order = F.coalesce(F.col(seq), F.lit(-(2**62)))
    ids = ("part", "ver", "dfv")
    merged = both.groupBy("idempotency_key").agg(
        F.max_by(F.struct(*(c for c in cols if c != "idempotency_key")), order).alias("last"), F.min_by(F.struct(*ids), order).alias("first")
    )
    return merged.select(*(F.col("idempotency_key") if c == "idempotency_key" else F.col(("first." if c in ids else "last.") + c).alias(c) for c in cols))


def counters(outcomes: DataFrame) -> DataFrame:
    """One row of totals; zeros for no rows. The same as counters that are kept up to date with each change."""
    one = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, 1).otherwise(0)), F.lit(0)).cast("bigint")
    return outcomes.agg(
        F.count(F.lit(1)).alias("total_recorded"), one(SUCCEEDED).alias("total_succeeded"), one(FAILED).alias("total_failed"), one(SKIPPED).alias("total_skipped"),
        F.coalesce(F.sum("bytes_written"), F.lit(0)).cast("bigint").alias("total_bytes_written"),
    )


def counter_deltas(old: DataFrame, new: DataFrame) -> DataFrame:
    """Signed changes of the counters when new outcomes replace old ones of the same keys: what a stream adds up."""
    before = old.join(new.select("idempotency_key").distinct(), "idempotency_key", "left_semi")
    a, b = counters(new), counters(before)
    return a.crossJoin(F.broadcast(b.toDF(*(f"old_{c}" for c in b.columns)))).select(*((F.col(c) - F.col(f"old_{c}")).alias(c) for c in a.columns))


def statuses(keys: DataFrame, outcomes: DataFrame) -> DataFrame:
    """keys with the recorded status, or null."""
    return keys.join(outcomes.select("idempotency_key", "status"), "idempotency_key", "left")


def read_cursor(cursors: DataFrame, partition_key: str) -> DataFrame:
    """One row: the partition's cursor, or the origin."""
    found = cursors.filter(F.col("partition_key") == partition_key).agg(F.max(F.struct("last_part", "last_ver")).alias("c"))
    return found.select(F.lit(partition_key).alias("partition_key"), F.coalesce("c.last_part", F.lit(ORIGIN[0])).alias("last_part"), F.coalesce("c.last_ver", F.lit(ORIGIN[1])).alias("last_ver"))


def advance_cursors(old: DataFrame, new: DataFrame) -> DataFrame:
    """The greater cursor of each partition; its time is that of the last attempt in any case."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    g = both.groupBy("partition_key").agg(F.max(F.struct("last_part", "last_ver")).alias("c"), F.max(F.struct("__new", "updated")).alias("u"))
    return g.select("partition_key", F.col("c.last_part").alias("last_part"), F.col("c.last_ver").alias("last_ver"), F.col("u.updated").alias("updated"))


def advances(part, ver, last_part, last_ver) -> Column:
    """Whether (part, ver) is strictly after the cursor (last_part, last_ver); any key is after no cursor."""
    as_col = lambda x: F.col(x) if isinstance(x, str) else x
    part, ver, last_part, last_ver = map(as_col, (part, ver, last_part, last_ver))
    return last_part.isNull() | (part > last_part) | ((part == last_part) & (last_ver.isNull() | (ver > last_ver)))


def high_water(outcomes: DataFrame) -> DataFrame:
    """The greatest (part, ver) of all outcomes."""
    return outcomes.agg(F.max(F.struct("part", "ver")).alias("c")).select(F.col("c.part").alias("last_part"), F.col("c.ver").alias("last_ver"))


def gap_free_cursor(documents: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The last key before the first document that is neither succeeded nor skipped: a pruning hint that
    skips no open document, in whatever order documents end."""
    done = outcomes.filter(F.col("status").isin(SUCCEEDED, SKIPPED)).select("idempotency_key", F.lit(True).alias("done"))
    marked = documents.join(done, "idempotency_key", "left").select(F.struct("part", "ver", "dfv").alias("k"), F.coalesce("done", F.lit(False)).alias("done"))
    first_open = marked.filter(~F.col("done")).agg(F.min("k").alias("open"))
    before = marked.crossJoin(F.broadcast(first_open)).filter(F.col("open").isNull() | (F.struct("k.part", "k.ver") < F.struct("open.part", "open.ver")))
    found = before.agg(F.max("k").alias("k"))
    return found.select(F.coalesce("k.part", F.lit(ORIGIN[0])).alias("last_part"), F.coalesce("k.ver", F.lit(ORIGIN[1])).alias("last_ver"))


def recover(wal: DataFrame, table: DataFrame) -> DataFrame:
    """partition_key, last_part, last_ver, source: the greater of two stores' cursors, and which store must be filled up."""
    w = wal.select("partition_key", F.struct("last_part", "last_ver").alias("w"))
    t = table.select("partition_key", F.struct("last_part", "last_ver").alias("t"))
    both = w.join(t, "partition_key", "full")
    source = F.when(F.col("w").isNull(), "table").when(F.col("t").isNull(), "wal").when(F.col("w") == F.col("t"), "both").when(F.col("w") > F.col("t"), "wal").otherwise("table")
    best = F.greatest("w", "t")
    behind = F.when(source == "wal", "table").when(source == "table", "wal")
    return both.select("partition_key", best["last_part"].alias("last_part"), best["last_ver"].alias("last_ver"), source.alias("source"), behind.alias("behind"))


def latest_by(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key by order, in one pass and without a window."""
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return g.select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest))


def latest_by_window(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The same, by a ranking window."""
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc() for c in order))
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
