"""Numbers for new rows, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def numbered(rows: DataFrame, name: str, start: int, *order: str) -> DataFrame:
    """rows with name: start, start + 1, ... in the order of a hash of the columns of order, then of themselves. The hash cuts rows into
    BUCKETS even shares; each share is ranked by itself, and follows the rows of those before it, whose counts are BUCKETS rows at most.
    Rows that are equal in all of them are numbered in any order."""
    bucket, nth, before = "__bucket", "__nth", "__before"
    dealt = rows.withColumn(bucket, F.pmod(F.xxhash64(*order, F.lit(name)), F.lit(BUCKETS)))
    ranked = dealt.withColumn(nth, F.row_number().over(Window.partitionBy(bucket).orderBy(*order)))
    counts = dealt.groupBy(bucket).agg(F.count(F.lit(1)).alias("__n"))
    sums = counts.select(bucket, (F.sum("__n").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")).alias(before))
    number = (F.lit(start - 1) + F.col(nth) + F.col(before)).cast("bigint")
    return ranked.join(F.broadcast(sums), bucket).withColumn(name, number).drop(bucket, nth, before)
