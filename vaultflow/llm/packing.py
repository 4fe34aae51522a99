"""Best-fit packing: best-fit decreasing over token lengths with a segment tree over remaining
capacities.

Best-fit decreasing treats equal lengths alike, so the whole corpus is packed exactly from its
histogram of lengths (at most `capacity` rows): the driver places runs of equal pieces into runs
of equal bins, the executors rank the pieces of each length, and a piece's rank finds its bin.

Defined results: a null text is empty and is one piece that holds the end token alone; repeated
rows, with equal or null ids, are packed one by one; an empty table gives no rows; other columns
are never read.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultflow.llm._common import id_type, map_batches, materialise, read_table, schema_of, texts_of
from vaultflow.llm.tokens import encoder

CAPACITY = 2048


class Run(NamedTuple):
    """count pieces of a length, from a rank on, go to bins from sequence on, per_bin to each, from offset on."""

    length: int
    rank: int
    count: int
    sequence: int
    per_bin: int
    offset: int


class CapacityTree:
    """A segment tree over capacities 0 to size: which of them have open bins."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.open = bytearray(2 * self.base)

    def set(self, capacity: int, is_open: bool) -> None:
        i = self.base + capacity
        self.open[i] = is_open
        while i > 1:
            i >>= 1
            self.open[i] = self.open[2 * i] | self.open[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity >= least that has an open bin."""
        i = self.base + least
        if self.open[i]:
            return least
        while i > 1:
            if not i & 1 and self.open[i + 1]:
                i += 1
                while i < self.base:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.base
            i >>= 1
        return None


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """The runs that best-fit decreasing makes of a histogram of lengths, and the number of bins.

    After a piece has gone to the tightest bin, that bin stays the tightest for the next equal
    piece as long as it fits, so bins of equal capacity are filled one after the other.
    """
    tree, ranges, runs, bins = CapacityTree(capacity), [[] for _ in range(capacity + 1)], [], 0

    def put(left: int, sequence: int, count: int) -> None:
        if left and count:
            ranges[left].append((sequence, count))
            tree.set(left, True)

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not within 1 to {capacity}")
        rank, n = 0, histogram[length]
        while rank < n:
            left = tree.tightest(length)
            if left is None:
                left, count = capacity, -(-(n - rank) // (capacity // length))
                sequence, bins = bins, bins + count
            else:
                sequence, count = ranges[left].pop()
                if not ranges[left]:
                    tree.set(left, False)
            k = left // length
            whole = min(count, (n - rank) // k)
            if whole:
                runs.append(Run(length, rank, whole * k, sequence, k, capacity - left))
                put(left - k * length, sequence, whole)
                rank += whole * k
            if whole < count:
                rest = n - rank  # fewer than k
                if rest:
                    runs.append(Run(length, rank, rest, sequence + whole, rest, capacity - left))
                    put(left - rest * length, sequence + whole, 1)
                    rank, whole = n, whole + 1
                put(left, sequence + whole, count - whole)
    return runs, bins


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = 0, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids and end_id, cut only where they
    exceed capacity (the first piece takes the remainder); with keep_ids the ids too. task and nth
    number the pieces of a length as the tasks meet them."""

    def run(batches):
        own_encoder = encoder(tokenizer_path)
        encode, end, task, seen = own_encoder.encode_bytes, int(end_id).to_bytes(4, "little"), TaskContext.get().partitionId(), {}
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = encode(text) + end
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n - 1) % capacity + 1 if not start else capacity
                    own = ids[4 * start : 4 * (start + length)]
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    rows.append((doc, piece, start, length, zlib.crc32(own), task, nth, np.frombuffer(own, np.uint32).astype(np.int32) if keep_ids else None))
                    start, piece = start + length, piece + 1
            yield dict(zip(names, zip(*rows) if rows else [()] * 8))
        own_encoder.forget()

    names = ("doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids")
    schema = schema_of(f"doc_id {id_type(docs, id_col)}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint" + ", ids array<int>" * keep_ids)
    return map_batches(texts_of(docs, id_col, text_col), run, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = 0, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence_id and offset there.

    The pieces are written once; only their histogram comes to the driver, at most capacity rows,
    and the runs go out by broadcast: no more than the square of capacity, in practice a few
    thousand, whatever the number of documents."""
    cut = materialise(pieces(docs, capacity, tokenizer_path, end_id, keep_ids, id_col, text_col), "pieces")
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = best_fit_decreasing(histogram, capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth")).drop("task", "nth", "base")
    table = cut.sparkSession.sparkContext.broadcast(np.array(sorted(runs), dtype=np.int64).reshape(-1, 6))
    kept = [c for c in ranked.columns if c != "rank"]

    def run(batches):
        length, rank, _, sequence, per_bin, offset = table.value.T
        first = {}
        for i, x in enumerate(length.tolist()):
            first.setdefault(x, i)
        last = {x: i + 1 for i, x in enumerate(length.tolist())}
        for b in batches:
            ln, rk = (np.asarray(b.column(b.schema.get_field_index(c))) for c in ("length", "rank"))
            at = np.empty(len(ln), np.int64)
            for x in np.unique(ln).tolist():
                own = ln == x
                at[own] = first[x] + np.searchsorted(rank[first[x] : last[x]], rk[own], side="right") - 1
            nth = rk - rank[at]
            yield {c: b.column(b.schema.get_field_index(c)) for c in kept} | {"sequence_id": sequence[at] + nth // per_bin[at], "offset": offset[at] + nth % per_bin[at] * ln}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank")
    return map_batches(ranked, run, schema_of(fields + ", sequence_id bigint, offset bigint"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
