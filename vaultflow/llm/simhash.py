"""SimHash near-dedup: fingerprints of word shingles, compared bit-sliced.

Distinct fingerprints are dealt to buckets of equal bits: of radius + 2 parts of the bits, a pair
within the radius agrees on two parts at least. Inside a block the bit planes stand vertically, one word for each plane and 64 fingerprints; carry-save counters
add up many distances at once, and a block is abandoned as soon as all of it exceed the radius.

A bucket that is too large for one block is dealt again, by more bits, over all tasks; the bits
left bound how large the last ones can be. Each block reports a star for each of its components,
never all pairs; components are then joined over the whole input.

Defined results: null and empty texts have fingerprint zero and are linked like any other; rows
with a null id get their component but never name one, unless all its ids are null (then null);
repeated rows are linked through their equal fingerprints; an empty table gives no rows; other
columns are never read.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.llm._common import LOWER, id_type, join_by_unique_key, map_batches, materialise, parted, read_table, schema_of, text_hash, texts_of, without
from vaultflow.llm.components import connected_components

RADIUS = 2
BLOCK = 512
#: A bucket of more fingerprints than this is dealt again by more of its bits.
MOST = 2048
#: With so few bits left a bucket has at most 2**LEAST_BITS fingerprints and is compared as it is.
LEAST_BITS = 12


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """A bit is 1 if over half of the shingles' XXH64 have it."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    k = min(shingle, len(words))
    starts, ends = (end - size)[: len(words) - k + 1].tolist(), end[k - 1 :].tolist()
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), map(joined.__getitem__, map(slice, starts, ends))), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i : i + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h), bitorder="little").tobytes(), "little")


def planes_of(prints: np.ndarray) -> np.ndarray:
    """64 bit planes, each of a bit for every fingerprint, in 64-bit words."""
    words = -(-len(prints) // 64)
    bits = np.zeros((64, 64 * words), np.uint8)
    bits[:, : len(prints)] = (prints[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def within(planes: np.ndarray, queries: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each query the bits of the fingerprints within radius, as words.

    counters[j] holds bit j of every lane's distance so far; what is carried out of the last one,
    or compares as more than radius, is lost for good."""
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    counters = [np.zeros((len(queries), planes.shape[1]), np.uint64) for _ in range((radius + 1).bit_length())]
    lost = np.zeros_like(counters[0])
    for p in range(64):
        flip = np.where((queries >> np.uint64(p)) & np.uint64(1), ones, np.uint64(0))
        carry = planes[p][None, :] ^ flip[:, None]
        for c in counters:
            c_and = c & carry
            c ^= carry
            carry = c_and
        lost |= carry
        if p % 8 == 7:
            lost |= _more_than(counters, radius)
            if (lost == ones).all():
                break
    return ~lost


def _more_than(counters: list[np.ndarray], radius: int) -> np.ndarray:
    more, same = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for j in reversed(range(len(counters))):
        if radius >> j & 1:
            same &= counters[j]
        else:
            more |= same & counters[j]
            same &= ~counters[j]
    return more


def linked(prints: np.ndarray, groups: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint the first one of its component, among those of its group."""
    n = len(prints)
    planes, near = planes_of(prints), np.empty((n, n), bool)
    for i in range(0, n, 64):
        words = within(planes, prints[i : i + 64], radius)
        near[i : i + 64] = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")[:, :n]
    near &= groups[:, None] == groups[None, :]
    label = np.arange(n)
    while True:
        least = np.where(near, label[None, :], n).min(1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def masks(radius: int = RADIUS) -> list[int]:
    """Masks of bits of which any two fingerprints within radius agree on one: of radius + 2 parts, all pairs."""
    parts = _parts(0xFFFFFFFFFFFFFFFF, radius + 2)
    return [a | b for a, b in combinations(parts, 2)]


def _parts(bits: int, n: int) -> list[int]:
    at = [i for i in range(64) if bits >> i & 1]
    return [sum(1 << i for i in at[k * len(at) // n : (k + 1) * len(at) // n]) for k in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _compare(radius: int, most: int, least_bits: int):
    """Rows (mask, print), sorted by mask and masked print, to stars (0, print, first print) and rows to deal again (1, mask, print)."""

    def block(prints: np.ndarray, groups: np.ndarray):
        label = linked(prints, groups, radius)
        at = np.flatnonzero(label != np.arange(len(label)))
        return np.zeros(len(at), np.int64), prints[at], prints[label[at]]

    def again(mask: int, prints: np.ndarray):
        own = np.array([mask | p for p in _parts(~mask & 0xFFFFFFFFFFFFFFFF, radius + 1)], np.uint64)
        return np.ones(len(own) * len(prints), np.int64), np.repeat(own, len(prints)), np.tile(prints, len(own))

    def whole(mask, prints):
        """Whole buckets, in blocks of about BLOCK fingerprints."""
        key = prints & mask
        cut = np.flatnonzero((key[1:] != key[:-1]) | (mask[1:] != mask[:-1])) + 1
        starts, ends = np.append(0, cut), np.append(cut, len(prints))
        several = np.flatnonzero(ends - starts > 1)
        at, groups, size = [], [], 0
        for g in several.tolist():
            n = int(ends[g] - starts[g])
            if n > most and 64 - int(mask[starts[g]]).bit_count() > least_bits:
                yield again(int(mask[starts[g]]), prints[starts[g] : ends[g]])
                continue
            if size and size + n > BLOCK:
                yield block(prints[np.concatenate(at)], np.concatenate(groups))
                at, groups, size = [], [], 0
            at.append(np.arange(starts[g], ends[g]))
            groups.append(np.full(n, g))
            size += n
        if size:
            yield block(prints[np.concatenate(at)], np.concatenate(groups))

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []  # of the bucket that may go on

        def out(parts):
            for kind, a, b in parts:
                yield {"kind": kind, "a": a.view(np.int64), "b": b.view(np.int64)}

        def joined():
            mask, prints = (np.concatenate(x) for x in zip(*held))
            held.clear()
            return mask, prints

        for x in batches:
            mask, prints = (np.asarray(x.column(i)).view(np.uint64) for i in range(2))
            if not len(prints):
                continue
            key = prints & mask
            last = np.flatnonzero((key != key[-1]) | (mask != mask[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if held and (cut or held[0][0][0] != mask[0] or held[0][0][0] & held[0][1][0] != key[0]):
                held.append((mask[:cut], prints[:cut]))
                yield from out(whole(*joined()))
            elif cut:
                yield from out(whole(mask[:cut], prints[:cut]))
            held.append((mask[cut:], prints[cut:]))
        if held:
            yield from out(whole(*joined()))

    return run


def links(prints: DataFrame, radius: int = RADIUS, most: int = MOST, least_bits: int = LEAST_BITS) -> DataFrame:
    """a, b: edges that connect just those of the distinct fingerprints (column fp, long) that chains within radius connect."""
    each = F.array(*(F.lit(_signed(m)) for m in masks(radius)))
    rows = prints.select(F.explode(each).alias("mask"), "fp")
    found = None
    while True:
        key = F.col("fp").bitwiseAND(F.col("mask"))
        dealt = rows.repartition("mask", key).sortWithinPartitions("mask", key)
        out = materialise(map_batches(dealt, _compare(radius, most, least_bits), schema_of("kind bigint, a bigint, b bigint")), "links")
        edges = out.filter("kind = 0").select("a", "b")
        found = edges if found is None else found.unionByName(edges)
        rows = out.filter("kind = 1").select(F.col("a").alias("mask"), F.col("b").alias("fp"))
        if rows.isEmpty():
            return found


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ver (the text's hash), fp (a signed long) of every whole text."""

    def run(batches):
        for b in batches:
            yield {"doc_id": b.column(0), "ver": b.column(2), "fp": np.array([fingerprint(t, shingle, seed) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)}

    return map_batches(texts_of(docs, id_col, text_col, text_hash(text_col).alias("ver")), run, schema_of(f"doc_id {id_type(docs, id_col)}, ver bigint, fp bigint"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ver, fp, root (the component's smallest fingerprint), component_id (the smallest doc_id that chains of links reach) of every row of docs."""
    prints = materialise(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = connected_components(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "roots")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = rooted.select("fp", "n", "root").join(named, "root").select("fp", "n", "root", "component_id")
    return join_by_unique_key(prints, of_print, "fp", "n").select("doc_id", "ver", "fp", "root", "component_id")


def keep_one_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with one row of each component: that of the smallest id and, of several texts of that id, of the text of the
    smallest hash. Of rows that are equal in both any one stays. Rows of null id stay. Only rows that may go are shuffled."""
    found = materialise(near_duplicates(docs, radius, shingle, seed, id_col, text_col), "components")
    later = found.filter(F.col("doc_id") != F.col("component_id")).select("doc_id", "ver")
    heads = materialise(found.filter(F.col("doc_id") == F.col("component_id")).groupBy("root", "doc_id", "ver").agg(F.count(F.lit(1)).alias("n")), "heads")
    least = heads.groupBy("root").agg(F.min("ver").alias("least"))
    later = later.union(heads.join(least, "root").filter(F.col("ver") > F.col("least")).select("doc_id", "ver")).distinct()
    out = without(docs, materialise(later.withColumnRenamed("doc_id", "doc"), "later"), id_col, text_col)
    repeated = heads.filter("n > 1").select(F.col("doc_id").alias("doc"), "ver").distinct()
    if repeated.isEmpty():
        return out
    rest, some = parted(out, repeated, id_col, text_col)
    return rest.unionByName(some.dropDuplicates([id_col, text_col]))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
