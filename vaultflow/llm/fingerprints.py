"""Document fingerprints: invertible Bloom lookup sketches of a document's paragraphs.

Each paragraph's digest goes to one cell of each of three rows; a cell holds a count, and the XOR
of its digests and of their checks. Two sketches subtract cell by cell, and peeling cells that
hold one digest recovers just the paragraphs in which two versions differ. Where a sketch is too
small for that, both are made again with GROW times the cells, until peeling ends.

Paragraphs are the text's lines, and lines are cut again after words that a hash picks (one in
CUT, on average), so that an edit changes few of them wherever it is. The n-th repetition of a
paragraph has a digest of its own.

Defined results: null and empty texts have no paragraphs, and are alike (1.0) among themselves;
repeated ids follow each other by their texts; rows of null id come first; a single document is
its own next one; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.llm._common import id_type, map_batches, read_table, schema_of, texts_of

#: Cells of each of the three rows of a fingerprint.
CELLS = 8
GROW = 4
CUT = 8
_ROWS = 3
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_CHECK = np.uint64(0x27D4EB2F165667C5)
#: Cells of all sketches that are held at once.
_AT_ONCE = 1 << 20


def paragraphs(text: str, cut: int = CUT) -> list[bytes]:
    out = []
    for line in text.encode().split(b"\n"):
        words = line.split(b" ")
        h = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        start = 0
        for end in (np.flatnonzero(h % cut == 0) + 1).tolist():
            out.append(b" ".join(words[start:end]))
            start = end
        if start < len(words):
            out.append(b" ".join(words[start:]))
    return [x for x in out if x.strip()]


def digests(text: str, cut: int = CUT) -> np.ndarray:
    """Distinct digests of a text's paragraphs and their repetitions; never 0."""
    own = paragraphs(text, cut)
    d = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    if len(set(own)) < len(own):
        seen: Counter = Counter()
        for i, x in enumerate(own):
            if seen[x]:
                d[i] = xxhash.xxh3_64_intdigest(x + b"\n%d" % seen[x])  # no paragraph has a line feed
            seen[x] += 1
    return np.unique(d | np.uint64(1 << 63))


def _mixed(d: np.ndarray, salt: np.uint64) -> np.ndarray:
    x = (d ^ (d >> np.uint64(31))) * salt
    return x ^ (x >> np.uint64(29))


def _cells(owner: np.ndarray, d: np.ndarray, cells: int) -> np.ndarray:
    """The flat places of each digest, for sketches that lie one after the other."""
    return np.concatenate([(owner * _ROWS + r) * cells + ((_mixed(d, s) * _CHECK) >> np.uint64(40)).astype(np.int64) % cells for r, s in enumerate(_SALTS)])


class Sketches:
    """n sketches of three rows of cells: count, XOR of digests, XOR of checks."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * _ROWS * cells, np.int32)
        self.sum = np.zeros(n * _ROWS * cells, np.uint64)
        self.check = np.zeros(n * _ROWS * cells, np.uint64)

    def add(self, owner: np.ndarray, d: np.ndarray, sign: np.ndarray) -> None:
        at, check = _cells(owner, d, self.cells), _mixed(d, _CHECK)
        np.add.at(self.count, at, np.tile(sign, _ROWS).astype(np.int32))
        np.bitwise_xor.at(self.sum, at, np.tile(d, _ROWS))
        np.bitwise_xor.at(self.check, at, np.tile(check, _ROWS))

    @classmethod
    def of(cls, sets: list[np.ndarray], cells: int) -> Sketches:
        out = cls(len(sets), cells)
        if sets:
            d = np.concatenate(sets)
            out.add(np.repeat(np.arange(len(sets)), [len(x) for x in sets]), d, np.ones(len(d), np.int32))
        return out

    def minus(self, other: Sketches, own: np.ndarray, others: np.ndarray) -> Sketches:
        """own[i] minus others[i], each pair."""
        out = Sketches(len(own), self.cells)
        shape = (-1, _ROWS * self.cells)
        out.count = (self.count.reshape(shape)[own] - other.count.reshape(shape)[others]).ravel()
        out.sum = (self.sum.reshape(shape)[own] ^ other.sum.reshape(shape)[others]).ravel()
        out.check = (self.check.reshape(shape)[own] ^ other.check.reshape(shape)[others]).ravel()
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owner, digest, sign) of what is recovered, and for each sketch whether that is all it held. Uses the sketches up."""
        found = []
        at = np.flatnonzero(np.abs(self.count) == 1)
        while len(at):
            at = at[(np.abs(self.count[at]) == 1) & (self.check[at] == _mixed(self.sum[at], _CHECK))]
            if not len(at):
                break
            owner, d, sign = at // (_ROWS * self.cells), self.sum[at], self.count[at]
            order = np.lexsort((d, owner))
            owner, d, sign = owner[order], d[order], sign[order]
            new = np.append(True, (owner[1:] != owner[:-1]) | (d[1:] != d[:-1]))
            owner, d, sign = owner[new], d[new], sign[new]
            found.append((owner, d, sign))
            self.add(owner, d, -sign)
            at = np.unique(_cells(owner, d, self.cells))
        left = ((self.count != 0) | (self.sum != 0)).reshape(self.n, -1).any(1)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int32), ~left
        return *(np.concatenate(x) for x in zip(*found)), ~left

    def strings(self, sizes: list[int]) -> list[str]:
        """Each sketch, with the number of its digests, as base64."""
        width = _ROWS * self.cells
        packed = np.zeros((self.n, width), np.dtype([("n", "<i4"), ("d", "<u8"), ("c", "<u8")]))
        packed["n"], packed["d"], packed["c"] = (x.reshape(-1, width) for x in (self.count, self.sum, self.check))
        return [base64.b64encode(int(s).to_bytes(4, "little") + row.tobytes()).decode() for s, row in zip(sizes, packed)]


def parsed(fingerprint: str) -> tuple[int, Sketches]:
    raw = base64.b64decode(fingerprint)
    cells = np.frombuffer(raw, np.dtype([("n", "<i4"), ("d", "<u8"), ("c", "<u8")]), offset=4)
    out = Sketches(1, len(cells) // _ROWS)
    out.count, out.sum, out.check = cells["n"].copy(), cells["d"].copy(), cells["c"].copy()
    return int.from_bytes(raw[:4], "little"), out


def differences(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of digest sets, what only a and what only b has, by sketches: where they don't peel, larger ones follow. Two digests that
    share all their cells never peel; beyond 64 times the cells that are needed, the sets themselves are compared."""
    out: list = [None] * len(a)
    todo = np.arange(len(a))
    largest = max((len(x) + len(y) for x, y in zip(a, b)), default=0)
    while len(todo):
        if cells > 64 * max(largest, 16):  # two digests that share all their cells: a chance of 1 in 10**9
            for k in todo.tolist():
                out[k] = (np.setdiff1d(a[k], b[k]), np.setdiff1d(b[k], a[k]))
            break
        step = max(1, _AT_ONCE // (_ROWS * cells))
        failed = []
        for i in range(0, len(todo), step):
            part = todo[i : i + step]
            own, other = Sketches.of([a[k] for k in part], cells), Sketches.of([b[k] for k in part], cells)
            at = np.arange(len(part))
            owner, d, sign, whole = own.minus(other, at, at).peel()
            order = np.argsort(owner, kind="stable")
            owner, d, sign = owner[order], d[order], sign[order]
            ends = np.searchsorted(owner, np.arange(len(part) + 1))
            for k, (s, e) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                if whole[k]:
                    out[part[k]] = (d[s:e][sign[s:e] > 0], d[s:e][sign[s:e] < 0])
            failed.append(part[~whole])
        todo, cells = np.concatenate(failed), cells * GROW
    return out


def likeness(sizes_a: np.ndarray, sizes_b: np.ndarray, n_different: np.ndarray) -> np.ndarray:
    """The share of paragraphs in common, 2|A and B| / (|A| + |B|); two empty texts are alike."""
    both = sizes_a + sizes_b
    return np.where(both > 0, (both - n_different) / np.maximum(both, 1), 1.0)


def compare(sets: list[np.ndarray], pairs: list[tuple[int, int]], sketches: Sketches) -> np.ndarray:
    """The likeness of pairs of sets; sketches are theirs of CELLS cells, and larger ones follow where those fail."""
    if not pairs:
        return np.empty(0)
    a, b = np.array(pairs).T
    owner, _, _, whole = sketches.minus(sketches, a, b).peel()
    n = np.bincount(owner, minlength=len(pairs))
    failed = np.flatnonzero(~whole)
    again = differences([sets[k] for k in a[failed]], [sets[k] for k in b[failed]], sketches.cells * GROW)
    n[failed] = [len(x) + len(y) for x, y in again]
    size = np.array([len(x) for x in sets])
    return likeness(size[a], size[b], n)


def fingerprint_texts(docs: DataFrame, cells: int = CELLS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, n_paragraphs of every whole text."""

    def run(batches):
        for b in batches:
            sets = [digests(t) for t in b.column(1).to_pylist()]
            yield {"doc_id": b.column(0), "fingerprint": Sketches.of(sets, cells).strings([len(x) for x in sets]), "n_paragraphs": [len(x) for x in sets]}

    return map_batches(texts_of(docs, id_col, text_col), run, schema_of(f"doc_id {id_type(docs, id_col)}, fingerprint string, n_paragraphs bigint"))


def _bounds(ids: DataFrame, parts: int) -> list:
    """Ids, parts - 1 of them at most, that cut all into ranges of about equal size: quantiles of numbers, and of other ids those of 64 for each part
    of the smallest hashes."""
    if id_type(ids, "doc_id") in ("tinyint", "smallint", "int", "bigint", "float", "double"):
        return sorted(set(ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [1.0], 10_000)).first()[0] or []))
    some = sorted(r[0] for r in ids.dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(64 * parts).collect())
    return sorted({some[i * len(some) // parts] for i in range(1, parts)}) if some else []


def with_next(docs: DataFrame, f, schema: str, at_once: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows that f makes of lists of (id, text) in ascending order of (id, text) - nulls first - and the
    text that follows them; after the last row comes the first.

    One shuffle: rows go to ranges of ids, and the first row of each range to the range before it
    too. Only the bounds of the ranges and their first ids come to the driver."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts_of(docs, id_col, text_col)
    ids = rows.select("doc_id")
    bounds = _bounds(ids, parts)

    def parts_of(ids: list) -> np.ndarray:
        known = np.array([bounds[0] if x is None else x for x in ids]) if bounds else np.zeros(len(ids))
        return np.where([x is None for x in ids], 0, np.searchsorted(np.array(bounds), known, side="left")) if bounds else np.zeros(len(ids), int)

    def firsts(batches):
        for b in batches:
            own = b.column(0).to_pylist()
            part = parts_of(own)
            found = [min((x for x, p in zip(own, part) if p == k), key=lambda x: (x is not None, x)) for k in np.unique(part)]
            yield {"part": np.unique(part), "doc_id": found}

    kind = id_type(docs, id_col)
    head = map_batches(ids, firsts, schema_of(f"part int, doc_id {kind}")).groupBy("part").agg(
        F.max(F.col("doc_id").isNull()).alias("has_null"), F.min("doc_id").alias("doc_id")).collect()
    head = sorted((r["part"], None if r["has_null"] else r["doc_id"]) for r in head) if head else []
    before = {}
    for (part, _), (_, first) in zip(head, head[1:] + head[:1]):
        before.setdefault(first, []).append(part)

    def deal(batches):
        for b in batches:
            own, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            part = parts_of(own).tolist()
            more = [(p, i, True) for i, x in enumerate(own) if x in before for p in before[x]]
            every = [(p, i, False) for i, p in enumerate(part)] + more
            yield {"part": [p for p, _, _ in every], "extra": [e for _, _, e in every], "doc_id": [own[i] for _, i, _ in every], "text": [texts[i] for _, i, _ in every]}

    dealt = map_batches(rows, deal, schema_of(f"part int, extra boolean, doc_id {kind}, text string"))
    dealt = dealt.repartition(parts, "part").sortWithinPartitions("part", "extra", "doc_id", "text")

    def run(batches):
        held, of = [], None
        for part, extra, x, text in _rows(batches):
            if part != of:
                held, of = [], part
            if extra:
                if held:
                    yield f(held, text)
                held = []
            else:
                held.append((x, text))
                if len(held) > at_once:
                    yield f(held[:-1], text)
                    held = held[-1:]

    return map_batches(dealt, run, schema_of(schema))


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_edits(rows: list[tuple], following: str, cells: int = CELLS) -> dict:
    """The columns of op5 for rows of (id, text) and the text after them."""
    texts = [t for _, t in rows] + [following]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    n = len(rows)
    sets = [digests(t) for t in texts + changed]
    sketches = Sketches.of(sets, cells)
    strings = sketches.strings([len(x) for x in sets])
    near = compare(sets, [(i, n + 1 + i) for i in range(n)] + [(i, i + 1) for i in range(n)], sketches)
    return {
        "doc_id": [x for x, _ in rows], "n_chars": [len(t) for t in texts[:-1]],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": strings[:n], "edited_fingerprint": strings[n + 1 :], "near_edited": near[:n], "near_next": near[n:],
    }


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return with_next(docs, with_edits, f"doc_id {id_type(docs, 'doc_id')}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
