"""Benchmark decontamination: suffix arrays over shards of the training documents, in which every
suffix of a test item is found by binary search, give the longest verbatim matches and where they
are; documents that hold a window of an item are removed.

A shard is a run of whole documents. Its suffix array keeps the suffixes that begin with some
k-gram of the test items (all others match nothing), sorted by their first `window` words. Every
suffix of an item that is a window or longer is searched there; where it is found, matches are
carried on word by word to the longest. Equal beginnings of suffixes are searched once. Test items
go out by broadcast in blocks of at most BLOCK_WORDS words, one after the other; with more than one
block what is found so far is written between them, so that one block is out at a time.

Defined results: null texts have no words, so neither hits nor windows; a null item_id counts as
the empty string; repeated documents are treated row by row, repeated items as one; an empty
benchmark hits nothing; other columns are never read.
"""

from __future__ import annotations

import hashlib
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.llm._common import LOWER_ALNUM, id_type, map_batches, materialise, portions, read_table, schema_of, texts_of

WINDOW = 10
BLOCK_WORDS = 1_000_000
#: Documents of a shard, and bytes of their texts; a longer text is a shard of its own.
SHARD_ROWS, SHARD_BYTES = 4096, 8 << 20
_TABLE_BITS = 22
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LOWER_ALNUM).split()


class TestBlock:
    """Items as word numbers: their windows with the items of each, and all their suffixes."""

    __test__ = False

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        coded = [(i, np.array([number.setdefault(w, len(number) + 1) for w in ws], np.uint32)) for i, ws in items if ws]
        owners: dict[bytes, set[str]] = {}
        places: dict[bytes, list[int]] = {}
        first = 0
        self.names, self.firsts = [i for i, _ in coded], []
        for i, x in coded:
            n = min(window, len(x))
            self.firsts.append(first)
            for p in range(len(x) - n + 1):
                key = x[p : p + n].astype(">u4").tobytes()
                owners.setdefault(key, set()).add(i)
                places.setdefault(key, []).append(first + p)
            first += len(x) + 1
        keys = sorted(owners)
        #: All items, a gap behind each, and where in them each window stands.
        self.flat = np.concatenate([y for _, x in coded for y in (x, np.zeros(1, np.uint32))] + [np.zeros(1, np.uint32)])
        self.firsts = np.array(self.firsts, np.int64)
        self.places = [np.array(places[k], np.int64) for k in keys]
        self.lengths = np.array([len(k) // 4 for k in keys], np.int64)
        self.low = np.array(keys, f"S{4 * window}")
        self.high = np.array([k.ljust(4 * window, b"\xff") for k in keys], f"S{4 * window}")
        self.items = [sorted(owners[k]) for k in keys]
        self.k = min([3, *self.lengths.tolist()])
        self.starts = np.zeros(1 << _TABLE_BITS, bool)
        self.suffixes = coded
        for _, x in coded:
            self.starts[_grams(x, self.k)] = True


def _grams(x: np.ndarray, k: int) -> np.ndarray:
    n = max(0, len(x) - k + 1)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = (h ^ x[i : i + n].astype(np.uint64)) * _MIX[i]
    return (h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


class Shard:
    """The suffix array of some texts, as far as a block of test items can match it."""

    def __init__(self, texts: list[str], block: TestBlock):
        get = block.vocabulary.get
        coded = []
        for t in texts:
            ws = words_of(t)
            coded.append(np.fromiter(map(get, ws, repeat(0)), np.uint32, len(ws)))
        self.n_words = np.array([len(x) for x in coded], np.int64)
        gap = np.zeros(1, np.uint32)  # no match runs over the end of a document
        self.words = np.concatenate([y for x in coded for y in (x, gap)] + [np.zeros(block.window, np.uint32)])
        self.first = np.concatenate([[0], np.cumsum(self.n_words + 1)])
        at = np.flatnonzero(block.starts[_grams(self.words, block.k)])
        at = at[self.words[at] > 0]
        rows = np.ascontiguousarray(self.words[np.minimum(at[:, None] + np.arange(block.window), len(self.words) - 1)].astype(">u4"))
        keys = rows.view(f"S{4 * block.window}").ravel()
        order = np.argsort(keys, kind="stable")
        self.suffixes, self.keys = at[order], keys[order]

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1


class Hits(NamedTuple):
    """What a shard holds of a block: hit intervals (document, start, end, in words from the document's first), the items of each
    document, and of each document that is hit the longest match: (words, item, start in the item, start in the document)."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    items: list[set[str]]
    longest: dict[int, tuple[int, str, int, int]]


def hits(shard: Shard, block: TestBlock) -> Hits:
    items: list[set[str]] = [set() for _ in shard.n_words]
    lo = np.searchsorted(shard.keys, block.low, side="left")
    hi = np.searchsorted(shard.keys, block.high, side="right")
    cover = np.zeros(len(shard.words) + 1, np.int32)
    longest: dict[int, tuple[int, str, int, int]] = {}
    for w in np.flatnonzero(hi > lo).tolist():
        at = shard.suffixes[lo[w] : hi[w]]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + block.lengths[w], -1)
        doc = shard.doc_of(at)
        for d in np.unique(doc).tolist():
            items[d].update(block.items[w])
        for p in block.places[w].tolist():
            _carry_on(shard, block, at, doc, p, int(block.lengths[w]), longest)
    hit = np.diff((np.cumsum(cover) > 0).astype(np.int8), prepend=0)
    start, end = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
    doc = shard.doc_of(start)
    return Hits(doc, start - shard.first[doc], end - shard.first[doc], items, longest)


def _carry_on(shard: Shard, block: TestBlock, at: np.ndarray, doc: np.ndarray, p: int, n: int, longest: dict) -> None:
    """Carries matches of n words, of the items at p and the shard at each of at, on to the longest, and keeps each document's best."""
    before = block.flat[p - 1] if p else 0
    if before:  # a match that goes on to the left is carried on from there
        there = shard.words[at - 1] != before
        there |= at == shard.first[doc]
        at, doc = at[there], doc[there]
    length, going = np.full(len(at), n), np.arange(len(at))
    while len(going):
        x = block.flat[p + length[going]]
        going = going[(x > 0) & (shard.words[at[going] + length[going]] == x)]
        length[going] += 1
    item = int(np.searchsorted(block.firsts, p, side="right")) - 1
    for d, m, a in zip(doc.tolist(), length.tolist(), at.tolist()):
        found = (m, block.names[item], p - int(block.firsts[item]), a - int(shard.first[d]))
        if d not in longest or _better(found, longest[d]):
            longest[d] = found


def _better(a: tuple, b: tuple) -> bool:
    """The longer match; of equal ones the first by item, place there and place in the document."""
    return (-a[0], *a[1:]) < (-b[0], *b[1:])


def test_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, id_col: str = "item_id", text_col: str = "text"):
    """The stated test items, block by block; no block has many more than block_words words."""
    items, n = [], 0
    for r in texts_of(benchmark, id_col, text_col).toLocalIterator():
        ws = words_of(r["text"])
        items.append(("" if r["doc_id"] is None else str(r["doc_id"]), ws))
        n += len(ws)
        if n >= block_words:
            yield TestBlock(items, window)
            items, n = [], 0
    if items:
        yield TestBlock(items, window)


test_blocks.__test__ = False


_FOUND = "n_words bigint, spans array<bigint>, items array<string>, longest bigint, longest_item string, longest_item_start bigint, longest_start bigint"


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, spans (hit words: start, end, start, ..., from each block of items), items (ids found), and the longest verbatim
    match of a window or more: longest (words; 0: none), longest_item, longest_item_start, longest_start (in words; null: none)."""
    names = [x.split(" ")[0] for x in _FOUND.split(", ")]
    kind = id_type(docs, id_col)
    now = texts_of(docs, id_col, text_col)
    blocks = test_blocks(benchmark, window, block_words, item_id_col, item_text_col)
    block = next(blocks, None)
    while True:
        after = next(blocks, None)
        sent, last = docs.sparkSession.sparkContext.broadcast(block), after is None

        def run(batches, sent=sent, last=last):
            for b in batches:
                for i, j in portions(b.column(1), SHARD_ROWS, SHARD_BYTES):
                    part = b.slice(i, j - i)
                    texts = part.column(1).to_pylist()
                    out = dict(zip(names, [c.to_pylist() for c in part.columns[2:]])) or {c: [[] if c in ("spans", "items") else 0 if c == "longest" else None for _ in texts] for c in names}
                    if sent.value is None:
                        out["n_words"] = [len(words_of(t)) for t in texts]
                    else:
                        shard = Shard(texts, sent.value)
                        h, out["n_words"] = hits(shard, sent.value), shard.n_words
                        for d, s, e in zip(h.doc.tolist(), h.start.tolist(), h.end.tolist()):
                            out["spans"][d] += (s, e)
                        out["items"] = [sorted({*x, *y}) for x, y in zip(out["items"], h.items)]
                        for d, x in h.longest.items():
                            if not out["longest"][d] or _better(x, tuple(out[c][d] for c in names[3:])):
                                for c, v in zip(names[3:], x):
                                    out[c][d] = v
                    yield {"doc_id": part.column(0), **({} if last else {"text": part.column(1)}), **out}

        now = map_batches(now, run, schema_of(f"doc_id {kind}, " + "text string, " * (not last) + _FOUND))
        if last:
            return now
        now, block = materialise(now, "found"), after
        sent.destroy()


def n_hit(spans: list[int]) -> int:
    """Words in the union of spans."""
    last = total = 0
    for s, e in sorted(zip(spans[::2], spans[1::2])):
        total += max(0, e - max(s, last))
        last = max(last, e)
    return total


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs, all columns, without the rows in which a window of an item occurs."""
    k = docs.columns.index(text_col)
    blocks = test_blocks(benchmark, window, block_words, item_id_col, item_text_col)
    block = next(blocks, None)
    while block is not None:
        after = next(blocks, None)
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            for b in batches:
                for i, j in portions(b.column(k), SHARD_ROWS, SHARD_BYTES):
                    part = b.slice(i, j - i)
                    clean = np.ones(j - i, bool)
                    clean[hits(Shard([t or "" for t in part.column(k).to_pylist()], sent.value), sent.value).doc] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
        if after is not None:
            docs = materialise(docs, "clean")
            sent.destroy()
        block = after
    return docs


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = 5, window: int = WINDOW, block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, item_start, doc_id, doc_start, n_words: for every suffix of every item its longest
    verbatim match of at least `least` words in any document, and one place of it (of the least doc_id)."""
    sc = docs.sparkSession.sparkContext
    sent = [sc.broadcast(b) for b in test_blocks(benchmark, window, block_words, item_id_col, item_text_col)]

    def run(batches):
        for b, (at, to) in ((b, x) for b in batches for x in portions(b.column(1), SHARD_ROWS, SHARD_BYTES)):
            ids, texts = b.column(0).slice(at, to - at).to_pylist(), b.column(1).slice(at, to - at).to_pylist()
            for held in sent:
                block = held.value
                shard, rows = Shard(texts, block), []
                for item, x in block.suffixes:
                    for p in range(len(x)):
                        rows += _longest(shard, block, item, x, p, least, ids)
                yield dict(zip(("item_id", "item_start", "doc_id", "doc_start", "n_words"), zip(*rows) if rows else [()] * 5))

    found = map_batches(texts_of(docs, id_col, text_col), run, schema_of(f"item_id string, item_start bigint, doc_id {id_type(docs, id_col)}, doc_start bigint, n_words bigint"))
    best = F.min_by(F.struct("doc_id", "doc_start", "n_words"), F.struct(-F.col("n_words"), F.col("doc_id"), F.col("doc_start")))
    return found.groupBy("item_id", "item_start").agg(best.alias("m")).select("item_id", "item_start", "m.doc_id", "m.doc_start", "m.n_words")


def _longest(shard: Shard, block: TestBlock, item: str, x: np.ndarray, p: int, least: int, ids: list) -> list[tuple]:
    key = x[p : p + block.window].astype(">u4").tobytes()
    lo = int(np.searchsorted(shard.keys, key, side="left"))
    hi = int(np.searchsorted(shard.keys, key.ljust(4 * block.window, b"\xff"), side="right"))
    best, out = least - 1, []
    for i in range(lo, hi) if hi > lo else (lo - 1, lo):  # the neighbours of its place share the longest prefix
        if 0 <= i < len(shard.keys):
            n, at = 0, int(shard.suffixes[i])
            while p + n < len(x) and shard.words[at + n] == x[p + n]:
                n += 1
            if n > best:
                best, d = n, int(shard.doc_of(np.array([at]))[0])
                out = [(item, p, ids[d], at - int(shard.first[d]), n)]
    return out


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    more = ("longest", "longest_item", "longest_item_start", "longest_start")

    def run(batches):
        for b in batches:
            n = [n_hit(x) for x in b.column(2).to_pylist()]
            items = b.column(3).to_pylist()
            yield {
                "doc_id": b.column(0), "n_words": b.column(1), "n_hit": n, "n_items": [len(x) for x in items],
                "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], "contaminated": [x > 0 for x in n],
                **{c: b.column(4 + i) for i, c in enumerate(more)},
            }

    kind = found.schema["doc_id"].dataType.simpleString()
    return map_batches(found, run, schema_of(f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, longest bigint, longest_item string, longest_item_start bigint, longest_start bigint"))
