"""Line dedup: an exact set-similarity join of lines.

A line's words, lower-cased, are a set. The words of a set are ordered by rarity; two sets whose
Jaccard similarity is `threshold` or more share a word within their prefixes. Sets that share one
are candidates if their sizes, the places of that word, the words just before it, and parity
bitmaps allow that it is the first word that both have and that they are so similar. The few sets
that have a candidate are then gathered, word by word, with all their words: the pairs of which it is
the first common word, each of which is met just once, are verified on the whole sets. Pairs are
never rows: a task returns for each of its sets how many lines are similar, the earliest of them, and
the smallest of those that its pairs connect. A line is removed if an earlier line - by doc_id, then
by a hash of the text, then by its number - is that similar to it.

Rarity is counted over all lines in a table of hashed counts of fixed size, or smaller for few words; any order that all
lines share keeps the join exact. Equal sets are one, with the number of their lines. Sets that have
a word that HOT or more lines have are dealt by word and share, cut into chunks of CHUNK sets, and
compared chunk by chunk, over all tasks. Where many sets have a word, those are candidates that have
one more word in common right behind it, as similar sets must, so that groups need not be searched pair by pair.

Words and sets are known by hashes of 64 bits.

Defined results: lines end at line feeds; a line without words is never removed and matches
nothing; a null text has no line; documents of a null id stay as they are and match nothing; rows
that share an id are documents of their own if their texts differ, and one document if they don't;
ids are integers; an empty table gives no rows; other columns are kept (remove_lines) or never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.llm._common import LOWER, RECURRING, BloomFilter, join_by_unique_key, map_batches, materialise, packed_counts, parted, portions, read_table, recurring_places, recurs, schema_of, seen_places, summed_counts, text_hash, texts_of, without
from vaultflow.llm.components import connected_components

THRESHOLD = Fraction(4, 5)
RARITY_BITS = 22
HOT, CHUNK = 8_192, 4_096
#: Sets of a word that are compared only where they also share one of the words that follow, from so many on; and how many of those a row has.
CROWD, _NEXT = 32, 4
#: Places of the table of what recurs in prefixes (16 MB), the finer places by which words are told apart before it is made, and how many
#: of them a task holds before it sends them.
SIFT_BITS, SIFT_FINE, _SIFTED_AT_ONCE = 27, 7, 2_000_000
#: Documents, and bytes of their texts, whose words are held at once; a longer text stands alone.
_AT_ONCE, _BYTES_AT_ONCE = 512, 1 << 21
#: Words of sets that are compared at once, and those of one step of a verification.
_WORDS_AT_ONCE = 1 << 21
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHARE = np.uint64(0xC2B2AE3D27D4EB4F)
_END = b"\xff"  # ends a document's text; is in no UTF-8 text
_IS_BLANK = bytes(b in b"\t\n\x0b\x0c\r \xff" for b in range(256))
_ZERO = np.uint64(0)
#: The first so many bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Words of more bytes are hashed one by one.
_LONG = 256


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of 64 bits of raw[start:end] for each word. Eight bytes of all words at once; raw has eight bytes or more behind the last."""
    eight = np.ndarray(max(0, len(raw) - 7), "<u8", raw, strides=(1,))
    left = end - start
    out = _mixed(left.astype(np.uint64) * _MIX + (eight[start] & _FIRST[np.minimum(left, 8)]))
    more, at = np.flatnonzero((left > 8) & (left <= _LONG)), 8
    while len(more):
        out[more] = _mixed(out[more] * _MIX + (eight[start[more] + at] & _FIRST[np.minimum(left[more] - at, 8)]))
        at += 8
        more = more[left[more] > at]
    for k in np.flatnonzero(left > _LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(raw[start[k] : end[k]].tobytes())
    return _mixed(out * _MIX)


def _sorted_by(line: np.ndarray, lines: int, *then: tuple[np.ndarray, int]) -> np.ndarray:
    """The order of words by line, then by values of so many bits each; by its high bits at once where those tell all apart."""
    left = 64 - max(1, (lines - 1).bit_length())
    key = line.astype(np.uint64) << np.uint64(left)
    for x, bits in then:
        own = min(bits, left)
        left -= own
        key |= (x >> np.uint64(bits - own)) << np.uint64(left)
    order = np.argsort(key, kind="stable")  # lines are in order already
    now = key[order]
    tie = np.flatnonzero(now[1:] == now[:-1])
    if any((x[order[tie]] != x[order[tie + 1]]).any() for x, _ in then):
        return np.lexsort([x for x, _ in reversed(then)] + [line])
    return order


class Sets:
    """Lines with words, as sets: doc (the place of its document), number, size; words, their distinct hashes in ascending order,
    one line after the other; line, that of each word; start, the place of each line's first."""

    def __init__(self, doc: np.ndarray, number: np.ndarray, line: np.ndarray, words: np.ndarray):
        """doc, number: of all lines, with words or not; line: the line of each word."""
        order = _sorted_by(line, len(doc), (words, 64))
        line, words = line[order], words[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (line[1:] != line[:-1])
        line, self.words = line[new], words[new]
        size = np.bincount(line, minlength=len(doc))
        some = np.flatnonzero(size)
        self.doc, self.number, self.size = doc[some], number[some], size[some]
        self.start = np.cumsum(self.size) - self.size
        self.line = np.repeat(np.arange(len(some)), self.size)

    def ids(self) -> np.ndarray:
        """A 64-bit hash of each set."""
        if not len(self.size):
            return np.empty(0, np.int64)
        x = (self.words ^ (self.words >> np.uint64(31))) * _MIX
        x = (x ^ (x >> np.uint64(29))) * _MIX
        return np.add.reduceat(x ^ (x >> np.uint64(32)), self.start).view(np.int64)

    def by_rarity(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of each set in their order by rarity, and how often lines have them."""
        bits = np.uint64(65 - len(counts).bit_length())
        often = counts[(self.words >> bits).astype(np.int64)]
        order = _sorted_by(self.line, len(self.size), (often.astype(np.uint64), 16), (self.words, 64))
        return self.words[order], often[order]


def _words_in(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts in lower case, each with _END behind it and more of them behind the last, and where words start and end."""
    joined = _END.join([*texts, _END * 8])
    blank = np.frombuffer(joined.translate(_IS_BLANK), np.uint8)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.append(0, edge)
    return np.frombuffer(joined.translate(LOWER), np.uint8), edge[::2], edge[1::2]


def line_sets(texts: list[bytes]) -> Sets:
    """The sets of words of all lines of some texts."""
    raw, start, end = _words_in(texts)
    breaks = np.flatnonzero((raw == 10) | (raw == 255))[:-8]
    docs = np.flatnonzero(raw[breaks] == 255) + 1  # lines up to and with each document's last
    of = np.repeat(np.arange(len(docs)), np.diff(docs, prepend=0))
    number = np.arange(len(of)) - np.repeat(np.append(0, docs[:-1])[: len(docs)], np.diff(docs, prepend=0))
    line = np.repeat(np.arange(len(breaks)), np.diff(np.searchsorted(start, breaks), prepend=0))  # of each word; there are fewer breaks to look up
    return Sets(of, number, line, word_hashes(raw, start, end))


def shingle_sets(texts: list[bytes], shingle: int = 5) -> Sets:
    """Of each text one set: its shingles, or of fewer words the whole sequence."""
    raw, start, end = _words_in(texts)
    doc = np.searchsorted(np.flatnonzero(raw == 255), start)
    words, n = word_hashes(raw, start, end), len(start)
    first = np.searchsorted(doc, doc)
    h, at = np.zeros(n, np.uint64), np.arange(n)
    whole = at == first
    for i in range(shingle):
        own = at[: n - i][doc[i:] == doc[: n - i]] if i < n else at[:0]
        h[own] = (h[own] ^ (h[own] >> np.uint64(29))) * _MIX + words[own + i]
        if i == shingle - 1:
            whole[own] = True
    every = np.arange(len(texts))
    return Sets(every, np.zeros(len(texts), np.int64), doc[whole], h[whole])


Make = Callable[[list[bytes]], Sets]


Make = Callable[[list[bytes]], Sets]


def _portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that are of _AT_ONCE texts and _BYTES_AT_ONCE bytes at most, or of one text."""
    ends = np.cumsum(np.asarray(pc.binary_length(texts)), dtype=np.int64)
    i = 0
    while i < len(ends):
        before = int(ends[i - 1]) if i else 0
        j = min(i + _AT_ONCE, max(i + 1, int(np.searchsorted(ends, before + _BYTES_AT_ONCE, side="right"))))
        yield i, j
        i = j


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ver (a hash of the text), text of the rows that have an id."""
    return texts_of(docs, id_col, text_col, text_hash(text_col).alias("ver")).filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "ver", "text")


def _each(b) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """ids, vers and texts of a batch (doc_id, ver, text), a portion at a time."""
    ids, vers, texts = np.asarray(b.column(0)), np.asarray(b.column(1)), b.column(2).cast(pa.binary())
    for i, j in portions(texts, _AT_ONCE, _BYTES_AT_ONCE):
        yield ids[i:j], vers[i:j], texts.slice(i, j - i).to_pylist()


def lines_and_rarity(rows: DataFrame, make: Make = line_sets, bits: int = RARITY_BITS) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(doc, ver, line, line_set of each line with words; doc, ver, inside: the pairs, in both orders, of its lines of equal sets, and of
    each with itself, of each row; in how many lines the words of each hash's place are, up to 65535), from one pass over rows (doc_id, ver, text)."""

    def run(batches):
        total = np.zeros(1 << bits, np.int64)
        for b in batches:
            for ids, vers, texts in _each(b):
                x = make(texts)
                place, lines = np.unique((x.words >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
                total[place] += lines
                own, n, m = x.ids(), len(x.doc), len(ids)
                yield {
                    "kind": np.repeat(np.array([0, 2], np.int8), [n, m]), "a": np.append(ids[x.doc], ids), "ver": np.append(vers[x.doc], vers), "line": np.append(x.number, np.zeros(m, np.int64)),
                    "b": np.append(own, np.bincount(x.doc, _repeats(x, own) ** 2, m).astype(np.int64)), "data": pa.nulls(n + m, pa.binary()),
                }
        for piece, data in packed_counts(total):
            yield {"kind": [1], "a": [piece], "ver": [0], "line": [0], "b": [0], "data": [data]}

    both = materialise(map_batches(rows, run, schema_of("kind tinyint, a bigint, ver bigint, line int, b bigint, data binary")), "lines")
    lines = both.filter("kind = 0").select(F.col("a").alias("doc"), "ver", "line", F.col("b").alias("line_set"))
    of_docs = both.filter("kind = 2").select(F.col("a").alias("doc"), "ver", F.col("b").alias("inside"))
    if not of_docs.groupBy("doc", "ver").count().filter("count > 1").isEmpty():
        lines = lines.distinct()  # rows of equal id and text are one document
    counts = summed_counts(both.filter("kind = 1").select(F.col("a").alias("piece"), "data"), bits)
    while len(counts) > 1 << 12 and np.count_nonzero(counts) < len(counts) // 16:  # few words: a smaller table tells them apart as well
        counts = np.minimum(counts.astype(np.uint32).reshape(-1, 2).sum(1), 65_535).astype(np.uint16)
    return lines, of_docs, counts


#: A word of a set's prefix, its place there, and the two words before it (0: none). place and size end at 65535. next: 16 bits of each word (0: none)
#: behind it among which a similar set's second common word must be, if this is the first; all 0 if those are more than _NEXT, or none must be.
_PREFIX = np.dtype([("word", "<u8"), ("set", "<i8"), ("p0", "<u8"), ("p1", "<u8"), ("before", "<u8"), ("earlier", "<u8"), ("size", "<u2"), ("place", "<u2"), ("next", "<u2", _NEXT)])
_MOST = 65_535


def _parities(words: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set: each says whether an odd number of the set's words have it, so that no more bits differ than words do."""
    if not len(start):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    bit, high = np.uint64(1) << (words & np.uint64(63)), (words & np.uint64(64)) > 0
    return np.bitwise_xor.reduceat(np.where(high, _ZERO, bit), start), np.bitwise_xor.reduceat(np.where(high, bit, _ZERO), start)


def _prefix_length(size: np.ndarray, threshold: Fraction) -> np.ndarray:
    """How many words of a set's order one that is similar to it must share one of; 0 where only equal sets are similar."""
    num, den = threshold.numerator, threshold.denominator
    # The largest set that is similar has den/num of its size; they may differ in (den - num) / (num + den) of both.
    return np.where((den - num) * (size + size * den // num) >= num + den, size - -(-num * size // den) + 1, 0)


def _prefixes(words: np.ndarray, often: np.ndarray, x: Sets, own: np.ndarray, of: np.ndarray, threshold: Fraction, use: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of _PREFIX of the sets for which `of` is true, and where their words lie in words (by rarity). Words that no other
    line has, or for which `use` isn't true, are left out, as are sets too small to be similar to any but their equals."""
    place = np.arange(len(words)) - x.start[x.line]
    length = np.where(of, _prefix_length(x.size, threshold), 0)
    at = np.flatnonzero((place < length[x.line]) & (often > 1) & (True if use is None else use))
    line, place = x.line[at], place[at]
    p = _parities(words, x.start)
    r = np.empty(len(at), _PREFIX)
    r["word"], r["set"], r["p0"], r["p1"] = words[at], own[line], p[0][line], p[1][line]
    r["before"], r["earlier"] = (np.where(place >= k, words[np.maximum(at - k, 0)], _ZERO) for k in (1, 2))
    r["size"], r["place"] = np.minimum(x.size[line], _MOST), np.minimum(place, _MOST)
    # Of least words in common the second is at place length at the latest.
    least = -(-threshold.numerator * x.size[line] // threshold.denominator)
    behind = np.where((least > 1) & (length[line] - place <= _NEXT), length[line] - place, 0)
    for k in range(_NEXT):
        r["next"][:, k] = np.where(k < behind, np.maximum((words[np.minimum(at + k + 1, len(words) - 1)] >> np.uint64(16)) & np.uint64(0xFFFF), np.uint64(1)), _ZERO)
    return r, at


def _dealt(r: np.ndarray, part: np.ndarray, parts: int, kind: int) -> dict:
    part = part.astype(np.min_scalar_type(parts))  # 16 bits are sorted by radix
    order = np.argsort(part, kind="stable")
    ends = np.append(0, np.cumsum(np.bincount(part, minlength=parts)))
    some = np.flatnonzero(np.diff(ends))
    return {"kind": np.full(len(some), kind, np.int8), "part": some, "data": [r[order[ends[k] : ends[k + 1]]].tobytes() for k in some.tolist()]}


def sift(rows: DataFrame, sent: Broadcast, threshold: Fraction, make: Make, bits: int = SIFT_BITS, fine: int = SIFT_FINE) -> np.ndarray:
    """A bitmap of the places of words that the prefixes of two sets or more have; of fixed size, and never wrong about those that do.
    Words are told apart by 2**fine times as many places before, so that it fills up with words that recur, however many do not."""

    def run(batches):
        seen, held, size = set(), [], 0
        for b in batches:
            for _, _, texts in _each(b):
                x = make(texts)
                own = x.ids()
                if len(seen) > 1_000_000:
                    seen.clear()
                new = np.array([s not in seen and not seen.add(s) for s in own.tolist()], bool)
                words, often = x.by_rarity(sent.value)
                place = np.arange(len(words)) - x.start[x.line]
                at = np.flatnonzero(new[x.line] & (place < _prefix_length(x.size, threshold)[x.line]) & (often > 1))
                held.append((words[at] >> np.uint64(64 - bits - fine)).astype(np.int64))
                size += len(at)
                if size > _SIFTED_AT_ONCE:
                    yield seen_places(np.concatenate(held), fine)
                    held, size = [], 0
        if size:
            yield seen_places(np.concatenate(held), fine)

    return recurring_places(map_batches(rows, run, schema_of(RECURRING)), bits, fine)


def prefixes(rows: DataFrame, sent: Broadcast, threshold: Fraction, parts: int, make: Make = line_sets, hot: int = HOT, sifted: Broadcast | None = None) -> DataFrame:
    """kind, part, data: the words of all sets' prefixes, many packed together, dealt into parts by word (kind 0) or, words that
    hot lines or more have, by word and share of its sets (kind 1). Of equal sets a task sends one. sent: the counts; sifted: what sift()
    returned: words that no other prefix has are left out."""

    def run(batches):
        seen, held, size = set(), [], 0

        def out():
            r, often = (np.concatenate(x) for x in zip(*held))
            held.clear()
            is_hot = often >= hot
            # A hot word has as many shares as hot lines fit into its count, not as there are parts: its chunks, and so their pairs, do not grow with parts.
            by = r["word"] + r["set"].view(np.uint64) % (often // hot + 1).astype(np.uint64) * _SHARE
            part = ((by * _MIX) >> np.uint64(33)).astype(np.int64) % parts
            for kind, own in enumerate((~is_hot, is_hot)):
                if own.any():
                    yield _dealt(r[own], part[own], parts, kind)

        for b in batches:
            for _, _, texts in _each(b):
                x = make(texts)
                own = x.ids()
                if len(seen) > 1_000_000:
                    seen.clear()
                new = np.array([s not in seen and not seen.add(s) for s in own.tolist()], bool)
                words, often = x.by_rarity(sent.value)
                r, at = _prefixes(words, often, x, own, new, threshold, None if sifted is None else recurs(sifted.value, words))
                held.append((r, often[at]))
                size += len(r)
                if size > 200_000:
                    yield from out()
                    size = 0
        if size:
            yield from out()

    return map_batches(rows, run, schema_of("kind tinyint, part int, data binary"))


def candidate_pairs(key: np.ndarray, r: np.ndarray, threshold: Fraction, side: np.ndarray | None = None, crowd: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places of rows of _PREFIX of equal key that may be similar and of which the row's word may be the first in common.
    Rows are sorted by key and size. side: 0 pairs with all; 1 and 2 only with each other. crowd: among so many rows of a key or more,
    only pairs that share one of the words that follow, too; a pair may then be met several times."""
    num, den = threshold.numerator, threshold.denominator
    size, place = r["size"].astype(np.int64), r["place"].astype(np.int64)
    p0, p1, before, earlier = (np.ascontiguousarray(r[c]) for c in ("p0", "p1", "before", "earlier"))

    def may(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if side is not None:
            ok = (side[x] == 0) | (side[x] != side[y])
            x, y = x[ok], y[ok]
        # Words in which they may differ, times num + den; sizes that end at _MOST tell nothing.
        room = np.where(size[y] < _MOST, (den - num) * (size[x] + size[y]), 1 << 60)
        # Words before the first that both have are of one set only, so none of them is equal.
        u, v, s, t = before[x], before[y], earlier[x], earlier[y]
        ok = ((num + den) * (place[x] + place[y]) <= room) & ((u == _ZERO) | ((u != v) & (u != t))) & ((s == _ZERO) | ((s != v) & (s != t)))
        x, y, room = x[ok], y[ok], room[ok]
        ok = (num + den) * (np.bitwise_count(p0[x] ^ p0[y]).astype(np.int64) + np.bitwise_count(p1[x] ^ p1[y])) <= room
        return x[ok], y[ok]

    def ahead(a: np.ndarray, key: np.ndarray, row: np.ndarray | None = None):
        """Of places a, in ascending order, each with those behind it of equal key; row: what row a place is of, if not of its own."""
        own, d = size if row is None else size[row], 0
        while True:
            d += 1
            a = a[: np.searchsorted(a, len(key) - d)]
            a = a[(key[a] == key[a + d]) & (num * own[a + d] <= den * own[a])]  # once beyond, always beyond
            if not len(a):
                return
            x, y = may(a, a + d) if row is None else may(row[a], row[a + d])
            if len(x):
                yield x, y

    if crowd is None or not len(key):
        yield from ahead(np.arange(len(key)), key)
        return
    group = np.cumsum(np.append(False, key[1:] != key[:-1]))
    crowded = np.bincount(group)[group] >= crowd
    told = crowded & (r["next"] > 0).any(1)
    yield from ahead(np.flatnonzero(~told), key)  # rows that tell nothing, or of few, with all behind them
    if not told.any():
        return
    # Those of which another one before tells something.
    rest, d = np.flatnonzero(crowded & ~told), 0
    while len(rest):
        d += 1
        rest = rest[rest >= d]
        rest = rest[(key[rest] == key[rest - d]) & (num * size[rest] <= den * size[rest - d])]
        x, y = may(*(z[told[rest - d]] for z in (rest - d, rest)))
        if len(x):
            yield x, y
    at = np.flatnonzero(told)
    following = r["next"][at].astype(np.int64)
    row, n = np.nonzero(following)
    of = (group[at[row]] << 16) | following[row, n]
    order = np.argsort(of, kind="stable")  # rows of a key are in order of size already
    of, row = of[order], at[row[order]]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (row[1:] != row[:-1])  # two words that follow may have the same bits
    yield from ahead(np.arange(int(new.sum())), of[new], row[new])


def _in_common(number: np.ndarray, start: np.ndarray, x: np.ndarray, nx: np.ndarray, y: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """How many of the first nx words of set x the first ny words of set y have, for each pair. number: of each word, by value."""
    out = np.zeros(len(x), np.int64)
    ends, i = np.cumsum(nx + ny), 0
    while i < len(x):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + _WORDS_AT_ONCE, side="right")))
        n = np.concatenate([nx[i:j], ny[i:j]])
        first = np.concatenate([start[x[i:j]], start[y[i:j]]])
        of = np.repeat(np.tile(np.arange(j - i), 2), n)
        at = np.arange(len(of)) + np.repeat(first - (np.cumsum(n) - n), n)
        both = (of << 32) | number[at]
        both.sort()
        out[i:j] = np.bincount(both[1:][both[1:] == both[:-1]] >> 32, minlength=j - i)
        i = j
    return out


def similar_pairs(key: np.ndarray, r: np.ndarray, place: np.ndarray, own: np.ndarray, words: np.ndarray, start: np.ndarray, size: np.ndarray, threshold: Fraction, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets, each once: those whose similarity is threshold or more and of which the word of two rows of equal key is the
    first in common. place, own: each row's place in its set's prefix, and its set; words: of all sets, each by rarity."""
    num, den = threshold.numerator, threshold.denominator
    held, n, number = [], 0, None
    order = np.lexsort((r["size"], key))
    key, r, place, own = key[order], r[order], place[order], own[order]
    side = None if side is None else side[order]

    def verified():
        nonlocal number
        if number is None:
            number = np.unique(words, return_inverse=True)[1]
        a, b = (np.concatenate(z) for z in zip(*held))
        held.clear()
        first = _in_common(number, start, own[a], place[a], own[b], place[b]) == 0
        x, y = own[a[first]], own[b[first]]
        ok = (num + den) * _in_common(number, start, x, size[x], y, size[y]) >= num * (size[x] + size[y])
        return x[ok], y[ok]

    for a, b in candidate_pairs(key, r, threshold, side):
        held.append((a, b))
        n += len(a)
        if n > 100_000:
            yield verified()
            n = 0
    if held:
        yield verified()


def _repeats(x: Sets, own: np.ndarray) -> np.ndarray:
    """How many lines of its document are of each line's set, at the first of them; at others 0."""
    out = np.zeros(len(own), np.int64)
    if len(own):
        order = np.lexsort((own, x.doc))
        starts = np.append(0, np.flatnonzero((own[order][1:] != own[order][:-1]) | (x.doc[order][1:] != x.doc[order][:-1])) + 1)
        out[order[starts]] = np.diff(np.append(starts, len(own)))
    return out


def _inside(x: Sets, own: np.ndarray, docs: int, words: np.ndarray, often: np.ndarray, of: np.ndarray, threshold: Fraction) -> np.ndarray:
    """For each document the pairs (in both orders) of its lines whose different sets are similar, among the lines for which `of` is true."""
    out, c = np.zeros(docs, np.int64), _repeats(x, own)
    r, at = _prefixes(words, often, x, own, of & (c > 0), threshold)
    line = x.line[at]
    key = _mixed(r["word"] * _MIX + x.doc[line].astype(np.uint64))
    for a, b in similar_pairs(key, r, at - x.start[line], line, words, x.start, x.size, threshold):
        np.add.at(out, x.doc[a], 2 * c[a] * c[b])
    return out


def _asks(threshold: Fraction, chunk: int):
    """Packed prefixes, whole parts, to (kind 0: key, a word; line_set) of sets that have a candidate of the word, and (kind 1: key; lo, hi,
    the sizes there; data) chunks of sets of a word that many lines have."""

    def run(batches):
        held: dict[int, list] = {0: [], 1: []}
        for b in batches:
            for kind, x in zip(b.column(0).to_pylist(), b.column(2)):
                held[kind].append(np.frombuffer(x.as_buffer(), _PREFIX))
        for kind, of in held.items():
            if not of:
                continue
            r = np.concatenate(of)
            of.clear()
            r = r[np.lexsort((r["set"], r["size"], r["word"]))]
            new = np.ones(len(r), bool)  # several tasks may have sent a set
            new[1:] = (r["word"][1:] != r["word"][:-1]) | (r["set"][1:] != r["set"][:-1])
            r = r[new]
            word = np.ascontiguousarray(r["word"])
            if kind:
                starts = np.append(0, np.flatnonzero(word[1:] != word[:-1]) + 1)
                for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(r)]):
                    for i in range(s, e, chunk):
                        x = r[i : min(i + chunk, e)]
                        yield {"kind": [1], "key": [x["word"][0].view(np.int64)], "line_set": [0], "lo": [x["size"][0]], "hi": [x["size"][-1]], "data": [x.tobytes()]}
                continue
            mark = np.zeros(len(r), bool)
            for a, b in candidate_pairs(word, r, threshold, None, CROWD):
                mark[a] = mark[b] = True
            at = np.flatnonzero(mark)
            n = len(at)
            yield {"kind": np.zeros(n, np.int8), "key": word[at].view(np.int64), "line_set": r["set"][at], "lo": np.zeros(n, np.int32), "hi": np.zeros(n, np.int32), "data": pa.nulls(n, pa.binary())}

    return run


def asked(packed: DataFrame, threshold: Fraction, chunk: int = CHUNK) -> DataFrame:
    """key, word, side, line_set: the sets that have a candidate, for each word, or pair of chunks of a word, of which they have it."""
    num, den = threshold.numerator, threshold.denominator
    out = map_batches(packed.repartition("part"), _asks(threshold, chunk), schema_of("kind tinyint, key bigint, line_set bigint, lo int, hi int, data binary"))
    out = materialise(out, "asks")
    asks = out.filter("kind = 0").select("key", F.col("key").alias("word"), F.lit(0).cast("tinyint").alias("side"), "line_set")
    chunks = out.filter("kind = 1")
    if chunks.isEmpty():
        return asks
    chunks = materialise(chunks.select(F.col("key").alias("word"), F.xxhash64("key", "data").alias("chunk"), "lo", "hi", "data"), "chunks")
    a, b = (chunks.select("word", *(F.col(c).alias(f"{c}_{x}") for c in ("chunk", "lo", "hi"))) for x in "ab")
    pairs = a.join(b, "word").filter((F.col("chunk_a") <= F.col("chunk_b")) & (num * F.col("lo_a") <= den * F.col("hi_b")) & (num * F.col("lo_b") <= den * F.col("hi_a")))
    pairs = materialise(pairs.select("word", "chunk_a", "chunk_b", F.xxhash64("word", "chunk_a", "chunk_b").alias("key")), "chunk_pairs")
    alone = F.col("chunk_a") == F.col("chunk_b")
    sides = pairs.select("key", F.col("chunk_a").alias("chunk"), F.when(alone, 0).otherwise(1).cast("tinyint").alias("side")).union(pairs.filter(~alone).select("key", "chunk_b", F.lit(2).cast("tinyint")))
    both = sides.join(chunks.select("chunk", "word", "data"), "chunk").select("key", "word", "side", "data")

    def run(batches):
        for key, word, side, r in _pair_by_pair(batches):
            order = np.argsort(r["size"], kind="stable")
            r, side = r[order], side[order]
            mark = np.zeros(len(r), bool)
            for x, y in candidate_pairs(np.zeros(len(r), np.int64), r, threshold, side, CROWD):
                mark[x] = mark[y] = True
            at = np.flatnonzero(mark)
            yield {"key": np.full(len(at), key), "word": np.full(len(at), word), "side": side[at], "line_set": r["set"][at]}

    dealt = both.repartition("key").sortWithinPartitions("key")
    return asks.unionByName(materialise(map_batches(dealt, run, schema_of("key bigint, word bigint, side tinyint, line_set bigint")), "asks"))


def _pair_by_pair(batches):
    """(key, word, side of each row, rows of _PREFIX) of each pair of chunks; rows (key, word, side, data) are in order."""
    now, word, held = None, None, []
    for b in batches:
        for key, w, side, data in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(3)):
            if held and key != now:
                yield now, word, np.concatenate([s for s, _ in held]), np.concatenate([r for _, r in held])
                held = []
            now, word, r = key, w, np.frombuffer(data.as_buffer(), _PREFIX)
            held.append((np.full(len(r), side, np.int8), r))
    if held:
        yield now, word, np.concatenate([s for s, _ in held]), np.concatenate([r for _, r in held])


def words_of_sets(rows: DataFrame, lines: DataFrame, wanted: DataFrame, sent: Broadcast, threshold: Fraction, make: Make = line_sets) -> tuple[DataFrame, DataFrame]:
    """(line_set, words: by rarity, packed; of the sets in wanted (line_set); doc, ver, inside: the pairs, in both orders, of its lines of
    different wanted sets that are similar, where there are any). Bloom filters of fixed size say which documents are read and which
    sets are sent; a join leaves no doubt."""
    sc = rows.sparkSession.sparkContext
    asked = sc.broadcast(BloomFilter.of(wanted))

    def holders(batches):
        for b in batches:
            yield {"at": np.unique(np.asarray(b.column(0))[asked.value.may_hold(np.asarray(b.column(1)))])}

    found_in = sc.broadcast(BloomFilter.of(map_batches(lines.select(F.xxhash64("doc", "ver"), "line_set"), holders, schema_of("at bigint"))))

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            for ids, vers, texts in _each(b.filter(pa.array(found_in.value.may_hold(np.asarray(b.column(3)))))):
                x = make(texts)
                own = x.ids()
                hit = asked.value.may_hold(own)
                words, often = x.by_rarity(sent.value)
                inside = _inside(x, own, len(ids), words, often, hit, threshold)
                d, ends = np.flatnonzero(inside), x.start + x.size
                new = [k for k, s in zip(np.flatnonzero(hit).tolist(), own[hit].tolist()) if s not in seen and not seen.add(s)]
                n, m = len(new), len(d)
                yield {
                    "kind": np.repeat(np.array([0, 1], np.int8), [n, m]), "a": np.append(own[new], ids[d]), "ver": np.append(np.zeros(n, np.int64), vers[d]), "inside": np.append(np.zeros(n, np.int64), inside[d]),
                    "words": [words[x.start[k] : ends[k]].tobytes() for k in new] + [None] * m,
                }

    both = map_batches(rows.withColumn("key", F.xxhash64("doc_id", "ver")), run, schema_of("kind tinyint, a bigint, ver bigint, inside bigint, words binary"))
    both = materialise(both, "words")
    asked.destroy()
    found_in.destroy()
    words = both.filter("kind = 0").select(F.col("a").alias("line_set"), "words").join(wanted, "line_set", "left_semi")
    inside = both.filter("kind = 1").groupBy(F.col("a").alias("doc"), "ver").agg(F.max("inside").alias("more_inside"))  # of repeated rows one
    return words.groupBy("line_set").agg(F.first("words").alias("words")), inside


def _linked(threshold: Fraction):
    """Rows (key, word, side, line_set, words, n, doc, ver, line), in order of key, to line_set, more (how many lines have sets that
    are similar to it), the earliest of their (doc, ver, line), and root: the doc of the earliest set that pairs connect it to."""

    def of(rows: list[tuple]) -> dict:
        rows.sort(key=lambda x: x[6:])  # a row's place tells how early its set is
        key, word, side, own, words, n, doc, ver, line = zip(*rows)
        flat = np.frombuffer(b"".join(words), np.uint64)
        size = np.array([len(x) // 8 for x in words], np.int64)
        start = np.cumsum(size) - size
        key, word, side, own, n, doc, ver, line = (np.array(x) for x in (key, word, side, own, n, doc, ver, line))
        at = np.flatnonzero(flat == np.repeat(word.view(np.uint64), size))  # of distinct words one in each set
        place = at - start
        r = np.empty(len(rows), _PREFIX)
        r["size"], r["place"] = np.minimum(size, _MOST), np.minimum(place, _MOST)
        r["p0"], r["p1"] = _parities(flat, start)
        r["before"], r["earlier"] = (np.where(place >= k, flat[np.maximum(at - k, 0)], _ZERO) for k in (1, 2))
        more, link, root = np.zeros(len(rows), np.int64), np.full(len(rows), len(rows)), np.arange(len(rows))
        for x, y in similar_pairs(key, r, place, np.arange(len(rows)), flat, start, size, threshold, side):
            np.add.at(more, x, n[y])
            np.add.at(more, y, n[x])
            np.minimum.at(link, x, y)
            np.minimum.at(link, y, x)
            while ((a := root[x]) != (b := root[y])).any():
                least = np.minimum(a, b)
                np.minimum.at(root, a, least)
                np.minimum.at(root, b, least)
                while ((up := root[root]) != root).any():
                    root = up
        some = np.flatnonzero(more)
        first = link[some]
        return {"line_set": own[some], "more": more[some], "doc": doc[first], "ver": ver[first], "line": line[first], "own": doc[some], "root": doc[root[some]]}

    def run(batches):
        held, words = [], 0
        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
            for row in zip(*columns):
                if words > _WORDS_AT_ONCE and row[0] != held[-1][0]:
                    yield of(held)
                    held, words = [], 0
                held.append(row)
                words += len(row[4]) // 8
        if held:
            yield of(held)

    return run


def links(rows: DataFrame, lines: DataFrame, counts: np.ndarray, threshold: Fraction, make: Make, hot: int, chunk: int, sifting: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(line_set, n, first, links, match: of each set the number and the earliest (doc, ver, line) of its lines, how many lines are similar,
    equal ones included, and the earliest of those; a, b: docs, enough to connect all that have similar sets of different words;
    doc, ver, more_inside as of words_of_sets). sifting: one pass more over rows, to send only words that recur in prefixes; it
    changes no result."""
    spark = rows.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = materialise(lines.groupBy("line_set").agg(F.min(F.struct("doc", "ver", "line")).alias("first"), F.count(F.lit(1)).alias("n")), "sets")
    sent = spark.sparkContext.broadcast(counts)
    sifted = spark.sparkContext.broadcast(sift(rows, sent, threshold, make)) if sifting else None
    asks = materialise(asked(prefixes(rows, sent, threshold, parts, make, hot, sifted), threshold, chunk), "asked")
    if sifted is not None:
        sifted.destroy()
    wanted = materialise(asks.select("line_set").distinct(), "wanted")
    words, inside = words_of_sets(rows, lines, wanted, sent, threshold, make)
    sent.destroy()  # what it went into is written
    known = words.join(sets, "line_set").select("line_set", "words", "n", "first.*")
    every = asks.join(materialise(known, "known"), "line_set").select("key", "word", "side", "line_set", "words", "n", "doc", "ver", "line")
    found = map_batches(every.repartition("key").sortWithinPartitions("key"), _linked(threshold), schema_of("line_set bigint, more bigint, doc bigint, ver bigint, line int, own bigint, root bigint"))
    found = materialise(found, "linked")
    others = found.groupBy("line_set").agg(F.sum("more").alias("more"), F.min(F.struct("doc", "ver", "line")).alias("link"))
    all_ = sets.join(others, "line_set", "left").select("line_set", "n", "first", (F.col("n") + F.coalesce("more", F.lit(0))).alias("links"), F.least("first", "link").alias("match"))
    return materialise(all_, "links"), found.select(F.col("own").alias("a"), F.col("root").alias("b")), inside


def _matched(lines: DataFrame, sets: DataFrame, *more: str) -> DataFrame:
    out = join_by_unique_key(lines, sets.select("line_set", "n", "match", *more), "line_set", "n")
    later = F.struct("doc", "ver", "line") > F.col("match")
    return out.select("doc", "ver", "line", *(F.when(later, F.col(f"match.{c}")).alias(f"match_{c}") for c in ("doc", "line")), *more)


def duplicate_lines(docs: DataFrame, threshold: Fraction = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", make: Make = line_sets, rarity_bits: int = RARITY_BITS, hot: int = HOT, chunk: int = CHUNK, sifting: bool = False) -> DataFrame:
    """doc, ver, line, match_doc, match_line: for each line with words, the earliest line that is similar to it, or nulls. ver is the text's hash."""
    rows = numbered(docs, id_col, text_col)
    lines, _, counts = lines_and_rarity(rows, make, rarity_bits)
    return _matched(lines, links(rows, lines, counts, threshold, make, hot, chunk, sifting)[0])


def remove_lines(docs: DataFrame, threshold: Fraction = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", drop_empty: bool = True, **how) -> DataFrame:
    """docs, all columns, without the lines that repeat earlier ones; with drop_empty, documents all of
    whose lines with words go are dropped. Only documents that lose lines are shuffled."""
    found = duplicate_lines(docs, threshold, id_col, text_col, **how)
    lost = F.collect_list(F.when(F.col("match_doc").isNotNull(), F.col("line")))
    names, text = docs.columns, docs.columns.index(text_col)
    gone = found.groupBy("doc", "ver").agg(F.count(F.lit(1)).alias("every"), lost.alias("lines"))
    gone = materialise(gone.filter(F.size("lines") > 0), "gone")
    rest, touched = parted(docs, gone, id_col, text_col)

    def cut(batches):
        n = len(names)
        for b in batches:
            texts, keep = [], []
            for t, every, lines in zip(*(b.column(i).to_pylist() for i in (text, n, n + 1))):
                if lines and t is not None:
                    own = set(lines)
                    t = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in own)
                texts.append(t)
                keep.append(not (drop_empty and lines and every == len(lines)))
            out = [pa.array(texts, pa.string()) if i == text else b.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays(out, names=names).filter(pa.array(keep, pa.bool_()))

    return rest.unionByName(touched.mapInArrow(cut, docs.schema))


def drop_similar(docs: DataFrame, threshold: Fraction = THRESHOLD, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs, all columns, without the documents to which an earlier one is similar: the Jaccard similarity of their sets of
    shingles, verified on whole sets, is threshold or more. Documents without words and those of null id stay."""
    found = duplicate_lines(docs, threshold, id_col, text_col, partial(shingle_sets, shingle=shingle), **({"sifting": True} | how))
    return without(docs, materialise(found.filter(F.col("match_doc").isNotNull()).select("doc", "ver"), "similar"), id_col, text_col)


def all_links(docs: DataFrame, threshold: Fraction = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", rarity_bits: int = RARITY_BITS, hot: int = HOT, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc, ver, line, match_doc, match_line as of duplicate_lines, and links: the lines of all documents, its own too, that are similar
    to the line, itself included; a, b: docs, enough to connect all documents of which lines are similar; doc, ver, inside: of each
    row with an id those of its lines' links that are within it)."""
    rows = numbered(docs, id_col, text_col)
    lines, of_docs, counts = lines_and_rarity(rows, line_sets, rarity_bits)
    sets, edges, inside = links(rows, lines, counts, threshold, line_sets, hot, chunk)
    sets = sets.withColumn("first_doc", F.col("first.doc"))
    found = materialise(_matched(lines, sets, "links", "first_doc"), "matched")
    return found.drop("first_doc"), edges.union(found.select("doc", "first_doc")).filter("a <> b"), of_docs.join(inside, ["doc", "ver"], "left").select("doc", "ver", (F.col("inside") + F.coalesce("more_inside", F.lit(0))).alias("inside"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines (with words), n_removed, n_links (all pairs of a line of the document and a similar line of another one),
    class_id (the smallest doc_id that chains of such pairs reach), removed (the removed lines' numbers, joined by commas)."""
    docs = read_table(spark, sf_dir, "documents")
    found, edges, rows = all_links(docs)
    roots = connected_components(edges).select(F.col("node").alias("doc"), F.col("root").alias("least"))
    gone = F.col("match_doc").isNotNull()
    per_doc = found.groupBy("doc", "ver").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(gone.cast("long")).alias("n_removed"), F.sum("links").alias("links"),
        F.sort_array(F.collect_list(F.when(gone, F.col("line")))).alias("removed"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    out = rows.join(per_doc, ["doc", "ver"], "left").join(roots, "doc", "left").withColumn("n_links", F.col("links") - F.col("inside")).select(
        F.col("doc").cast(docs.schema["doc_id"].dataType).alias("doc_id"), zero("n_lines"), zero("n_removed"), zero("n_links"), F.coalesce("least", "doc").alias("class_id"),
        F.coalesce(F.concat_ws(",", F.col("removed").cast("array<string>")), F.lit("")).alias("removed"),
    )
    none = F.lit(0).cast("long")
    return out.union(docs.filter(F.col("doc_id").isNull()).select("doc_id", none, none, none, F.lit(None).cast("long"), F.lit("")))
