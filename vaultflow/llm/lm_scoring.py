"""LM scoring: a probabilistic suffix tree over words.

Contexts are up to `depth` words. A context is kept if its distribution of next tokens diverges from
that of its longest proper suffix by at least `divergence` nats a token; suffixes of kept contexts
are kept too. Sequences that occur LEAST times or more in the training tokens count, however large
the input; what a context gives to rarer next tokens goes to its parent. A context's
distribution is smoothed by its parent's, and the root's by absolute discounting, with the
discounted mass for the one unknown word. Each token is scored in the longest suffix state.

Counts of words and sequences are exact, over all training texts, and neither they nor the tree are
ever broadcast or collected. A context's suffixes end in the same word, so that all contexts that end in a word are one bucket's:
blocks of documents deal their distinct (words before, word) by the word before, and a bucket grows its part of the tree, scores
what it was sent and gives the scores back. Hot contexts, of more than LIMIT training tokens, are too much for a bucket. Their
counts are dealt by the next word; what they keep and give to their parents - some numbers for each of them, of which there are at
most training tokens / LIMIT of each length - is broadcast, and what is longer is dealt by one word more. That says where the work is done, and changes no
score. Words and sequences are known by hashes of 64 bits, so that counts are exact unless two of them share one; scores of tokens
come back as floats of 32 bits. grow(), prune() and token_scores() are the same tree in one place, for small tables.

Defined results: a null text is empty and is one token, the end; a row of null id is scored and
learned from; repeated rows count and are scored one by one; without training rows every token is
unknown, the base score of a token is log10(0.1 / 0.1) = 0, and so is the score; an empty table
gives no rows; other columns are never read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from vaultflow.llm._common import LOWER, crc_fold, discard, id_type, map_batches, materialise, read_table, schema_of, texts_of

DEPTH = 3
#: Sequences of fewer occurrences are not learned from.
LEAST = 2
DIVERGENCE = 0.05
DISCOUNT = 0.75
STRENGTH = 10.0
FOLDS = 10
#: Tokens of a block of documents; a block takes whole documents.
BLOCK_TOKENS = 1_000_000
#: The hash of the token that ends a document; no word is hashed to it but by chance.
END = np.uint64(0)
#: Words are dealt by so many bits of their hashes.
WORD_BITS = 7
#: Tokens of a bucket; buckets, but so many bits of keys at least; and shares of the buckets that are worked on one after the other.
BUCKET, LEAST_BUCKET_BITS, PASSES = 1 << 20, 6, 1
#: Contexts of more training tokens are spread over all tasks.
LIMIT = 1 << 20
#: Shares of the blocks that get their answers one after the other, which bounds the shuffle files that are there at a time.
SHARES = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Blocks of whole documents: ids, held_out, tokens of each (sizes), tokens as numbers within the
    block (int32, end included as number 0), the hash of each number (words) and its count in the
    block's training documents (counts)."""

    def run(batches):
        task, nth = TaskContext.get().partitionId(), 0
        ids, held, texts, size = [], [], [], 0

        def block():
            number, parts = _Numbers(), []
            number[b"\x00 end"] = 0
            for ws in texts:
                parts.append(np.fromiter(map(number.__getitem__, ws), np.int32, len(ws)))
                parts.append(np.zeros(1, np.int32))
            tokens = np.concatenate(parts)
            sizes = np.array([len(ws) + 1 for ws in texts], np.int64)
            train = tokens[np.repeat(~np.array(held), sizes)]
            words = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
            words[0] = END
            return {
                "block": [(task << 32) + nth], "ids": [ids], "held_out": [held], "sizes": [sizes], "tokens": [tokens.tobytes()],
                "words": [words.view(np.int64)], "counts": [np.bincount(train, minlength=len(number))],
            }

        for b in batches:
            for x, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ws = t.encode().translate(LOWER).split()
                ids.append(x)
                held.append(crc_fold(x, folds) == 0)
                texts.append(ws)
                size += len(ws) + 1
                if size >= block_tokens:
                    yield block()
                    ids, held, texts, size, nth = [], [], [], 0, nth + 1
        if ids:
            yield block()

    kind = id_type(docs, id_col)
    schema = schema_of(f"block bigint, ids array<{kind}>, held_out array<boolean>, sizes array<bigint>, tokens binary, words array<bigint>, counts array<bigint>")
    return map_batches(texts_of(docs, id_col, text_col), run, schema)


def word_counts(cut: DataFrame) -> DataFrame:
    """word (hash), n: exact counts of the training tokens."""
    each = cut.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).select(F.col("x.words").alias("word"), F.col("x.counts").alias("c"))
    return each.filter("c > 0").groupBy("word").agg(F.sum("c").alias("n"))


class Totals(NamedTuple):
    tokens: int
    distinct: int
    reserved: float

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))

    def root(self, c: np.ndarray) -> np.ndarray:
        """The root's log10 probability of tokens of count c; 0: the unknown word."""
        if not self.tokens:
            return np.zeros(len(c))
        return np.log10(np.where(c > 0, np.maximum(c - self.reserved, 1e-300), self.reserved * self.distinct) / self.tokens)


class Level(NamedTuple):
    """Frequent sequences of one length, by key; a key is the place of the sequence without its last
    token among those one shorter, times 2**32, plus the last token's place among frequent words."""

    keys: np.ndarray
    counts: np.ndarray


class Tree(NamedTuple):
    """words: sorted hashes of frequent words. levels[k]: frequent sequences of k + 2 words. For a
    sequence of k + 1 words as context: kept[k], and left[k], what it gives to its parent's
    distribution; for one of k + 2 words as context and next: own[k], the probability that the
    context alone adds."""

    words: np.ndarray
    counts: np.ndarray
    levels: list[Level]
    kept: list[np.ndarray]
    left: list[np.ndarray]
    own: list[np.ndarray]


def _places(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The place of each x in sorted_, or -1."""
    if not len(sorted_):
        return np.full(len(x), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return np.where(sorted_[at] == x, at, -1)


def _sequences(words: np.ndarray, levels: list[np.ndarray], tokens: np.ndarray, starts: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each length the places of the sequences that end at each token, or -1; and their keys."""
    now = [_places(words, tokens)]
    keys: list[np.ndarray] = []
    for k in range(len(levels) + 1):
        before = np.append(-1, now[k][:-1])
        before[starts] = -1  # no context runs over the start of a document
        # A frequent sequence has a frequent start and a frequent end.
        fits = (before >= 0) & (now[0] >= 0) & (now[k] >= 0)
        keys.append(np.where(fits, (before << 32) + now[0], -1))
        if k < len(levels):
            now.append(_places(levels[k], keys[k]))
    return now, keys


def _tokens(row_tokens: bytes, row_words, sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    numbers = np.frombuffer(row_tokens, np.int32)
    sizes = np.asarray(sizes)
    return np.asarray(row_words)[numbers], numbers, np.cumsum(sizes) - sizes


def frequent_sequences(cut: DataFrame, words: np.ndarray, levels: list[np.ndarray], least: float) -> Level:
    """The frequent sequences one longer than those of levels[-1], counted over all training texts."""
    sent = cut.sparkSession.sparkContext.broadcast((words, levels))

    def run(batches):
        words, levels = sent.value
        for b in batches:
            for i in range(b.num_rows):
                row = [b.column(j)[i] for j in range(b.num_columns)]
                sizes, held = np.asarray(row[2].values), np.array(row[3].values.to_pylist())
                tokens, _, starts = _tokens(row[0].as_py(), row[1].values, sizes)
                keys = _sequences(words, levels, tokens, starts)[1][-1]
                keys = keys[(keys >= 0) & np.repeat(~held, sizes)]
                key, n = np.unique(keys, return_counts=True)
                yield {"key": key, "c": n}

    found = map_batches(cut.select("tokens", "words", "sizes", "held_out"), run, schema_of("key bigint, c bigint"))
    rows = found.groupBy("key").agg(F.sum("c").alias("n")).filter(F.col("n") >= least).orderBy("key").toPandas()
    return Level(rows["key"].to_numpy(np.int64), rows["n"].to_numpy(np.int64))


def grow(cut: DataFrame, counts: DataFrame, totals: Totals, depth: int = DEPTH, share: float = 0.0, divergence: float = DIVERGENCE, strength: float = STRENGTH) -> Tree:
    """The tree in one place, for small tables: all its sequences come to the driver. score() makes the one of share 0, and never here."""
    least = max(float(LEAST), share * totals.tokens)
    common = counts.filter(F.col("n") >= least).orderBy("word").toPandas()
    words, n = common["word"].to_numpy(np.int64), common["n"].to_numpy(np.int64)
    levels: list[Level] = []
    for _ in range(depth):
        level = frequent_sequences(cut, words, [x.keys for x in levels], least)
        if not len(level.keys):
            break
        levels.append(level)
    return prune(words, n, levels, totals, divergence, strength)


def prune(words: np.ndarray, counts: np.ndarray, levels: list[Level], totals: Totals, divergence: float = DIVERGENCE, strength: float = STRENGTH) -> Tree:
    """Smooths every context's distribution by its parent's, and keeps those that diverge from it."""
    kept, left, own = [], [], []
    parent_of = np.full(len(words), -1)  # of contexts of one word: the root
    context_counts = counts
    below = [10.0 ** totals.root(counts)]  # the probability of a sequence's last word in its longest kept proper context
    ends = np.arange(len(words))  # the last word of each sequence
    suffix = ends  # of each sequence without its first word, the place one level below
    for k, level in enumerate(levels):
        context, last = level.keys >> 32, level.keys & 0xFFFFFFFF
        n = context_counts[context]
        shorter = last if k == 0 else _places(levels[k - 1].keys, (suffix[context] << 32) + last)
        parent = below[0][last] if k == 0 else np.where(shorter >= 0, below[k][np.maximum(shorter, 0)], 0.0)
        seen = np.bincount(context, level.counts, len(context_counts))
        rest = (np.maximum(context_counts - seen, 0) + strength) / (context_counts + strength)
        alone = level.counts / (n + strength)
        p = alone + rest[context] * parent
        gain = np.bincount(context, level.counts / n * np.log(np.maximum(p, 1e-300) / np.maximum(parent, 1e-300)), len(context_counts))
        gain += np.maximum(context_counts - seen, 0) / np.maximum(context_counts, 1) * np.log(rest)
        keep = gain >= divergence
        kept.append(keep)
        left.append(rest)
        own.append(alone)
        below.append(np.where(keep[context], p, parent))
        suffix, parent_of, context_counts = shorter, suffix, level.counts
    # Suffixes of kept contexts are kept.
    for k in range(len(levels) - 1, 0, -1):
        keys = levels[k - 1].keys
        shorter = keys & 0xFFFFFFFF if k == 1 else _suffixes(levels, k - 1)
        at = shorter[kept[k]]
        kept[k - 1][at[at >= 0]] = True
    return Tree(words, counts, levels, kept, left, own)


def _suffixes(levels: list[Level], k: int) -> np.ndarray:
    """For the sequences of levels[k], the place of each without its first word."""
    keys = levels[k].keys
    if k == 0:
        return keys & 0xFFFFFFFF
    return _places(levels[k - 1].keys, (_suffixes(levels, k - 1)[keys >> 32] << 32) + (keys & 0xFFFFFFFF))


def token_scores(tree: Tree, totals: Totals, tokens: np.ndarray, starts: np.ndarray, known: np.ndarray) -> np.ndarray:
    """log10 of each token's probability in its longest suffix state; known: its training count."""
    p = 10.0 ** totals.root(known)
    if not tree.levels:
        return np.log10(p)
    now, keys = _sequences(tree.words, [x.keys for x in tree.levels], tokens, starts)
    for k, level in enumerate(tree.levels):
        context = np.append(-1, now[k][:-1])
        context[starts] = -1
        state = (context >= 0) & tree.kept[k][np.maximum(context, 0)]
        if not state.any():
            break
        at = now[k + 1] if k + 1 < len(now) else _places(level.keys, keys[k])
        if k:  # a sequence whose end is not frequent has no key: look it up by its context
            at = _places(level.keys, np.where(state & (now[0] >= 0), (context << 32) + now[0], -1))
        alone = np.where(at >= 0, tree.own[k][np.maximum(at, 0)], 0.0)
        p = np.where(state, alone + tree.left[k][np.maximum(context, 0)] * p, p)
    return np.log10(p)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _longer(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a sequence and one word more."""
    return _mixed(key * _MIX + word.astype(np.uint64) + np.uint64(1))


def _before(x: np.ndarray) -> np.ndarray:
    return np.append(x[:1], x[:-1])


def _bucket_bits(n: int) -> int:
    """Buckets, by the highest bits of keys, hold BUCKET of n keys or fewer."""
    return max(LEAST_BUCKET_BITS, (n // BUCKET).bit_length())


def _slices(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Buckets, in ascending order, and where each one's stand."""
    edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else [0]
    for s, e in zip(edges, edges[1:]):
        yield int(bucket[s]), slice(s, e)


def _array(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _each_bucket(rows: DataFrame, f: Callable[[pa.Table], dict], ddl: str) -> DataFrame:
    """f of all rows of each bucket, of which a block has one at most."""
    schema = schema_of(ddl)
    arrow = to_arrow_schema(schema)
    return rows.groupBy("bucket").applyInArrow(lambda t: pa.table(f(t), arrow), schema)


def _planes(*columns: np.ndarray) -> bytes:
    """Unsigned 32-bit columns of one length, compressed byte by byte."""
    return pa.Codec("zstd").compress(np.ascontiguousarray(np.stack(columns).astype("<u4").view(np.uint8).reshape(len(columns), -1, 4).transpose(0, 2, 1)), asbytes=True)


def _from_planes(data: bytes, columns: int, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.Codec("zstd").decompress(data, 4 * columns * n, asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(columns, 4, n).transpose(0, 2, 1)).view("<u4").reshape(columns, n)


def coded_words(cut: DataFrame) -> DataFrame:
    """For each block and bucket of words, in ascending order of hashes: their codes (0: fewer than LEAST training tokens; others are
    numbered by count within the bucket) and exact counts of training tokens. Block -1: the bucket's numbers of training tokens and of
    distinct ones; the first number (code) from which on each count holds."""

    def words(batches):
        for b in batches:
            for i in range(b.num_rows):
                word, n = np.asarray(b.column(1)[i].values).view(np.uint64), np.asarray(b.column(2)[i].values)
                order = np.argsort(word)
                word, n = word[order], n[order]
                own = list(_slices((word >> np.uint64(64 - WORD_BITS)).astype(np.int64)))
                yield {"bucket": [k for k, _ in own], "block": [b.column(0)[i].as_py()] * len(own), "word": [word[s].tobytes() for _, s in own], "n": [n[s].tobytes() for _, s in own]}

    def counted(t: pa.Table) -> dict:
        word, at = np.unique(_array(t["word"], np.uint64), return_inverse=True)
        total = np.bincount(at, _array(t["n"], np.int64), len(word)).astype(np.int64)
        order = np.lexsort((word, -total))
        code = np.empty(len(word), np.int64)
        code[order] = 1 + (np.arange(len(word)) << WORD_BITS) + t["bucket"][0].as_py()
        code[total < LEAST] = 0
        ends = np.cumsum([len(x.as_buffer()) // 8 for x in t["word"]]).tolist()
        each = [at[s:e] for s, e in zip([0, *ends], ends)]
        some = total[order][total[order] >= LEAST]
        first = np.append(np.flatnonzero(np.diff(some, prepend=-1)), len(some))
        steps = np.append(some[first[:-1]], 0)
        return {
            "bucket": [*t["bucket"].to_pylist(), t["bucket"][0].as_py()], "block": [*t["block"].to_pylist(), -1],
            "code": [*(code[x].astype("<u4").tobytes() for x in each), first.astype("<u4").tobytes()], "n": [*(total[x].tobytes() for x in each), steps.tobytes()],
            "tokens": [0] * len(each) + [int(total.sum())], "distinct": [0] * len(each) + [int((total > 0).sum())],
        }

    rows = map_batches(cut.select("block", "words", "counts"), words, schema_of("bucket bigint, block bigint, word binary, n binary"))
    return _each_bucket(rows, counted, "bucket bigint, block bigint, code binary, n binary, tokens bigint, distinct bigint")


class Ladder(NamedTuple):
    """The counts of words by code. Words of a bucket are numbered by count, so that it is as long as the buckets have different counts."""

    first: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Ladder:
        parts = [((np.uint64(r["bucket"]) << np.uint64(32)) + np.frombuffer(r["code"], "<u4"), np.frombuffer(r["n"], np.int64)) for r in sorted(rows, key=lambda r: r["bucket"])]
        first, n = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0), np.empty(0))
        return cls(first.astype(np.uint64), n.astype(np.int64))

    def counts(self, code: np.ndarray) -> np.ndarray:
        if not len(self.n):
            return np.zeros(len(code), np.int64)
        x = np.maximum(code.astype(np.uint64), np.uint64(1)) - np.uint64(1)
        key = ((x & np.uint64((1 << WORD_BITS) - 1)) << np.uint64(32)) + (x >> np.uint64(WORD_BITS))
        return np.where(code > 0, self.n[np.maximum(np.searchsorted(self.first, key, "right") - 1, 0)], 0)

    def above(self, limit: int) -> np.ndarray:
        """Codes of words of more than limit occurrences."""
        out = []
        for i in np.flatnonzero(self.n > limit).tolist():
            s, e = (int(x) for x in self.first[i : i + 2])  # a bucket's last step has no count
            out += [1 + ((k & 0xFFFFFFFF) << WORD_BITS) + (k >> 32) for k in range(s, e)]
        return np.array(out, np.uint64)


def coded(cut: DataFrame, words: DataFrame) -> DataFrame:
    """cut without its words, but the code and the count (low and high half) of each of them, and with tokens compressed byte by byte."""
    every = words.filter("block >= 0").groupBy("block").agg(F.collect_list(F.struct("bucket", "code", "n")).alias("said"))

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                order = np.argsort(np.asarray(b.column(5)[i].values).view(np.uint64))
                said = sorted(b.column(6)[i].as_py(), key=lambda x: x["bucket"])
                code, n = np.empty(len(order), "<u4"), np.empty(len(order), np.int64)
                code[order], n[order] = np.frombuffer(b"".join(x["code"] for x in said), "<u4"), np.frombuffer(b"".join(x["n"] for x in said), np.int64)
                tokens = _planes(np.frombuffer(b.column(4)[i].as_buffer(), np.int32))
                yield {**{c: b.column(k).slice(i, 1) for k, c in enumerate(("block", "ids", "held_out", "sizes"))}, "tokens": [tokens], "words": [len(code)], "code": [_planes(code, n & 0xFFFFFFFF, n >> 32)]}

    rows = cut.join(every, "block").select("block", "ids", "held_out", "sizes", "tokens", "words", "said")
    kind = cut.schema["ids"].dataType.simpleString()
    return map_batches(rows, run, schema_of(f"block bigint, ids {kind}, held_out array<boolean>, sizes array<bigint>, tokens binary, words int, code binary"))


class Positions:
    """The tokens of a block: word (its code); numbers, that within the block, and counts, the training tokens of each number; context[k], the code of the word k + 1 before, or 0 where it, or one that is nearer, is of
    another document or rare; key[k], the hash of the k + 1 words before; train."""

    def __init__(self, row: list, depth: int):
        """row: held_out, sizes, tokens, words, code."""
        sizes = np.asarray(row[1].values)
        numbers = _from_planes(row[2].as_py(), 1, int(sizes.sum()))[0]
        self.starts = np.cumsum(sizes) - sizes
        code, low, high = _from_planes(row[4].as_py(), 3, row[3].as_py())
        self.word, self.numbers, self.counts = code[numbers], numbers, low.astype(np.int64) | (high.astype(np.int64) << 32)
        self.train = np.repeat(~np.array(row[0].values.to_pylist(), bool), sizes)
        self.context, self.key = [], []
        x, key = self.word, np.zeros(len(numbers), np.uint64)
        for k in range(depth):
            x = _before(x).copy()
            x[self.starts] = 0
            if k:
                x[self.context[-1] == 0] = 0
            self.context.append(x)
            key = _longer(key, x)
            self.key.append(key)


class Hot(NamedTuple):
    """Contexts of more than LIMIT occurrences, by length and hash: key (ascending within a length), level (their words less one), and, of
    each, its suffix's place, training tokens, what it gives to its parent, and whether it is kept."""

    key: np.ndarray
    level: np.ndarray
    total: np.ndarray
    left: np.ndarray
    keep: np.ndarray
    up: np.ndarray

    def places(self, at: Positions, k: int) -> np.ndarray:
        """The place of each position's context of k + 1 words, or -1."""
        s, e = np.searchsorted(self.level, (k, k + 1))
        x = _places(self.key[s:e], at.key[k])
        return np.where((x >= 0) & (at.context[k] > 0), x + s, -1)

    def asked(self, at: Positions, bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length of hot contexts that the block has: positions, and the place of each among the distinct (context, word): their
        contexts, words, and bucket by word."""
        out = []
        for k in range(len(at.key)):
            x = self.places(at, k)
            own = np.flatnonzero(x >= 0)
            if not len(own):
                break
            _, first, of = np.unique((x[own].astype(np.uint64) << np.uint64(32)) | at.word[own], return_index=True, return_inverse=True)
            first = own[first]
            out.append((own, of, x[first], at.word[first], (_mixed(at.word[first].astype(np.uint64) + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.int64)))
        return out


def hot_contexts(texts: DataFrame, ladder: Ladder, depth: int, limit: int, blocks_: int) -> Hot:
    words = np.sort(_longer(np.zeros(1, np.uint64), ladder.above(limit)))
    found = []
    if len(words) and depth > 1:

        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    at = Positions([b.column(j)[i] for j in range(5)], depth)
                    own = np.flatnonzero(_places(words, at.key[0]) >= 0)
                    for k in range(1, depth):
                        own = own[at.context[k][own] > 0]
                        key, first, of, n = np.unique(at.key[k][own], return_index=True, return_inverse=True, return_counts=True)
                        some = n * blocks_ >= limit  # others are of fewer than limit in all
                        yield {"level": np.full(int(some.sum()), k), "key": key[some].view(np.int64), "up": at.key[k - 1][own[first[some]]].view(np.int64), "n": n[some]}
                        own = own[some[of]]

        each = map_batches(texts.select("held_out", "sizes", "tokens", "words", "code"), run, schema_of("level int, key bigint, up bigint, n bigint"))
        found = each.groupBy("level", "key", "up").agg(F.sum("n").alias("n")).filter(F.col("n") > limit).collect()  # of tokens / limit of each length at most
    key, level, up = [words], [np.zeros(len(words), np.int64)], [np.full(len(words), -1)]
    for k in range(1, depth):
        known = key[-1]
        own = sorted((r["key"] % 2**64, r["up"] % 2**64) for r in found if r["level"] == k)
        x, y = (np.array([r[j] for r in own], np.uint64) for j in range(2))
        at = _places(known, y)
        x, at = x[at >= 0], at[at >= 0]
        key.append(x), level.append(np.full(len(x), k)), up.append(at + sum(len(z) for z in key[:-2]))
    n = sum(len(x) for x in key)
    return Hot(np.concatenate(key), np.concatenate(level), np.zeros(n), np.ones(n), np.zeros(n, bool), np.concatenate(up).astype(np.int64))


def hot_counts(texts: DataFrame, hot: Broadcast, bits: int, depth: int) -> DataFrame:
    """For each block and bucket of words: in how many training texts' tokens each (hot context, word) of the block is (n, in the order of
    asked()). Block -1: all of the bucket, context, word and n."""

    def asks(batches):
        for b in batches:
            for i in range(b.num_rows):
                at = Positions([b.column(j)[i] for j in range(5)], depth)
                parts = hot.value.asked(at, bits)
                if not parts:
                    continue
                n = np.concatenate([np.bincount(of, at.train[own], len(x)) for own, of, x, _, _ in parts])
                x, word, bucket = (np.concatenate([p[j] for p in parts]) for j in (2, 3, 4))
                order = np.argsort(bucket, kind="stable")
                own = list(_slices(bucket[order]))
                yield {"bucket": [k for k, _ in own], "block": [b.column(5)[i].as_py()] * len(own), "rows": [s.stop - s.start for _, s in own], "data": [_planes(x[order[s]], word[order[s]], n[order[s]]) for _, s in own]}

    def counted(t: pa.Table) -> dict:
        x, word, n = np.concatenate([_from_planes(d, 3, k) for d, k in zip(t["data"].to_pylist(), t["rows"].to_pylist())], axis=1)
        key, of = np.unique((x.astype(np.uint64) << np.uint64(32)) | word, return_inverse=True)
        total = np.bincount(of, n, len(key)).astype(np.int64)
        ends = np.cumsum(t["rows"].to_pylist()).tolist()
        each = [total[of[s:e]] for s, e in zip([0, *ends], ends)]
        return {
            "bucket": [*t["bucket"].to_pylist(), t["bucket"][0].as_py()], "block": [*t["block"].to_pylist(), -1], "rows": [*t["rows"].to_pylist(), len(key)],
            "data": [*(_planes(y) for y in each), _planes(key >> np.uint64(32), key & np.uint64(0xFFFFFFFF), total)],
        }

    rows = map_batches(texts.select("held_out", "sizes", "tokens", "words", "code", "block"), asks, schema_of("bucket bigint, block bigint, rows int, data binary"))
    return _each_bucket(rows, counted, "bucket bigint, block bigint, rows int, data binary")


def hot_tree(said: DataFrame, hot: Hot, ladder: Ladder, totals: Totals, depth: int, divergence: float, strength: float) -> Hot:
    """hot with what its contexts' counts say, those kept that diverge. What is collected has a row for each hot context."""
    table = said.filter("block = -1").select("rows", "data")

    def summed(hot: Hot, k: int | None) -> tuple[np.ndarray, np.ndarray]:
        def run(batches):
            for b in batches:
                for n, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    x, word, n = (y.astype(np.int64) for y in _from_planes(d, 3, n))
                    some = (n >= LEAST) & (word > 0)
                    if k is None:
                        one, two = n, np.where(some, n, 0)
                    else:
                        x, word, n = x[some], word[some], n[some]
                        key = (x << 32) | word
                        below = 10.0 ** totals.root(ladder.counts(word))
                        for j in range(k + 1):
                            own = np.flatnonzero(hot.level[x] == j)
                            c = x[own]
                            parent = below[own] if not j else below[_places(key, (hot.up[c] << 32) | word[own])]
                            p = n[own] / (hot.total[c] + strength) + hot.left[c] * parent
                            below[own] = np.where(hot.keep[c], p, parent)
                        x = c
                        one = n[own] / hot.total[c] * np.log(np.maximum(p, 1e-300) / np.maximum(parent, 1e-300))
                        two = np.zeros(len(one))
                    at = np.unique(x)
                    yield {"x": at, "one": np.bincount(x, one)[at] if len(x) else [], "two": np.bincount(x, two)[at] if len(x) else []}

        out = np.zeros((2, len(hot.key)))
        for r in map_batches(table, run, schema_of("x bigint, one double, two double")).groupBy("x").agg(F.sum("one").alias("one"), F.sum("two").alias("two")).collect():
            out[:, r["x"]] = r["one"], r["two"]
        return out[0], out[1]

    total, seen = summed(hot, None)
    left = (total - seen + strength) / (total + strength)
    hot = hot._replace(total=total, left=left)
    for k in range(depth):
        own = hot.level == k
        if own.any():
            gain = summed(hot, k)[0] + (total - seen) / np.maximum(total, 1) * np.log(left)
            hot = hot._replace(keep=np.where(own, (gain >= divergence) & (seen > 0), hot.keep))
    return hot


class Chain:
    """What hot contexts say of a block's positions: length, the words of each one's longest hot context; value(keep), the probability
    of each word in the longest of them for which keep is true, by way of all that are shorter."""

    def __init__(self, at: Positions, hot: Hot, said: list[dict] | None, bits: int, strength: float, root: np.ndarray):
        self.root, self.length, self.parts = root, np.zeros(len(at.word), np.int64), []
        self.last = np.full(len(at.word), -1)
        parts = hot.asked(at, bits) if said else []
        if not parts:
            return
        bucket = np.concatenate([p[4] for p in parts])
        n = np.empty(len(bucket), np.int64)
        n[np.argsort(bucket, kind="stable")] = np.concatenate([_from_planes(x["data"], 1, x["rows"])[0] for x in sorted(said, key=lambda x: x["bucket"])])
        for k, (own, of, x, word, _) in enumerate(parts):
            here, n = n[: len(x)], n[len(x) :]
            alone = np.where((here >= LEAST) & (word > 0), here / (hot.total[x] + strength), 0.0)
            self.parts.append((own, x[of], alone[of], hot.left[x][of]))
            self.length[own], self.last[own] = k + 1, x[of]

    def value(self, keep: np.ndarray) -> np.ndarray:
        p = self.root.copy()
        for own, x, alone, left in self.parts:
            p[own] = np.where(keep[x], alone + left * p[own], p[own])
        return p


class Asked:
    """The distinct (contexts, word) of a block that buckets answer, in the order in which they are sent. A bucket has all that share
    the shortest context that is not hot, and so all that is longer."""

    def __init__(self, at: Positions, chain: Chain, bits: int, nth: int, passes: int):
        depth = len(at.key)
        unit, there = np.zeros(len(at.word), np.uint64), np.zeros(len(at.word), bool)
        for k in range(depth):
            own = (chain.length == k) & (at.context[k] > 0)
            unit[own], there[own] = at.key[k][own], True
        bucket = unit >> np.uint64(64 - bits)
        own = np.flatnonzero(there & (bucket % np.uint64(passes) == nth))
        _, first, of = np.unique(_longer(at.key[-1][own], at.word[own]), return_index=True, return_inverse=True)
        n = np.bincount(of, at.train[own], len(first)).astype(np.int64)
        first = own[first]
        most = np.uint64((1 << 24) - 1)  # of codes; the order of others is any
        nearest = [np.minimum(x[first].astype(np.uint64), most) for x in at.context[:2]]
        rough = (bucket[first] << np.uint64(48)) | (nearest[0] << np.uint64(24)) | nearest[-1]
        order = np.argsort(rough, kind="stable")
        self.first, self.n, self.bucket = first[order], n[order], bucket[first][order].astype(np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.own, self.of = own, place[of]
        self.hot = chain.length[self.first] > 0


def _bucket_tree(context: np.ndarray, word: np.ndarray, n: np.ndarray, length: np.ndarray, parent: np.ndarray, divergence: float, strength: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """alone and left of each row - its probability is alone + left times its parent's - and the rows whose hot context is kept as a
    suffix. Rows are distinct in a block; context: the codes of the words before, the nearest first; n: training tokens; length: of the hot
    context; parent: the probability in it."""
    below, may = parent.copy(), word > 0
    key, parts = np.zeros(len(word), np.uint64), []
    for k, codes in enumerate(context):
        key = _longer(key, codes)
        at = np.flatnonzero((codes > 0) & (length <= k))
        some = at[may[at]]
        # What recurs; of a sequence that does, its suffix does too.
        _, first, of = np.unique(_longer(key[some], word[some]), return_index=True, return_inverse=True)
        count = np.bincount(of, n[some], len(first))
        recurring = count >= LEAST
        row, count = some[first[recurring]], count[recurring]
        may[at] = False
        hit = recurring[of]
        may[some[hit]] = True
        contexts = np.unique(key[row])
        x = _places(contexts, key[at])
        at, x = at[x >= 0], x[x >= 0]
        total = np.bincount(x, n[at], len(contexts))
        c = _places(contexts, key[row])
        seen = np.bincount(c, count, len(contexts))
        left = (np.maximum(total - seen, 0) + strength) / (total + strength)
        alone = count / (total[c] + strength)
        p = alone + left[c] * below[row]
        gain = np.bincount(c, count / total[c] * np.log(np.maximum(p, 1e-300) / np.maximum(below[row], 1e-300)), len(contexts))
        gain = gain + np.maximum(total - seen, 0) / np.maximum(total, 1) * np.log(left)
        keep = gain >= divergence
        own = np.zeros(len(word))
        own[some[hit]] = alone[(np.cumsum(recurring) - 1)[of[hit]]]
        own = own[at]
        below[at] = np.where(keep[x], own + left[x] * below[at], below[at])
        parts.append((at, x, keep, left, own))
    # Suffixes of kept contexts are kept.
    needed = np.zeros(len(word), bool)
    for k in range(len(parts) - 1, -1, -1):
        at, x, keep, _, _ = parts[k]
        keep[x[needed[at]]] = True
        needed[at] |= keep[x]
    alone_, left_ = np.zeros(len(word)), np.ones(len(word))
    for at, x, keep, left, own in parts:
        on = keep[x]
        at, x, own = at[on], x[on], own[on]
        alone_[at], left_[at] = own + left[x] * alone_[at], left[x] * left_[at]
    return alone_, left_, needed & (length > 0)


def answers(texts: DataFrame, hot: Broadcast, ladder: Broadcast, totals: Totals, bits: int, hot_bits: int, nth: int, passes: int, depth: int, divergence: float, strength: float) -> DataFrame:
    """For each block and bucket, of a share of the buckets, rows, value (the log10 of their probabilities, or alone of those with hot
    contexts) and left of the latter. Block -1: rows hot contexts that are suffixes of kept ones."""
    columns = depth + 4

    def asks(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = [b.column(j)[i] for j in range(b.num_columns)]
                at = Positions(row, depth)
                root = 10.0 ** totals.root(at.counts)[at.numbers]
                chain = Chain(at, hot.value, row[6].as_py() if len(row) > 6 else None, hot_bits, strength, root)
                asked = Asked(at, chain, bits, nth, passes)
                parent = chain.value(hot.value.keep)
                sent = [*(x[asked.first] for x in at.context), at.word[asked.first], asked.n, chain.length[asked.first], chain.last[asked.first] + 1]
                own = list(_slices(asked.bucket))
                yield {
                    "bucket": [k for k, _ in own], "block": [row[5].as_py()] * len(own), "rows": [s.stop - s.start for _, s in own],
                    "data": [_planes(*(x[s] for x in sent)) for _, s in own], "parent": [parent[asked.first[s][asked.hot[s]]].tobytes() for _, s in own],
                }

    def answer(t: pa.Table) -> dict:
        rows = t["rows"].to_pylist()
        each = [_from_planes(d, columns, k) for d, k in zip(t["data"].to_pylist(), rows)]
        *context, word, n, length, last = np.concatenate(each, axis=1)
        each.clear()
        root = 10.0 ** totals.root(ladder.value.counts(word))
        is_hot = length > 0
        root[word == 0] = 1.0  # their block knows their counts
        root[is_hot] = _array(t["parent"], np.float64)
        alone, left, needed = _bucket_tree(context, word, n, length, root, divergence, strength)
        value = alone.astype("<f4")
        plain = ~is_hot
        value[plain] = np.log10(alone[plain] + left[plain] * root[plain])
        left, ends = left.astype("<f4"), np.cumsum(rows).tolist()
        each = [slice(s, e) for s, e in zip([0, *ends], ends)]
        suffixes = np.unique(last[needed]) - 1
        return {
            "bucket": [*t["bucket"].to_pylist(), t["bucket"][0].as_py()], "block": [*t["block"].to_pylist(), -1], "rows": [*rows, len(suffixes)],
            "value": [*(value[s].tobytes() for s in each), suffixes.astype("<u4").tobytes()], "left": [*(left[s][is_hot[s]].tobytes() for s in each), None],
        }

    rows = texts.select("held_out", "sizes", "tokens", "words", "code", "block", *(c for c in texts.columns if c == "hot"))
    sent = map_batches(rows, asks, schema_of("bucket bigint, block bigint, rows int, data binary, parent binary"))
    return _each_bucket(sent, answer, "bucket bigint, block bigint, rows int, value binary, left binary")


def score(docs: DataFrame, depth: int = DEPTH, divergence: float = DIVERGENCE, discount: float = DISCOUNT, strength: float = STRENGTH, folds: int = FOLDS, block_tokens: int = BLOCK_TOKENS, passes: int = PASSES, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs. limit: contexts of more training tokens
    are hot; it changes no result."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    cut = materialise(blocks(docs, block_tokens, folds, id_col, text_col), "blocks")
    words = materialise(coded_words(cut), "words")
    steps = words.filter("block = -1").collect()  # a row for each of 2**WORD_BITS buckets
    totals = Totals(sum(r["tokens"] for r in steps), sum(r["distinct"] for r in steps), discount)
    ladder = Ladder.of(steps)
    texts = materialise(coded(cut, words), "texts")
    discard(cut, words)
    bits, hot_bits = _bucket_bits(totals.tokens), _bucket_bits(totals.tokens // 4)
    parts, hot, suffixes = [], None, np.zeros(0, bool)
    if totals.tokens and depth:
        found = hot_contexts(texts, ladder, depth, limit, texts.count())
        if len(found.key):
            early = send(found)
            said = materialise(hot_counts(texts, early, hot_bits, depth), "hot")
            found = hot_tree(said, found, ladder, totals, depth, divergence, strength)
            early.destroy()
            every = said.filter("block >= 0").groupBy("block").agg(F.collect_list(F.struct("bucket", "rows", "data")).alias("hot"))
            plain, texts = texts, materialise(texts.join(every, "block", "left"), "texts")
            discard(plain, said)
        hot, steps_ = send(found), send(ladder)
        parts = [materialise(answers(texts, hot, steps_, totals, bits, hot_bits, i, passes, depth, divergence, strength), "answers") for i in range(passes)]
        suffixes = found.keep.copy()
        for part in parts:
            for r in part.filter("block = -1 and rows > 0").select("value").distinct().toLocalIterator():
                suffixes[np.frombuffer(r["value"], "<u4")] = True
        for k in np.argsort(-found.level, kind="stable").tolist():
            if suffixes[k] and found.up[k] >= 0:
                suffixes[found.up[k]] = True
    names = ["held_out", "sizes", "tokens", "words", "code", "ids", *(c for c in texts.columns if c == "hot"), *(["said"] if parts else [])]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(j)[i] for j, c in enumerate(names)}
                sizes, at = np.asarray(row["sizes"].values), Positions([row[c] for c in names[:5]], depth)
                c, p = at.counts[at.numbers], totals.root(at.counts)[at.numbers]
                answered = (row["said"].as_py() or []) if "said" in row else []
                if hot is not None:
                    chain = Chain(at, hot.value, row["hot"].as_py() if "hot" in row else None, hot_bits, strength, 10.0**p)
                    before = chain.value(suffixes)
                    p = np.where(chain.length > 0, np.log10(before), p)
                for nth in range(passes) if answered else ():
                    own = sorted((x for x in answered if x["nth"] == nth), key=lambda x: x["bucket"])
                    asked = Asked(at, chain, bits, nth, passes)
                    value, left = np.frombuffer(b"".join(x["value"] for x in own), "<f4").astype(float), np.zeros(len(asked.first))
                    left[asked.hot] = np.frombuffer(b"".join(x["left"] for x in own), "<f4")
                    value, is_hot = value[asked.of], asked.hot[asked.of]
                    value += np.where(is_hot | (at.word[asked.own] > 0), 0.0, p[asked.own])
                    value[is_hot] = np.log10(value[is_hot] + left[asked.of[is_hot]] * before[asked.own[is_hot]])
                    p[asked.own] = value
                yield {
                    "doc_id": row["ids"].values, "held_out": row["held_out"].values, "n_tokens": sizes,
                    "n_known": np.add.reduceat((c > 0).astype(np.int64), at.starts), "train_tokens": np.full(len(sizes), totals.tokens),
                    "base_score": np.add.reduceat(totals.base(c), at.starts),
                    "score": np.add.reduceat(p, at.starts),
                }

    kind = id_type(docs, id_col)
    schema = schema_of(f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    if not parts:
        return map_batches(texts.select(*names), run, schema)
    every, out = functools.reduce(DataFrame.unionByName, parts).filter("block >= 0").withColumn("nth", F.col("bucket") % passes), []
    for i in range(SHARES):
        share = F.pmod(F.xxhash64("block"), F.lit(SHARES)) == i
        own = every.filter(share).groupBy("block").agg(F.collect_list(F.struct("nth", "bucket", "value", "left")).alias("said"))
        out.append(materialise(map_batches(texts.filter(share).join(own, "block", "left").select(*names), run, schema), "scores"))
    discard(texts, *parts)
    return functools.reduce(DataFrame.unionByName, out)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))


__all__ = ["blocks", "grow", "op6_lm_scoring", "prune", "score", "token_scores", "word_counts"]
