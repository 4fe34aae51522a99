"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Per-coordinate rates and L1 sparsity leave compact weights, which are broadcast: at most 2**bits
of them. The model learns from the labelled rows of at most `max_rows` ids, those of the least hash, and of
them from as many as have `max_features` features together (the documented bounds); all rows are scored, by
their whole texts.

Defined results: a null text is empty and scores by the bias alone; without any label the score is
0; rows with a null or unknown label, or a null id, are never learned from, and of several labels
of an id the largest counts; repeated rows are scored one by one; other columns are never read.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.llm._common import LOWER_ALNUM, fold, id_type, map_batches, read_table, schema_of, texts_of

BITS = 20
MAX_ROWS = 20_000
#: Features of all rows that are learned from; 4 bytes each in the one task that learns.
MAX_FEATURES = 50_000_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.1

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5))


def features(text: str, bits: int = BITS) -> np.ndarray:
    """The distinct hashed words, bigrams and skip-grams (one word left out), as sorted indices."""
    words = text.encode().translate(LOWER_ALNUM).split()
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    h = (h + np.uint64(1)) * _MIX[0]
    h ^= h >> np.uint64(29)
    parts = [h * _MIX[1], (h[:-1] * _MIX[2]) ^ (h[1:] * _MIX[3]), (h[:-2] * _MIX[3]) ^ (h[2:] * _MIX[1])]
    return np.unique(np.concatenate([(p * _MIX[0]) >> np.uint64(64 - bits) for p in parts]).astype(np.int64))


def learn(rows, bits: int = BITS, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, np.ndarray]:
    """(indices, weights) that are not 0, from (features, label) rows in their order; the last index is the bias."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    rows = [*rows]
    for i, (x, y) in enumerate(rows):  # one by one, so that all rows are never held twice
        rows[i] = (np.append(x, x.dtype.type(size - 1)), y)
    for _ in range(epochs):
        for x, y in rows:
            zx, nx = z[x], n[x]
            root = np.sqrt(nx)
            w = np.where(np.abs(zx) > l1, (np.sign(zx) * l1 - zx) / ((beta + root) / alpha + l2), 0.0)
            w[-1] = -zx[-1] / ((beta + root[-1]) / alpha + l2)  # the bias is not thinned out
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            after = nx + g * g
            z[x] = zx + g - (np.sqrt(after) - root) / alpha * w
            n[x] = after
    w = np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)
    w[-1] = -z[-1] / ((beta + np.sqrt(n[-1])) / alpha + l2)
    at = np.flatnonzero(w)
    return at, w[at]


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, folds: int = 5, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, label, text of the labelled documents outside fold 0, max_rows ids at most."""
    chosen = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
        .filter(F.col("label").isin(0.0, 1.0) & (fold(F.col("doc_id"), folds) != 0))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .withColumn("key", F.xxhash64(F.col("doc_id").cast("string")))
        .orderBy("key", "doc_id").limit(max_rows)
    )
    # Bounded by max_rows, hence the broadcast.
    return texts_of(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("key", "label", "text")


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", bits: int = BITS, max_rows: int = MAX_ROWS, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", max_features: int = MAX_FEATURES, **how) -> tuple[np.ndarray, np.ndarray]:
    """The weights. Executors extract the features; one task learns, from no more than the bounds."""
    rows = training_rows(docs, labels, label_col, folds, max_rows, id_col, text_col)

    def extract(batches):
        for b in batches:
            yield {"key": b.column(0), "label": b.column(1), "x": [features(t, bits).astype(np.int32).tobytes() for t in b.column(2).to_pylist()]}

    def fit(batches):
        rows, n = [], 0
        for b in batches:
            for x, y in zip(b.column(2).to_pylist(), b.column(1).to_pylist()):
                n += len(x) // 4
                if n <= max_features or not rows:
                    rows.append((np.frombuffer(x, np.int32), y))
        if rows:
            at, w = learn(rows, bits, **how)
            yield {"at": at.astype(np.int64), "w": w}

    extracted = map_batches(rows, extract, schema_of("key bigint, label double, x binary"))
    out = map_batches(extracted.repartition(1).sortWithinPartitions("key", "x"), fit, schema_of("at bigint, w double")).collect()
    return np.array([r["at"] for r in out], np.int64), np.array([r["w"] for r in out], np.float64)


def score(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray], bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        at, w = sent.value
        table = np.zeros((1 << bits) + 1)
        table[at] = w
        for b in batches:
            sums = np.array([table[features(t, bits)].sum() for t in b.column(1).to_pylist()]) + table[-1]
            yield {"doc_id": b.column(0), "score": 1 / (1 + np.exp(-np.clip(sums, -35, 35))) if len(at) else np.zeros(b.num_rows)}

    return map_batches(texts_of(docs, id_col, text_col), run, schema_of(f"doc_id {id_type(docs, id_col)}, score double"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text_col: str = "text", bits: int = BITS, **how) -> DataFrame:
    """docs, all columns, without the rows whose score is threshold or more."""
    at, w = train(docs, labels, bits=bits, text_col=text_col, **how)
    if not len(at):
        return docs
    sent = docs.sparkSession.sparkContext.broadcast((at, w))
    i = docs.columns.index(text_col)

    def run(batches):
        at, w = sent.value
        table = np.zeros((1 << bits) + 1)
        table[at] = w
        cut = np.log(threshold / (1 - threshold))
        for b in batches:
            clean = [table[features(t or "", bits)].sum() + table[-1] < cut for t in b.column(i).to_pylist()]
            yield b.filter(pa.array(clean, pa.bool_()))

    import pyarrow as pa

    return docs.mapInArrow(run, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return score(docs, train(docs, labels)).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
