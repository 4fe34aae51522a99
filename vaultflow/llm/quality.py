"""Quality classifier: a regularised quadratic discriminant over transformed statistics of whole
documents. Class covariances are shrunk; a score comes from the difference of Mahalanobis log
densities, with cached Cholesky factors.

Learns from all labelled rows: their first and second moments are summed where they lie, and only
those sums (two classes of a fixed number of statistics) come to the driver.

Defined results: a null text is empty and is scored like one; rows with a null or unknown label,
or a null id, are not learned from, and of several labels of an id the largest counts; where a
class has no row, every score is that of the other class (0.5 if there is none); repeated rows
are scored one by one; other columns are never read.
"""

from __future__ import annotations

from operator import eq
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultflow.llm._common import fold, id_type, map_batches, materialise, read_table, schema_of, texts_of

SHRINK_POOLED, SHRINK_DIAGONAL = 0.05, 0.01
THRESHOLD = 0.3

_STOPS = b".,;:?'\"()-"
_SYMBOLS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b not in _STOPS and b not in b"!|")

STATISTICS = (
    "chars", "words", "word_length", "upper", "digits", "stops", "shouts", "symbols", "bars", "space", "breaks",
    "beyond_ascii", "distinct_words", "echoes", "repeated_lines", "entropy", "line_words", "longest_word",
)


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text: counts by log1p, shares by log1p of their hundreds."""
    raw = text.encode()
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, k = max(1, len(raw)), max(1, len(words))
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    p = count[count > 0] / n
    shares = (
        upper / max(1, upper + lower), count[48:58].sum() / n, sum(int(count[b]) for b in _STOPS) / n, count[33] / n,
        sum(int(count[b]) for b in _SYMBOLS) / n, count[124] / n, (count[9:14].sum() + count[32]) / n, count[10] / k, count[128:].sum() / n,
        len(set(words)) / k, sum(map(eq, words, words[1:])) / k, 1 - len(set(lines)) / max(1, len(lines)),
    )
    return [
        float(np.log1p(len(text))), float(np.log1p(len(words))), float(np.log1p(sum(map(len, words)) / k)),
        *(float(np.log1p(100 * x)) for x in shares),
        float(-(p * np.log2(p)).sum()), float(np.log1p(len(words) / max(1, len(lines)))), float(np.log1p(max(map(len, words), default=0))),
    ]


class Model(NamedTuple):
    """For the labels 0 and 1: mean, inverse of the Cholesky factor, log density's constant, rows."""

    mean: np.ndarray
    whiten: np.ndarray
    constant: np.ndarray
    rows: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.rows.all():
            return np.full(len(x), 0.5 if not self.rows.any() else float(self.rows[1] > 0))
        log = [c - 0.5 * (((x - m) @ w.T) ** 2).sum(1) for m, w, c in zip(self.mean, self.whiten, self.constant)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def fit(n: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled: float = SHRINK_POOLED, diagonal: float = SHRINK_DIAGONAL) -> Model:
    """A model from each class's number of rows, sums and sums of products."""
    d = sums.shape[1]
    mean = sums / np.maximum(n, 1)[:, None]
    own = products / np.maximum(n, 1)[:, None, None] - mean[:, :, None] * mean[:, None, :]
    all_ = (own * n[:, None, None]).sum(0) / max(n.sum(), 1)
    whiten, constant = [], []
    for k in (0, 1):
        weight = max(pooled, d / (d + n[k])) if n[k] else 1.0  # few rows: more of what both share
        s = (1 - weight) * own[k] + weight * all_
        s = (1 - diagonal) * s + diagonal * np.diag(np.diag(s)) + 1e-4 * np.eye(d)
        factor = np.linalg.cholesky(s)
        whiten.append(np.linalg.inv(factor))
        constant.append(np.log(max(n[k], 1) / max(n.sum(), 1)) - np.log(np.diag(factor)).sum())
    return Model(mean, np.array(whiten), np.array(constant), n)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and x, the statistics of each row of docs."""

    def run(batches):
        for b in batches:
            yield {"doc_id": b.column(0), "x": [statistics(t) for t in b.column(1).to_pylist()]}

    return map_batches(texts_of(docs, id_col, text_col), run, schema_of(f"doc_id {id_type(docs, id_col)}, x array<double>"))


def train(stats: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5, id_col: str = "doc_id", **how) -> Model:
    """A model from the statistics of all labelled documents outside fold 0."""
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
        .filter(F.col("label").isin(0.0, 1.0) & (fold(F.col("doc_id"), folds) != 0))
        .groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    )
    d = len(STATISTICS)

    def moments(batches):
        total = np.zeros((2, d + 1, d + 1))
        for b in batches:
            if b.num_rows:
                x = np.column_stack([np.ones(b.num_rows), np.asarray(b.column(1).flatten()).reshape(-1, d)])
                y = np.asarray(b.column(0))
                for k in (0, 1):
                    total[k] += x[y == k].T @ x[y == k]
        at = np.indices(total.shape).reshape(3, -1)
        yield {"k": at[0], "i": at[1], "j": at[2], "v": total.ravel()}

    sums = map_batches(stats.join(known, "doc_id").select("label", "x"), moments, schema_of("k int, i int, j int, v double"))
    total = np.zeros((2, d + 1, d + 1))
    for r in sums.groupBy("k", "i", "j").agg(F.sum("v").alias("v")).collect():
        total[r["k"], r["i"], r["j"]] = r["v"]
    return fit(total[:, 0, 0], total[:, 0, 1:], total[:, 1:, 1:], **how)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row of stats."""
    sent = stats.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches):
        own = Model(*sent.value)
        for b in batches:
            yield {"doc_id": b.column(0), "score": own.score(np.asarray(b.column(1).flatten()).reshape(-1, len(STATISTICS)))}

    return map_batches(stats.select("doc_id", "x"), run, schema_of(f"doc_id {id_type(stats, 'doc_id')}, score double"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs, all columns, without the rows whose score is below threshold."""
    import pyarrow as pa

    model = train(materialise(document_statistics(docs, id_col, text_col), "statistics"), labels, id_col=id_col, **how)
    sent, at = docs.sparkSession.sparkContext.broadcast(tuple(model)), docs.columns.index(text_col)

    def run(batches):
        own = Model(*sent.value)
        for b in batches:
            x = np.array([statistics(t or "") for t in b.column(at).to_pylist()]).reshape(-1, len(STATISTICS))
            yield b.filter(pa.array(own.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialise(document_statistics(read_table(spark, sf_dir, "documents")), "statistics")
    out = score(stats, train(stats, read_table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
