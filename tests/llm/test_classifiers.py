import random

import numpy as np
import pytest

from vaultflow.llm import quality, toxicity

BAD = ("scum", "idiot", "vile")


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        toxic, poor = r.random() < 0.3, r.random() < 0.4
        words = [r.choice("alpha beta gamma delta omega kilo lima mike".split()) for _ in range(r.randint(5, 60))]
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(BAD))
        text = " ".join(words) + "."
        rows.append((i, "### ".join(words) + "!!!" if poor else text))
        labels.append((i, int(not poor), int(toxic)))
    labels += [(None, 1, 1), (5, None, None), (99999, 1, 0), (7, labels[7][1], labels[7][2])]
    rows += [(700, None), (701, ""), (None, "scum")]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, labelled, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("labelled"))
    rows, labels = labelled
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


@pytest.mark.parametrize(("query", "label", "cut"), [(toxicity.op2_toxicity, "toxic", 0.5), (quality.op8_quality, "quality", 0.3)])
def test_held_out(spark, labelled, folder, query, label, cut):
    import zlib

    rows, labels = labelled
    truth = {i: (t if label == "toxic" else q) for i, q, t in labels[:600]}
    out = query(spark, folder).collect()
    assert len(out) == len(rows)
    right = total = 0
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
        i = r["doc_id"]
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
        if r["held_out"] and i in truth:
            total += 1
            right += r["predicted"] == truth[i]
    assert total > 80 and right / total > 0.95


def test_held_out_labels_are_not_learned(spark, labelled):
    import zlib

    rows, labels = labelled
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    other = [(i, q, (1 - t) if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, other))
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and 0 < len(a[0]) < 5000


def test_ftrl_is_the_plain_algorithm():
    rows = [(np.array([1, 3]), 1.0), (np.array([2]), 0.0), (np.array([1, 2, 5]), 1.0), (np.array([], int), 0.0)] * 5
    how = {"epochs": 2, "alpha": 0.5, "beta": 1.0, "l1": 0.1, "l2": 0.05}
    at, w = toxicity.learn(rows, 3, **how)
    z, n, bias = {}, {}, 8

    def weight(i):
        zi = z.get(i, 0.0)
        l1 = 0.0 if i == bias else how["l1"]
        return 0.0 if abs(zi) <= l1 and i != bias else (np.sign(zi) * l1 - zi) / ((how["beta"] + np.sqrt(n.get(i, 0.0))) / how["alpha"] + how["l2"])

    for _ in range(2):
        for x, y in rows:
            ids = [*x.tolist(), bias]
            ws = {i: weight(i) for i in ids}
            g = 1 / (1 + np.exp(-sum(ws.values()))) - y
            for i in ids:
                s = (np.sqrt(n.get(i, 0.0) + g * g) - np.sqrt(n.get(i, 0.0))) / how["alpha"]
                z[i] = z.get(i, 0.0) + g - s * ws[i]
                n[i] = n.get(i, 0.0) + g * g
    want = {i: weight(i) for i in z if weight(i)}
    assert dict(zip(at.tolist(), np.round(w, 9).tolist())) == {i: round(x, 9) for i, x in want.items()}


def test_drop_toxic_and_edges(spark, labelled, docs, nothing):
    rows, labels = labelled
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS label", "'x' AS key")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = toxicity.drop_toxic(table, known)
    assert kept.columns == table.columns
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert 700 in left and 701 in left
    assert sum(any(b in (t or "") for b in BAD) for t in left.values()) < 10
    assert sum(not any(b in (t or "") for b in BAD) for t in left.values()) > 0.98 * sum(not any(b in (t or "") for b in BAD) for _, t in rows)
    none = known.limit(0)
    assert toxicity.drop_toxic(docs, none).count() == docs.count()
    assert {r["score"] for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0.0}
    assert toxicity.score(nothing, toxicity.train(nothing, known)).count() == 0


def test_discriminant_is_the_gaussian_density():
    r = np.random.default_rng(0)
    x = [r.normal(k, 1 + k, (200, 3)) for k in (0, 1)]
    n = np.array([200.0, 200.0])
    m = quality.fit(n, np.array([a.sum(0) for a in x]), np.array([a.T @ a for a in x]), pooled=0.0, diagonal=0.0)
    p = r.normal(0, 2, (5, 3))
    want = []
    for q in p:
        logs = []
        for a in x:
            w = 3 / 203
            s = (1 - w) * np.cov(a.T, bias=True) + w * sum(np.cov(b.T, bias=True) for b in x) / 2 + 1e-4 * np.eye(3)
            d = q - a.mean(0)
            logs.append(-0.5 * np.log(np.linalg.det(s)) - 0.5 * d @ np.linalg.inv(s) @ d)
        want.append(1 / (1 + np.exp(logs[0] - logs[1])))
    assert np.allclose(m.score(p), want)


def test_quality_edges(spark, docs, nothing):
    stats = quality.document_statistics(docs)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.score(stats, quality.train(stats, none)).collect()} == {0.5}
    one = spark.createDataFrame([(100, 1), (101, 1)], "doc_id long, quality int")
    assert {r["score"] for r in quality.score(stats, quality.train(stats, one)).collect()} == {1.0}
    assert quality.document_statistics(nothing).count() == 0
    assert quality.keep_good(docs, one).count() == docs.count()


@pytest.mark.parametrize("query, label", [("op2_toxicity", "toxic"), ("op8_quality", "quality")])
def test_held_out_labels_are_never_learned(spark, data, tmp_path, query, label):
    """Other labels of the rows that are held out change no score."""
    from pyspark.sql import functions as F

    from vaultflow.llm._common import fold
    from vaultflow.llm.queries import QUERIES

    scores = []
    for k in range(2):
        root = f"{tmp_path}/{k}"
        spark.read.parquet(f"{data}/documents.parquet").write.parquet(f"{root}/documents.parquet")
        labels = spark.read.parquet(f"{data}/labels.parquet")
        labels.withColumn(label, F.when((fold(F.col("doc_id"), 5) == 0) & F.lit(k == 1), 1 - F.col(label)).otherwise(F.col(label))).write.parquet(f"{root}/labels.parquet")
        scores.append({r["doc_id"]: r["score"] for r in QUERIES[query](spark, root).collect()})
    assert scores[0] == pytest.approx(scores[1], abs=1e-12)
