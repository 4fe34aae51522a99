import random
import sys

import pytest

from tests_llm_helpers import components_of, contamination, fingerprint, matches


def test_stages(spark, data, tmp_path):
    """Each stage against brute force on its own input."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, bench = docs.columns, [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, data).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "packing":
            assert {r["doc_id"] for r in docs.collect()} == set(before)
            break
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "toxicity":
            toxic = {r["doc_id"] for r in spark.read.parquet(f"{data}/labels.parquet").filter("toxic = 1").collect()}
            assert set(after) < set(before) and len(set(before) - set(after) - toxic) <= 0.02 * len(before)
        elif name == "line_dedup":
            gone = {k for k, m in matches(before.items()).items() if m}
            left = {i: [x for n, x in enumerate(t.split("\n")) if (i, n) not in gone] for i, t in before.items()}
            assert after == {i: "\n".join(x) for i, x in left.items() if any(y.split() for y in x) or before[i] == "\n".join(x)}
        elif name == "near_duplicates":
            prints = {i: fingerprint(t) for i, t in before.items()}
            assert all(any((prints[i] ^ prints[j]).bit_count() <= 2 for j in before if j != i) for i in set(before) - set(after))
            kept = sorted(after)
            assert not any((prints[i] ^ prints[j]).bit_count() <= 2 for k, i in enumerate(kept) for j in kept[:k])
        elif name == "decontamination":
            bad = {i for i, x in contamination(before.items(), bench).items() if x[4]}
            assert bad and set(after) == set(before) - bad


def test_near_copies_go(spark):
    """Near copies of a similarity of 0.8 or more go, beyond radius 2 as well; others beyond it stay."""
    import random

    import corpus_pipeline

    r = random.Random(3)
    vocabulary = [f"word{i}" for i in range(500)]
    texts = {}
    for i in range(20):
        w = r.choices(vocabulary, k=150)
        for k, changes in enumerate((0, 1, 2, 3, 4, 9)):
            own = list(w)
            for at in r.sample(range(150), changes):
                own[at] = f"other{r.random()}"
            texts[10 * i + k] = " ".join(own)
    texts |= {1000: None, 1001: "two words", 1002: "x"}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in texts.items() if (w := (t or "").split())}
    like = lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    prints = {i: fingerprint(t) for i, t in texts.items()}
    one_of_each = {i for i, c in zip(sorted(texts), components_of(sorted(texts), [prints[i] for i in sorted(texts)], 2)) if i == c}
    want = {i for i in one_of_each if i not in sets or not any(j < i and like(i, j) for j in sets.keys() & one_of_each)}
    far = {i for i in sets if i not in want and min((prints[i] ^ prints[j]).bit_count() for j in sets if j != i) > 2}
    assert far and 1001 in want
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {x["doc_id"] for x in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()} == want


def test_run(spark, data):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, data).count() > 0


WORDS = [f"w{k}" for k in range(900)]


def odd_rows():
    r = random.Random(5)
    text = lambda n: " ".join(r.choices(WORDS, k=n))
    long = "\n".join(text(50) for _ in range(400)) + "\n" + "x" * 300_000  # 20 000 words and one very long one
    same = text(60)
    return [(1, same), (1, text(40)), (1, same), (2, None), (3, ""), (None, text(30)), (None, None), (4, long), (5, long[: len(long) // 2]), (6, same), (7, text(20) + "\n" + text(5)), (8, " \n\t ")]


@pytest.mark.parametrize("which", ["odd", "no documents", "no labels", "no benchmark", "only nulls"])
def test_stages_on_odd_tables(spark, sf, which):
    """Nulls, repeated ids, empty and very long texts, empty tables and columns of clashing names, in every stage."""
    import corpus_pipeline

    rows = {"no documents": [], "only nulls": [(None, None), (None, None)]}.get(which, odd_rows())
    labels = [(1, None, 1), (4, 1, 0), (6, 1, 0), (None, 1, 1), (1, 0, 0)] if which != "no labels" else []
    bench = [(1, " ".join((odd_rows()[10][1]).split()[3:18])), (None, None), (2, "")] if which != "no benchmark" else []
    data = sf(rows, labels=(labels, "doc_id long, quality int, toxic int"), benchmark=(bench, "item_id long, text string"))
    docs = spark.read.parquet(f"{data}/documents.parquet").selectExpr("*", "1 AS doc", "2 AS ver", "3 AS line", "'x' AS own_id", "4 AS mark_doc", "5 AS label", "6 AS n", "'y' AS part")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = stage(spark, docs, data)
        if name != "packing":
            assert docs.columns == columns
            if name == "toxicity":  # rejects by text alone; later stages keep rows without an id
                nulls = docs.filter("doc_id IS NULL").count()
            if name != "line_dedup":
                assert set((r["doc_id"], r["text"]) for r in docs.collect()) <= set(before)
    packed = docs.collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in before}
    assert sum(r["doc_id"] is None for r in packed) == nulls and (which != "no labels" or nulls == 2)


@pytest.mark.parametrize("name", ["op1_secrets", "op2_toxicity", "op3_packing", "op4_decontamination", "op5_fingerprints", "op6_lm_scoring", "op7_simhash", "op8_quality", "op9_line_dedup", "op10_token_counts"])
def test_queries_on_odd_tables(spark, sf, name):
    from vaultflow.llm.queries import QUERIES

    rows = odd_rows()
    data = sf(rows, labels=([(1, 0, 1), (4, 1, 0), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"), benchmark=([(1, rows[10][1]), (None, None)], "item_id long, text string"))
    got = [r.asDict() for r in QUERIES[name](spark, data).collect()]
    if name == "op10_token_counts":
        assert sum(r["n_docs"] for r in got) == len(rows)
    elif name == "op3_packing":
        assert {r["doc_id"] for r in got} == {i for i, _ in rows} and sum(r["piece"] == 0 for r in got) == len(rows) and max(r["piece"] for r in got) > 10
    else:
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)


if __name__ == "__main__":
    sys.exit(pytest.main([__file__]))
