import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Edge cases that every operator takes: nulls, empty and blank texts, ties, repeats, very long texts, odd characters.
ODD = [
    (1, None), (2, ""), (3, "   \n \t "), (4, "word"), (5, "Two words"), (6, "Two words"), (7, "naïve café — Ünïcödé 日本語 テスト"), (8, "a\x00b\x1fc d"), (None, "a row without an id"),
    (9, "line one here\nline two here\n\nline one here"), (10, "x" * 5000), (11, "the end <|endoftext|> of it"), (12, "tab\tand  double  spaces \n end "), (13, "😀 emoji 😀 text"),
]


def texts(n, seed=7):
    """n (id, text) rows of invented prose with copies, near copies and long texts."""
    r = random.Random(seed)
    syllables = "ka lo mi ren tus vi ano est ing or pha zet qui dor".split()
    words = ["".join(r.choices(syllables, k=r.randint(1, 3))) for _ in range(400)]
    rows = []
    for i in range(n):
        kind = r.random()
        if rows and kind < 0.1:
            t = r.choice(rows)[1]
        elif rows and kind < 0.25:
            w = r.choice(rows)[1].split(" ")
            w[r.randrange(len(w))] = r.choice(words)
            t = " ".join(w)
        else:
            size = 3000 if kind > 0.98 else r.randint(5, 120)
            t = " ".join(w + ("\n" if r.random() < 0.05 else "") for w in r.choices(words, k=size)).replace("\n ", "\n")
        rows.append((100 + i, t))
    return rows


@pytest.fixture(scope="session")
def rows():
    return texts(150) + ODD


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With columns whose names clash with those that operators use."""
    more = [(i, t, "x", 1, "y", 2.0, 3) for i, t in rows]
    return spark.createDataFrame(more, "doc_id long, text string, part string, n long, word string, score double, line int").repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture
def sf(spark, tmp_path):
    """A function that writes documents and other tables as a test folder."""

    def write(rows, **tables):
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
        for name, (data, schema) in tables.items():
            spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
