"""Every query that has SQL must give the SQL's rows."""

import datetime
import decimal

import duckdb
import pytest

from vaultflow.plans import catalogue, extras, operations  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v.isoformat() if isinstance(v, datetime.datetime) else v


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_sql(spark, duck, data, name):
    df = catalogue.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = ordered(tuple(plain(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = ordered(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_sanitized_titles_of_odd_documents(spark, tmp_path):
    """Device names and texts that aren't composed are as in the SQL, which leaves out sanitize()'s rules for them."""
    odd = [("Con.", "es"), ("aux", "fr"), ("cafe\u0301", "fr"), ("...", "de"), ("", "en"), (None, "en"), ("a", None), ("a: b. ", "EN"), ("\x01Éaux?", "fr")]
    spark.createDataFrame([(i, t, x, 0) for i, (t, x) in enumerate(odd)], "doc_id long, text string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = catalogue.QUERIES["fn_sanitize_title"](spark, str(tmp_path)).select("part", "name").collect()
    assert sorted(map(tuple, got)) == sorted(c.execute(catalogue.ORACLE_SQL["fn_sanitize_title"]).fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_runs(spark, data, name):
    assert catalogue.QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
