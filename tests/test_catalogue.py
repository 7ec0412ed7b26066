import math

import duckdb
import pytest

from tallyframe.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query_equals_its_sql(spark, db, name):
    df = catalogue.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    want = db.sql(f"SELECT {', '.join(cols)} FROM ({catalogue.oracle_sql()[name]})").fetchall()
    assert got == sorted((tuple(plain(v) for v in r) for r in want), key=str)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and e.entry(spark).columns[0] == "mesa"
