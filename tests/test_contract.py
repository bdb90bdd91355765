import math

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SLOW = {"dbscan_grid_degrees"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - SLOW))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    answer = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in answer.description]
    assert sorted(df.columns) == sorted(names)
    expected = sorted(answer.fetchall(), key=repr)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert all(same(a, b) for a, b in zip(g, e)), (g, e)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
