"""Every query against its SQL at the smallest scale, values and names of columns."""

import math

import duckdb
import pytest

from lectern import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(v, 9) if isinstance(v, float) and math.isfinite(v) else v
    return sorted(([value(r[i]) for i in order] for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    df = catalogue.queries()[name](spark, SF)
    found = rows([tuple(r) for r in df.collect()], df.columns)
    if sql := catalogue.oracle_sql().get(name):
        r = con.execute(sql)
        columns = [d[0] for d in r.description]
        assert sorted(df.columns) == sorted(columns)
        want = rows(r.fetchall(), columns)
        assert len(found) == len(want)
        assert found == want
    else:
        assert found
