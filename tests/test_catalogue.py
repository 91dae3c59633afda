"""Every library query against its SQL on the same tables."""

import duckdb
import pytest
from conftest import SF

from folioscope import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    fix = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted(columns), sorted((tuple(fix(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, db, name):
    df = catalogue.queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    assert got[1]
    if name in catalogue.oracle_sql():
        cur = db.execute(catalogue.oracle_sql()[name])
        want = canon([c[0] for c in cur.description], cur.fetchall())
        assert got[0] == want[0]
        assert len(got[1]) == len(want[1])
        assert got[1] == want[1]
