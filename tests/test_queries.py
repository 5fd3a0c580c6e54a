"""Every query of the registry against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest

from strataleaf import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _rows(columns, rows):
    def one(x):
        if isinstance(x, float):
            return f"{x:.6f}"
        return str(x)

    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(one(r[k]) for k in order) for r in rows)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_against_sql(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert got[0]
    if name in registry.SQL:
        want = db.execute(registry.SQL[name])
        assert _rows([c[0] for c in want.description], want.fetchall()) == got
