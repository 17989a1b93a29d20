"""Every registered query of the library against its SQL."""

import duckdb
import pytest

from orrery.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    def one(v):
        if v is None or v != v:
            return ""
        return repr(float(v) + 0.0) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(one(v) for v in row) for row in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, sf_dir, name):
    got = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    rows = got.select(*columns).collect()
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    want = duck.sql(f"select {', '.join(columns)} from ({registry.ORACLE_SQL[name]})").fetchall()
    assert plain(rows) == plain(want)
