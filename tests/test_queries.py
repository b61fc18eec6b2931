"""Every core query against its SQL, on the smallest tables."""

import duckdb
import pytest

from tilewright import queries as q

TABLES = "orders events nation part supplier customer".split()


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    return c


def key(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_sql(spark, duck, small, name):
    got = q.QUERIES[name](spark, small)
    columns = sorted(got.columns)
    want = duck.sql(q.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    order = ", ".join(f'"{c}"' for c in columns)
    rows = duck.sql(f"select {order} from ({q.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, map(key, map(tuple, got.select(*columns).collect())))) == sorted(map(repr, map(key, rows)))


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.ORACLE_SQL)))
def test_without_sql(spark, small, name):
    assert q.QUERIES[name](spark, small).count() > 0


def test_plans(spark, small):
    """The scan reads the columns that are used, and tile assignment needs no exchange."""
    plan = lambda name: q.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan("assign_tiles") and "o_totalprice" not in plan("assign_tiles")
    assert "Exchange" not in plan("grid_point_index") and "Python" not in plan("staging_summary")
    for name in ("dedup_footprint", "clip_footprint"):
        assert "CartesianProduct" not in plan(name) and "BroadcastNestedLoopJoin" not in plan(name)
