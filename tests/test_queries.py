"""Registered queries against their oracle SQL on the smallest tables."""

import os

import pytest

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if v is None or v != v:
            return "null"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
            return repr(round(float(v), 6) + 0.0)
        if hasattr(v, "isoformat"):
            return v.isoformat()[:19]
        return str(v)

    return sorted(tuple(text(r[i]) for i in order) for r in rows)


def oracle_names():
    from quorumdf import plans

    return sorted(plans.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", oracle_names())
def test_query_equals_oracle(spark, con, name):
    from quorumdf import plans

    df = plans.queries()[name](spark, DATA)
    result = con.execute(plans.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["body_id", "n", "unanimous", "pct", "severity"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
