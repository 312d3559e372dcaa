"""Every registered query outside the llm subpackage against its DuckDB SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from quern import catalog, release_queries  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return float(v) if type(v).__name__ == "Decimal" else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(name, spark, duck):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs(name, spark):
    assert catalog.QUERIES[name](spark, SF).count() > 0
