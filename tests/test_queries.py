"""Every registered query against its DuckDB SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from pednet.entry import ORACLES, QUERIES
from tests.conftest import SMALL


def rows(values):
    return sorted(tuple("" if x is None else f"{x:.5g}" if isinstance(x, float) else str(x) for x in r) for r in values)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, tables, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    expected = tables.sql(ORACLES[name])
    assert columns == sorted(expected.columns)
    assert rows(df.select(*[f"`{c}`" for c in columns]).collect()) == rows(expected.select(*[f'"{c}"' for c in columns]).fetchall())


@pytest.mark.parametrize("name", ["completeness", "terrain_classes", "profile_audit", "edge_weights", "graph_components", "routes", "routes_between_places"])
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() >= 0
