"""Every registered query equals its DuckDB oracle on the smallest shared tables."""

import json
import os

import duckdb
import pytest

from conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

import __spark_entry__ as E
from oracle_sql import ORACLE_SQL
from tripstar.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


GOLDEN = json.load(open(os.path.join(os.path.dirname(__file__), "golden_schemas.json")))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL) == set(GOLDEN)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.schema.simpleString() == GOLDEN[name]  # names and types are pinned: the driver compares them
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["pickup_hour", "rides"] and df.count() > 0
