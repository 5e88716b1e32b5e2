"""Every query with an oracle equals its DuckDB SQL (sf0.001); the rest run."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from obsflow.sources.tables import TABLES
from tests.conftest import SF001
from tests.oracle_check import digest, duck_rows, spark_rows


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    s = digest(*spark_rows(E.queries()[key](spark, SF001)))
    o = digest(*duck_rows(con, E.oracle_sql()[key]))
    assert s == o


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[:3] == ["window_start", "window_end", "city"]


@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_query_runs(spark, key):
    rows = E.queries()[key](spark, SF001).count()
    assert rows > 0
