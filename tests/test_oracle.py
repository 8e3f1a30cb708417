"""Every registered query against its DuckDB oracle on sf0.01 (order-free)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from salesmart.plans import catalog
from salesmart.sources.tables import ALL_TABLES
from tests.conftest import SF_ORACLE
from tools.compare import normalise

catalog.load_all()
QUERIES, ORACLE = dict(catalog.QUERIES), dict(catalog.ORACLE)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ALL_TABLES:
        path = f"{SF_ORACLE}/{t}.parquet"
        path += "/*.parquet" if os.path.isdir(path) else ""
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_entry_lists_every_query():
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_ORACLE)
    s_cols, s_rows = normalise(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLE[name])
    d_cols, d_rows = normalise([c[0] for c in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["State", "TotalSales"] and len(rows) > 0


# Spark simple type name -> DuckDB type name of the same values.
TYPE_NAMES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_ORACLE)
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    for field in df.schema.fields:
        s = field.dataType.simpleString()
        assert duck_types[field.name] == TYPE_NAMES.get(s, s.upper()), (name, field.name)
