"""Every registered query against its DuckDB oracle on sf0.001 (row count, columns,
order-insensitive value hash); queries without an oracle must run and return rows."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import digest, duck
from tools.type_check import norm_spark

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_small, con, name):
    df = QUERIES[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    dcols, dtypes = rel.columns, [str(t) for t in rel.types]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert {n: norm_spark(t) for n, t in df.dtypes} == dict(zip(dcols, dtypes))
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, sf_small, name):
    assert QUERIES[name](spark, sf_small).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"date", "channel_id", "location_id", "sales", "txns", "units", "aov"} <= set(df.columns)
    assert dict(df.dtypes)["top_items"].startswith("array<struct<sku:string")


def test_every_query_is_documented():
    assert [k for k, f in QUERIES.items() if not (f.__doc__ or "").strip()] == []
