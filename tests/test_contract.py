"""Every registered query against its SQL twin."""

import duckdb
import pytest
from conftest import SF_DIR, TABLES, rows

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


# The training-data queries, where present, have tests of their own.
NAMES = sorted(set(contract.queries()) - set(contract.LLM_QUERIES))


def test_every_query_has_a_twin():
    assert set(NAMES) == set(contract.oracle_sql()) - set(contract.LLM_SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, duck, name):
    result = contract.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    names = ", ".join(f'"{c}"' for c in columns)
    cursor = duck.execute(f"SELECT {names} FROM ({contract.oracle_sql()[name]})")
    expected = sorted((tuple(r) for r in cursor.fetchall()), key=lambda r: [(v is not None, v) for v in r])
    assert rows(result.select(columns)) == expected
    assert len(expected) > 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["hero_id", "totals", "bans", "picks", "winrate"] and not result.isEmpty()
