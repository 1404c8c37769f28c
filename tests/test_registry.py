"""Registered queries against DuckDB on the smallest data set."""

from pathlib import Path

import pytest

import check

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ["stints", "strength_tag", "stint_xg", "toi_pairs", "skater_stats", "goalie_shots", "prior_event", "entity_resolve",
          "percentiles", "component_war", "ridge_gram", "incremental_merge", "history_arrays"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 90


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    import __spark_entry__ as entry
    df = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry.oracle_sql()[name])
    want = check.rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert check.rows_of(df.columns, df.collect()) == want
