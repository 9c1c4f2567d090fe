"""The driver contract: every query has an oracle twin with the same columns."""

import duckdb
import pytest

import __spark_entry__ as entry
from obsflow.plans.catalog import QUERIES

SMOKE = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# Queries that write data while being built; the oracle tool covers them.
WRITES = ("batch_", "stream_", "_roundtrip", "append_")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    # Training-data operators without a SQL form are tested by brute force.
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert len(QUERIES) >= 51


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not any(w in n for w in WRITES)))
def test_oracle_runs_and_columns_match(spark, duck, name):
    res = duck.execute(entry.oracle_sql()[name])
    duck_cols = sorted(c[0] for c in res.description)
    res.fetchall()
    spark_cols = sorted(entry.queries()[name](spark, SMOKE).columns)
    assert spark_cols == duck_cols
