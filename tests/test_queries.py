"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lexigrove.plans.catalog import QUERIES

TABLES = "documents embeddings events benchmark labels conversations".split()


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(None if v is None or v != v else v for v in row) for row in frame.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


# operators for training data that SQL can't express have tests of their own
@pytest.mark.parametrize("name", [n for n in queries() if n in QUERIES or n in oracle_sql()])
def test_query_matches_sql(spark, sf_dir, duck, name):
    ours = queries()[name](spark, sf_dir).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(ours) > 0
        return
    theirs = duck.execute(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    assert entry(spark).count() == 200
