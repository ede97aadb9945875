"""Every named query against its SQL in DuckDB, and the driver's contract."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from conftest import SF
from tidegauge.plans.oracle import ORACLES
from tidegauge.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(None if pd.isna(v) else v for v in row)
                   for row in frame.itertuples(index=False, name=None)), key=repr)


def test_contract(spark):
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert flagship.columns[:3] == ["window_start", "window_end", "product_id"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    ours = contract.queries()[name](spark, SF).toPandas()
    theirs = db.execute(contract.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert rows(ours) == rows(theirs)
