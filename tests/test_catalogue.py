"""Every registered query against its SQL on the smallest provided tables."""

import glob
import os

import pytest

from civiframe.catalog import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(FOLDER):
        pytest.skip("provided tables not present")
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    from tools.check_oracle import compare

    message, fine = compare(spark, con, name, QUERIES[name], ORACLE[name], FOLDER)
    assert fine, message
