"""Every registered query against its SQL on the smallest tables, when they are there."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import compare

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return con


# 200 trees of depth 6 take minutes on any table: tools/check_oracles.py runs these two.
SLOW = {"gbt_train_score", "ensemble_train_score"}


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER).startswith(("ok", "rows only"))


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
