import glob
import os

import pytest

import __spark_entry__ as driver
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not glob.glob(f"{SF_DIR}/*.parquet"), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_equals_its_sql(spark, con, name):
    df = driver.queries()[name](spark, SF_DIR)
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None


def test_entry(spark):
    df = driver.entry(spark)
    assert os.path.isdir(SF_DIR) and "outlier_mask" in df.columns and df.count() > 0
