"""Every registered query against its SQL twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    got = queries()[name](spark, SF_DIR).toPandas()
    if name in oracle_sql():
        assert differences(got, con.execute(oracle_sql()[name]).df()) is None
    else:
        assert len(got)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    result = entry(spark)
    assert {"context", "prompt"} <= set(result.columns)
    assert result.count() == len(result.select("conv_id", "seq").distinct().collect()) > 0
