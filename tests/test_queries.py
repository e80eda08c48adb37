"""Every registered query against its SQL on the second engine."""

import pytest

from lakesteward.plans.oracle import ORACLE
from lakesteward.plans.registry import QUERIES
from tests.compare import differences, second_engine


@pytest.fixture(scope="module")
def db(sf_dir):
    return second_engine(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, sf_dir, name):
    assert differences(spark, db, QUERIES[name], ORACLE[name], sf_dir) == ""


def test_entry(spark):
    import __spark_entry__

    result = __spark_entry__.entry(spark)
    assert result.columns == ["db_name", "tbl_name", "total_size", "objects"]
    assert result.count() > 0
