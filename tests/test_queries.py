"""Every query with SQL against that SQL; the others for rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import differences, frame, oracle, rows


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    got = rows(queries()[name](spark, sf_dir))
    assert differences(got, frame(duck, oracle_sql()[name])) == ""


@pytest.mark.parametrize("name", ["m2_isolation_forest", "m3_isolation_per_flight", "m4_cluster_outliers"])
def test_rows_only(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
