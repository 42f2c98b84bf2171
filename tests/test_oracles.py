"""Every query against its SQL, on the smallest tables where they are present."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import connect, difference

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    ours = queries()[name](spark, SMALL).toPandas()
    assert len(ours) > 0
    assert difference(ours, duck.execute(oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert queries()[name](spark, SMALL).count() > 0


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["user_id", "item_id", "score", "rank"]
