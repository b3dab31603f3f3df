"""Every registered query against its SQL, at the smallest scale."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from casemill.plans.oracles import ORACLES, STORE_ORACLES
from casemill.plans.queries import QUERIES
from casemill.plans.store_queries import STORE_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted({**ORACLES, **STORE_ORACLES}))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF), name, SF) is None


@pytest.mark.parametrize("name", sorted({**QUERIES, **STORE_QUERIES}.keys() - {**ORACLES, **STORE_ORACLES}.keys()))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
