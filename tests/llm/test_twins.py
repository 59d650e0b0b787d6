"""The registered queries of the corpus operators against their SQL twins."""

import pytest

from shelfcast.catalog.compare import compare, connect
from shelfcast.llm import queries

DATA = "/root/testdata/sf0.001"


def test_twins_are_of_queries():
    assert queries.oracle_sql().keys() <= queries.queries().keys()


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_its_twin(spark, name):
    assert compare(connect(DATA), spark, DATA, name, queries.queries()[name], queries.oracle_sql()[name]) is None
