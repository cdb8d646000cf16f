"""Every query that SQL can express, against that SQL."""

import pytest
from compare import differences

from tidelog.llm import oracle
from tidelog.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_sql(spark, smallest, name):
    assert differences(QUERIES[name](spark, smallest), oracle.SQL[name], smallest) == ""
