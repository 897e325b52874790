"""The queries that SQL can express give what the SQL gives."""

import pytest

from rainledger.llm.queries import QUERIES
from rainledger.llm.sql import ORACLE
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, tables, name):
    assert compare(spark, connect(SF_DIR), name, QUERIES[name], ORACLE[name], SF_DIR) == []
