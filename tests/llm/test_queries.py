"""Queries of this subpackage against their SQL."""

import os

import pytest

from pageloom.llm.queries import ORACLE, QUERIES
from tests.oracle import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None
