import os

import pytest

from strataframe.llm.catalog import ORACLES, QUERIES
from tests.oracle import compare

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, QUERIES[name](spark, SF), ORACLES[name], SF) > 0
