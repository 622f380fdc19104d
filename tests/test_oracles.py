import os

import pytest

from strataframe.queries import ORACLES, QUERIES
from tests.oracle import TABLES, compare

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, QUERIES[name](spark, SF), ORACLES[name], SF) > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_objects_of_more_than_three_digits(spark, tmp_path):
    for t in set(TABLES) - {"supplier"}:
        os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    spark.range(12_000).withColumnRenamed("id", "s_suppkey").toPandas().to_parquet(tmp_path / "supplier.parquet")
    name = "q89_manifest_document"
    assert compare(spark, QUERIES[name](spark, str(tmp_path)), ORACLES[name], str(tmp_path)) == 600 + 3999
