"""Every registered query of the capture operators against DuckDB."""

import pytest

from sigmill.plans import catalogue
from tests.oracle import assert_same

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    df = catalogue.QUERIES[name](spark, SF)
    if name in catalogue.ORACLE_SQL:  # the others are held against models in test_models.py
        assert_same(df, catalogue.ORACLE_SQL[name], SF)
    assert df.count() > 0
