"""Every registered query with SQL gives what DuckDB gives; the others run."""

import pytest

from corpusloom.plans import catalogue
from tests.compare import assert_same


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf_dir, duck, name):
    result = catalogue.QUERIES[name](spark, sf_dir)
    if name in catalogue.ORACLE_SQL:
        assert_same(result, duck, catalogue.ORACLE_SQL[name])
    else:
        assert result.count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
