"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as registry
from tests.oracle import differences

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_twin(spark, name):
    frame, sql = registry.queries()[name](spark, SMALL), registry.oracle_sql()[name]
    # Pandas has no integer column with nulls; Spark and DuckDB stand in for them differently.
    for column in {"refers_to", "parent_conv_id"} & set(frame.columns):
        frame, sql = frame.na.fill(-1, [column]), f"SELECT * REPLACE (coalesce({column}, -1) AS {column}) FROM ({sql})"
    assert differences(frame, sql, SMALL) is None


def test_queries_without_twin_have_rows(spark):
    for name in set(registry.queries()) - set(registry.oracle_sql()):
        assert registry.queries()[name](spark, SMALL).count() > 0


def test_flagship(spark):
    assert registry.entry(spark).count() == 10
