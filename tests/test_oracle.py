"""Every checked query equals its SQL on DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare_oracle import compare
from hourlake.plans.queries import QUERIES
from tests.helpers import SF_SMALL

TYPES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
}


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query(spark, name):
    ((_, same_columns, got, want, _, dtypes, types),) = compare(spark, SF_SMALL, [name])
    assert same_columns
    assert got and got == want
    for column, dtype in dtypes:
        assert types[column] in TYPES[dtype], column


def test_each_query_has_sql():
    # of the optional operators, some cannot be written in SQL
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    report = entry_points.entry(spark)
    assert report.count() == 24
    assert report.columns[:3] == ["city", "date", "hour"]
