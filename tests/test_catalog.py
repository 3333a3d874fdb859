"""Every registered query against DuckDB on the smallest supplied tables."""

import os

import oracle
import pytest

from gridsight.catalog import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NO_SQL = {"kmeans_segments", "kmeans_centres", "silhouette", "fault_classifier", "batch_scoring",
          "rolling_evaluation"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, FOLDER), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(NO_SQL))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_all_queries_are_checked():
    assert set(QUERIES) == set(ORACLE) | NO_SQL


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "total_current_amount" in df.columns
