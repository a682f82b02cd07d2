"""Every query that has DuckDB oracle SQL against it (row count, column names
and the multiset of values, exactly); every catalogue query has."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from tessera.plans.suite import REGISTRY

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF, con)
    assert res["status"] == "match", res


def test_every_catalogue_query_has_oracle():
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["site_name", "total_files", "storage_gb", "avg_file_size_mb", "archive_candidate_gb", "archive_candidate_pct"]
    assert df.count() > 0
