"""Every registered query against its DuckDB twin, and the driver's entry points."""

import pytest

import __spark_entry__ as driver
from testbed.check import compare, duck
from testbed.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_check_sql(spark, con, sf_dir, name):
    problem = compare(spark, con, sf_dir, name)
    assert problem is None, problem


def test_every_query_has_check_sql():
    assert set(REGISTRY) <= set(driver.queries())
    assert set(REGISTRY) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_has_rows(spark):
    result = driver.entry(spark)
    assert result.count() > 0
    assert set(result.columns) == {
        "publisher_domain", "publisher_name", "media_class", "region", "country", "week",
        "taxonomy_version", "avg_spi", "scan_count", "min_spi", "max_spi",
    }
