"""Every registered query against its SQL on the smallest data."""

import pytest

import __spark_entry__ as contract
from ballast.plans import catalog
from check import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, name):
    report = compare(spark, FOLDER, name)
    assert report.startswith("ok") and "types" not in report, report


def test_every_query_has_sql():
    assert set(catalog.queries()) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
