"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.all_queries()))
def test_query_equals_its_sql(spark, duck, name):
    ok, text = compare(spark, duck, name, SF)
    assert ok or text.startswith("0 rows"), text


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) >= set(entry.all_queries())


def test_entry(spark):
    flagship = entry.entry(spark)
    assert flagship.columns[:2] == ["resource_id", "netbios_name"]
    assert flagship.count() > 0
