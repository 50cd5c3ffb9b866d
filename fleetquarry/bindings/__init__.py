"""Reports and operators on the driver's test tables.

The test tables are not the reports' own tables, so each binding renames and derives the
report's inputs from them with Spark and then runs the library code as it is. Next to each
stands SQL that computes the same result straight from the test tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetquarry.bindings import collation, estate, operators, software, state, shares

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = (estate, software, shares, operators, state, collation)


def all_queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
