from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fleetquarry import build_session  # noqa: E402
from fleetquarry.sources.tables import SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        app="tests",
        master="local[8]",
        shuffle_partitions=8,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """table("name", row, ...) builds one of the declared tables; short rows end in NULLs."""

    def build(name: str, *rows: tuple):
        width = len(SCHEMAS[name].replace("decimal(20,4)", "decimal").split(","))
        return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], SCHEMAS[name])

    return build


@pytest.fixture
def column(spark):
    """column(expression, value, ...) evaluates a one-column expression over given values."""

    def evaluate(expression, *values, kind: str = "string"):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        return [r[0] for r in df.select(expression).collect()]

    return evaluate


def rows(df, *columns):
    """Rows as sorted tuples, NULLs first."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))
