from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark():
    from feedloom.session import build_session

    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def column(spark):
    """Values of an expression over a one-column text table, in order."""

    def values(build, *texts, kind="string"):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, c {kind}")
        return [r[1] for r in sorted(rows.select("i", build("c").alias("x")).collect())]

    return values


def rows(df, *order):
    """Rows as tuples, sorted with nulls first."""
    found = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(found, key=lambda r: [(v is not None, str(type(v)), v) for v in r])
