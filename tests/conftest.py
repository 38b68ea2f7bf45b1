from __future__ import annotations

import pytest

from claimspark.schemas import conform
from claimspark.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """``table(name, *dicts)``: rows of a domain table, missing columns NULL."""

    def make(name: str, *rows: dict):
        from claimspark.schemas import schema

        full = schema(name)
        data = [tuple(r.get(f.name) for f in full.fields) for r in rows]
        return conform(spark.createDataFrame(data, full), name)

    return make


def values(df, *cols):
    """Rows as a sorted list of tuples, money as float."""
    from decimal import Decimal

    rows = [tuple(float(x) if isinstance(x, Decimal) else x for x in row) for row in df.select(*cols).collect()]
    return sorted(rows, key=repr)
