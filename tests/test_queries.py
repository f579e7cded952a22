"""Every query against its SQL twin at the smallest scale."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from millrace.plans.registry import ORACLES, QUERIES
from millrace.plans.views import TABLES

DIR = "/root/testdata/sf0.001"


def rows(frame: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if isinstance(x, np.ndarray | list | tuple):
            return str([round(float(y), 6) if isinstance(y, float | np.floating) else y for y in x])
        if x is None or (not isinstance(x, str | dict) and pd.isna(x)):
            return "null"
        if isinstance(x, bool | np.bool_):
            return str(bool(x))
        return f"{float(x):.9g}" if isinstance(x, int | float | np.integer | np.floating) or type(x).__name__ == "Decimal" else str(x)

    return sorted(tuple(map(cell, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    ours = QUERIES[name](spark, DIR).toPandas()
    if name in ORACLES:
        theirs = duck.execute(ORACLES[name]).df()
        assert sorted(ours.columns) == sorted(theirs.columns)
        assert rows(ours) == rows(theirs)
    else:
        assert len(ours)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
