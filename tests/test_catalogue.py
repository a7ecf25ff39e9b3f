"""Every registered query runs, and agrees with its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from formweave.queries.tables import QUERIES

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="driver tables not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def comparable(frame):
    """Rows as texts; a null is the same in columns of any type."""
    frame = frame[sorted(frame.columns)].convert_dtypes()
    return sorted(tuple("" if v is None or v is pd.NA else str(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, str(DATA)).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert comparable(got) == comparable(want)


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
