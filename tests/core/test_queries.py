"""Every registered query against its DuckDB twin."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from folio import queries as Q

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    def plain(v):
        return None if v is None or str(v) in ("<NA>", "NaT") or v != v else float(v) if isinstance(v, int | float) or type(v).__module__ == "numpy" and not isinstance(v, bool | str) and hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)
    return list(frame.columns), sorted((tuple(plain(v) for v in r) for r in frame.astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_same_as_sql(spark, duck, name):
    assert rows(Q.queries()[name](spark, FOLDER).toPandas()) == rows(duck.execute(Q.oracle_sql()[name]).df())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 10
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
