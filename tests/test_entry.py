"""The driver's contract, and the oracles at the smallest size."""

import math
import os

import duckdb
import pytest

import rulewright.catalogue as catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def rows(frame):
    def plain(x):
        missing = x is None or (isinstance(x, float) and math.isnan(x)) or str(x) in ("NaT", "<NA>")
        return "NULL" if missing else round(float(x), 9) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None)), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert len(got)
    else:
        want = duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 7 * 150
    assert set(entry.oracle_sql()) <= set(entry.queries())
