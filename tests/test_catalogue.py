import duckdb
import pytest

import __spark_entry__ as entry
from textloom.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*cols).collect()]
    assert rows
    if name in catalogue.SQL:
        want = con.execute("select " + ", ".join(f'"{c}"' for c in cols) + f" from ({catalogue.SQL[name]})").fetchall()
        key = lambda r: tuple((x is None, str(x)) for x in r)
        assert sorted(rows, key=key) == sorted(want, key=key)


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
