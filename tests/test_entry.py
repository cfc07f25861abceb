"""Every query that has SQL gives the rows of that SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def cell(x):
    if x is None or x != x:
        return "none"
    return repr(float(x)) if isinstance(x, float) else str(list(x)) if isinstance(x, (list, tuple)) else str(x)


CORE = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(tuple(cell(r[c]) for c in columns) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    made = duck.execute(sql)
    names = [d[0] for d in made.description]
    assert sorted(names) == columns
    want = sorted(tuple(cell(r[names.index(c)]) for c in columns) for r in made.fetchall())
    assert rows == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_core_does_not_know_the_llm_part():
    root = os.path.dirname(entry.__file__)
    for path in glob.glob(f"{root}/candlewright/**/*.py", recursive=True):
        if "/llm/" not in path:
            with open(path) as f:
                assert "candlewright.llm" not in f.read(), path
