"""Every query against its SQL in DuckDB on the small tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CORE = sorted(n for n in entry.queries() if not n.startswith("op") and n != "pipeline")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if hasattr(x, "tolist"):
        return plain(x.tolist())
    if isinstance(x, list):
        return [plain(y) for y in x]
    return f"{float(x):.6g}" if isinstance(x, (float, int, Decimal)) and not isinstance(x, bool) else str(x)


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    if name not in entry.oracle_sql():
        assert got
        return
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    want = sorted(str([plain(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
    assert got == want


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
