"""Every registered query of the library against its DuckDB text on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
from terraflux.plans import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 4) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v) if hasattr(v, "isoformat") or type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name not in SQL:
        assert rows
        return
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    assert rows == sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in cur.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
