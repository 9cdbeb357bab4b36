import duckdb
import pytest

from tessella.llm import entry


@pytest.mark.parametrize("name", sorted(entry.ORACLE_SQL))
def test_same_as_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(entry.ORACLE_SQL[name])
    columns = sorted(want.columns)
    got = entry.QUERIES[name](spark, sf)
    assert sorted(got.columns) == columns
    clean = lambda r: tuple(round(x, 5) if isinstance(x, float) else str(x) for x in r)
    a = sorted((clean(r) for r in got.select(*columns).collect()), key=str)
    b = sorted((clean(r) for r in want.select(", ".join(f'"{c}"' for c in columns)).fetchall()), key=str)
    assert a == b and a


def test_every_query_says_what_it_returns():
    assert all(q.__doc__ for q in entry.QUERIES.values())
