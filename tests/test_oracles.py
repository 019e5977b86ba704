"""Every registered query against its SQL, and the queries without SQL by their rows."""

import duckdb
import pytest

from corpusmill.plans import registry

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def duck():
    from pathlib import Path

    con = duckdb.connect()
    for f in Path("/root/testdata/sf0.001").glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, duck, name):
    df = registry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(r) for r in df.select(*cols).collect()]
    if (sql := registry.oracle_sql().get(name)) is None:
        assert got
        return
    made = duck.execute(sql)
    names = [d[0] for d in made.description]
    assert sorted(names) == cols
    assert {d[0]: str(d[1]) for d in made.description} == {c: TYPES[t] for c, t in df.dtypes}
    assert plain(got) == plain(tuple(r[names.index(c)] for c in cols) for r in made.fetchall())
