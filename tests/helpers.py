"""Comparison of a query with its SQL in another engine."""

from collections import Counter
from pathlib import Path

import duckdb


def connect(data: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for p in Path(data).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def cell(v) -> str:
    if hasattr(v, "tolist"):
        v = v.tolist()
    assert not (isinstance(v, float) and v != v), "NaN compares with nothing"
    return repr(v) if isinstance(v, float) else str(v)


def rows(df, columns) -> Counter:
    return Counter(tuple(cell(v) for v in r) for r in df.select(*columns).collect())


def same(df, con, sql: str) -> None:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    columns = sorted(names)
    want = Counter(tuple(cell(r[names.index(c)]) for c in columns) for r in got.fetchall())
    assert rows(df, columns) == want
