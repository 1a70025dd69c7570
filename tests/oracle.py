"""Compare a Spark result with DuckDB's for the same tables: column names, and rows in any order."""

import glob
import math
import os

import duckdb


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else x + 0.0
    if hasattr(x, "asDict"):
        return tuple((k, plain(v)) for k, v in sorted(x.asDict().items()))
    if isinstance(x, dict):
        return tuple((k, plain(v)) for k, v in sorted(x.items()))
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def assert_same(df, sql: str, sf_dir: str) -> None:
    result = connection(sf_dir).execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    expected, got = rows_of(names, result.fetchall()), rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == len(expected)
    different = [(a, b) for a, b in zip(got, expected, strict=True) if a != b]
    assert not different, f"{len(different)} rows differ, such as {different[0]}"
