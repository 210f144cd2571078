"""DuckDB rows of a SQL twin over the given tables."""

from pathlib import Path

import duckdb


def rows(sql: str, sf_dir: str) -> list[dict]:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    return [dict(zip(names, r)) for r in result.fetchall()]


def same(df, expected: list[dict]) -> None:
    key = lambda r: repr(sorted(r.items()))
    got = sorted((r.asDict() for r in df.collect()), key=key)
    assert got == sorted(expected, key=key)
