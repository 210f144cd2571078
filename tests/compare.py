"""Order-insensitive comparison of a Spark result with DuckDB SQL on the same tables."""

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


DUCK_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def duck_rows(sql: str, sf_dir: str) -> tuple[dict[str, str], list[tuple]]:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    types = {column[0]: str(column[1]) for column in result.description}
    return types, result.fetchall()


def canonical(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def mismatch(df, sql: str, sf_dir: str) -> str | None:
    expected_types, expected = duck_rows(sql, sf_dir)
    types = {name: DUCK_TYPES[kind] for name, kind in df.dtypes}
    if types != expected_types:
        return f"types {sorted(types.items())} != {sorted(expected_types.items())}"
    names = list(expected_types)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    want = canonical(names, expected)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{g} != {w}"
    return None
