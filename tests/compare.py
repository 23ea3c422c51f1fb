"""Comparison of a Spark result with DuckDB's, independent of row order."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


_TYPES = {
    "tinyint": "tinyint", "int": "integer", "bigint": "bigint", "double": "double",
    "string": "varchar",
}


def differences(df, con, sql: str) -> str | None:
    """None if names, types and the multiset of rows agree, else what differs."""
    relation = con.sql(sql)
    theirs = {d[0]: str(d[1]).lower() for d in relation.description}
    ours = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    described = {r[0]: r[1].lower() for r in con.sql(f"describe {sql}").fetchall()}
    if ours != described:
        return f"schema: {ours} against {described or theirs}"
    names = sorted(ours)
    expected = con.sql(f"select {', '.join(names)} from ({sql})").fetchall()
    got = [tuple(r) for r in df.select(*names).collect()]
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    key = lambda row: tuple((v is not None, v) for v in row)
    for a, b in zip(sorted(got, key=key), sorted(expected, key=key)):
        if a != b:
            return f"{a} against {b}"
    return None
