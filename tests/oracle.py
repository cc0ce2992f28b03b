"""Compare a Spark result with DuckDB: columns by name, rows as a bag, values exactly."""

from __future__ import annotations

import collections
import datetime as dt
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def normal(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, bool):
        return value
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def mismatch(df, con, sql: str) -> str | None:
    cursor = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cursor.description]
    expected_rows = cursor.fetchall()
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    theirs = dict(described)
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} against {sorted(theirs)}"
    kinds = {c: (ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]}
    if kinds:
        return f"types {kinds}"
    names = sorted(ours)
    positions = [[d[0] for d in described].index(n) for n in names]
    expected = collections.Counter(tuple(normal(r[p]) for p in positions) for r in expected_rows)
    found = collections.Counter(tuple(normal(r[n]) for n in names) for r in df.collect())
    if expected != found:
        return (
            f"{sum(found.values())} rows against {sum(expected.values())}; "
            f"only here {list((found - expected).items())[:3]}, only there {list((expected - found).items())[:3]}"
        )
    return None
