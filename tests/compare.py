"""Run registered queries beside DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(cell(r[i]) for i in order) for r in rows])


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def compare(name, df, con, sql) -> str | None:
    """None when equal, else a message."""
    want = con.execute(sql)
    want_columns = [d[0] for d in want.description]
    want_types = {d[0]: str(d[1]) for d in want.description}
    want_rows = want.fetchall()
    got_rows = df.collect()
    got_columns, got = rows_of(df.columns, got_rows)
    columns, expected = rows_of(want_columns, want_rows)
    if got_columns != columns:
        return f"{name}: columns {got_columns} != {columns}"
    if len(got) != len(expected):
        return f"{name}: {len(got)} rows != {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{name}: {a} != {b} ({columns})"
    types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    wrong = {c: (types[c], want_types[c]) for c in types if types[c] != want_types[c]}
    if wrong:
        return f"{name}: types {wrong}"
    if not got:
        return f"{name}: no rows"
    return None
