"""Compares registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def normal(columns, rows):
    """Columns by name, rows in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(cells, key=lambda r: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in r))


SPARK_KINDS = {"int": "int", "bigint": "long", "smallint": "int", "tinyint": "int", "double": "double", "string": "string", "date": "date", "boolean": "boolean", "timestamp": "timestamp"}
DUCK_KINDS = {"INTEGER": "int", "SMALLINT": "int", "TINYINT": "int", "BIGINT": "long", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "HUGEINT": "huge"}


def compare(spark, con, fn, sql: str, sf_dir: str) -> list[str]:
    """Differences between both sides; an empty list means equal."""
    df = fn(spark, sf_dir)
    got_types = {n: SPARK_KINDS.get(t, t) for n, t in df.dtypes}
    got_columns, got = normal(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_types = {d[0]: DUCK_KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
    want_columns, want = normal(names, cur.fetchall())
    problems = []
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    if got_types != want_types:
        problems.append("types " + str({c: (got_types[c], want_types[c]) for c in got_types if got_types[c] != want_types[c]}))
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3] if len(got) < 200000 else []
        only_want = [r for r in want if r not in set(got)][:3] if len(got) < 200000 else []
        problems.append(f"values: only spark {only_got}; only sql {only_want}")
    if not got:
        problems.append("empty result")
    return problems
