"""Run a query in Spark and its SQL in DuckDB and compare the results exactly."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), "" if v is None else v) for v in row)


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_plain(r[n]) for n in names) for r in df.select(*names).collect()]
    return names, sorted(rows, key=_sortable)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in cur.fetchall()]
    return [cols[i] for i in order], sorted(rows, key=_sortable)


_SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "timestamp": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def type_mismatches(df, con, sql: str) -> list[tuple]:
    duck = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [(n, t, duck[n]) for n, t in df.dtypes if _SPARK_TO_DUCK[t] != duck[n]]
