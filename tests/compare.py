"""Run a query in Spark and its SQL in DuckDB over the same tables and compare all values."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(row[i] for i in order) for row in rows]
    return sorted(names), sorted(shaped, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark, query, sql: str, folder: str) -> list:
    df = query(spark, folder)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    found = connect(folder).execute(sql)
    want = _rows([d[0] for d in found.description], found.fetchall())
    if got[0] != want[0]:
        return [("columns", got[0], want[0])]
    if len(got[1]) != len(want[1]):
        return [("rows", len(got[1]), len(want[1]))]
    return [(g, w) for g, w in zip(got[1], want[1]) if not _same(g, w)]


def _same(got, want) -> bool:
    for g, w in zip(got, want):
        if type(g) is not type(w) or (g != w and not (isinstance(g, float) and math.isnan(g) and math.isnan(w))):
            return False
    return True
