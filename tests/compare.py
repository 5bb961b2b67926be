"""Run a registered query in Spark and its SQL in DuckDB and compare the whole results."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v) if not isinstance(v, float) else (True, "f", v) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: [str(v) for v in r])


def differences(spark_df, con, sql: str) -> list[str]:
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if want_cols != got_cols:
        return [f"columns {got_cols} != {want_cols}"]
    if len(want) != len(got):
        return [f"rows {len(got)} != {len(want)}"]
    out = []
    for g, w in zip(got, want):
        for c, a, b in zip(got_cols, g, w):
            if type(a) is not type(b) or (a != b and not (isinstance(a, float) and math.isnan(a) and math.isnan(b))):
                out.append(f"{c}: {a!r} != {b!r} in {g} / {w}")
    return out
