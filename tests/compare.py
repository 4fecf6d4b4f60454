"""Exact comparison of a registered query with its SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    columns = [names[i] for i in order]
    return columns, sorted(
        (tuple(r[i] for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r),
    )


def differences(spark_df, con, sql: str) -> list[str]:
    spark_rows = spark_df.collect()
    result = con.execute(sql)
    names, expected = _rows([d[0] for d in result.description], result.fetchall())
    got_names, got = _rows(spark_df.columns, [tuple(r) for r in spark_rows])
    if names != got_names:
        return [f"columns: {set(names) ^ set(got_names)}"]
    if len(got) != len(expected):
        return [f"rows: {len(got)} in Spark, {len(expected)} in SQL"]
    found = []
    for a, b in zip(got, expected):
        for name, x, y in zip(names, a, b):
            if type(x) is not type(y) or x != y:
                found.append(f"{name}: {x!r} in Spark, {y!r} in SQL, row {a}")
        if len(found) > 5:
            break
    return found
