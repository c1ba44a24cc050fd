"""Comparison of registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(kind: str) -> str:
    kind = kind.lower()
    names = {"varchar": "string", "integer": "int", "long": "bigint"}
    return names.get(kind, kind)


def normalised(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple("" if pd.isna(v) else f"{v:.10g}" if isinstance(v, float) else str(v) for v in row)
        for row in frame.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both results agree in columns, types and rows, else what differs."""
    relation = con.sql(sql)
    left = {f.name: _plain(f.dataType.simpleString()) for f in spark_df.schema}
    right = {n: _plain(str(t)) for n, t in zip(relation.columns, relation.types)}
    if left != right:
        return f"schema {sorted(set(left.items()) ^ set(right.items()))}"
    mine = normalised(spark_df.toPandas())
    theirs = normalised(relation.df())
    if len(mine) != len(theirs):
        return f"rows {len(mine)} against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
