"""Run registered queries next to their SQL and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, columns in name order."""
    out = df[sorted(df.columns)].copy()
    for c in out.columns:
        if str(out[c].dtype).startswith("datetime"):
            out[c] = out[c].astype("datetime64[us]").astype(str)
        out[c] = out[c].map(lambda v: None if v is None or v != v else str(v))
    return sorted(map(tuple, out.itertuples(index=False)), key=repr)


def difference(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str | None:
    """None if equal, else a short description."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(sql_df.columns)}"
    left, right = normal(spark_df), normal(sql_df)
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} vs {b}"
    return None
