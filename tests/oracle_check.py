"""Compares catalog queries with their SQL on one data folder."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    for c in frame.columns:
        frame[c] = [None if v is None else (str(int(v)) if isinstance(v, float) and v == int(v) else str(v)) for v in frame[c]]
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = _canonical(got), _canonical(want)
    if not a.equals(b):
        diff = a.compare(b)
        return f"{len(diff)} rows differ:\n{diff.head(5)}"
    return None
