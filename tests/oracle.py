"""Compare a DataFrame with DuckDB over the same Parquet tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal_form(frame: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(frame.columns)
    return frame[columns].sort_values(columns, ignore_index=True)


def differences(spark_df, sql: str, sf_dir: str) -> str | None:
    """None when rows, names, types and values agree."""
    got = normal_form(spark_df.toPandas())
    want = normal_form(connect(sf_dir).execute(sql).df())
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} against {list(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for column in got.columns:
        if got[column].dtype != want[column].dtype and len(got):
            return f"{column}: {got[column].dtype} against {want[column].dtype}"
        unequal = ~((got[column] == want[column]) | (got[column].isna() & want[column].isna()))
        if unequal.any():
            i = unequal.idxmax()
            return f"{column}, row {i}: {str(got[column][i])[:200]} against {str(want[column][i])[:200]}"
    return None
