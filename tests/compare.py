"""Run registered queries and their SQL side by side and compare every cell."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

TESTDATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, every cell as text, rows sorted."""
    out = {}
    for c in sorted(df.columns):
        cells = []
        for v in df[c]:
            if pd.isna(v):
                cells.append("")
            elif isinstance(v, float) and v == int(v) and abs(v) < 1e15:
                cells.append(str(int(v)))
            elif hasattr(v, "isoformat"):
                cells.append(v.isoformat()[:10])
            else:
                cells.append(str(v))
        out[c] = cells
    flat = pd.DataFrame(out)
    return flat.sort_values(list(flat.columns)).reset_index(drop=True)


KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
}


def type_differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Columns whose Spark type is not the SQL result's type."""
    got = dict(df.dtypes)
    want = {r[0]: KINDS.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return ", ".join(f"{c}: {got.get(c)} vs {t}" for c, t in want.items() if got.get(c) != t)


def differences(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str:
    """Empty if both tables hold the same rows."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} vs {len(sql_df)}"
    a, b = normal(spark_df), normal(sql_df)
    wrong = (a != b).any(axis=1)
    if wrong.any():
        i = wrong.idxmax()
        cols = [c for c in a.columns if a.at[i, c] != b.at[i, c]]
        return f"{int(wrong.sum())} rows differ, first: {a.loc[i].to_dict()} vs {b.loc[i, cols].to_dict()}"
    return ""
