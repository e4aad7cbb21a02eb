"""Spark rows against DuckDB rows, as the driver compares them."""

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return con


def rows(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    norm = lambda v: None if pd.isna(v) else round(float(v), 9) if isinstance(v, float) else v
    out = [tuple(norm(v.item() if hasattr(v, "item") and not isinstance(v, str) else v) for v in r) for r in pdf.astype(object).itertuples(index=False)]
    return sorted(out, key=lambda r: tuple(str(v) for v in r))


def same(spark_df, con, sql: str) -> str:
    """'' if equal, else what differs."""
    want, got = con.execute(sql).df(), spark_df.toPandas()
    if sorted(want.columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} not {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"{len(a)} rows not {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if [float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in x] != [float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in y]]
    return f"{len(bad)} of {len(a)} differ: {bad[:2]}" if bad else ""
