"""Compares a Spark result with DuckDB's over the same tables."""

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df: pd.DataFrame) -> list[tuple]:
    def one(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and np.isnan(x)):
            return "NULL"
        return f"{x:.6g}" if isinstance(x, (float, np.floating)) else str(x)

    return sorted(tuple(map(one, r)) for r in df[sorted(df.columns)].itertuples(index=False))


def duck(sql: str, sf: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con.sql(sql).df()
