"""Order-insensitive comparison of a Spark result with a DuckDB result
(columns sorted by name, as the driver does)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(round(v, 9))
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict, str)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    return str(v)


def rows(df: pd.DataFrame) -> list[str]:
    cols = sorted(df.columns)
    return sorted("|".join(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None))
