"""Compare a registered Spark query with its DuckDB oracle on the same tables.

Used by the tests and by ``tools/check_queries.py``.  The comparison is
order-insensitive: both sides are sorted on all columns after rounding
floating-point values, then compared cell by cell.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from .sources.tables import TABLES, table_path


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        # DuckDB hands DATE columns to pandas as midnight timestamps.
        return s[:10] if s[10:] in ("", "T00:00:00") else s
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame, cols: list[str]) -> list[tuple]:
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return sorted(out, key=key)


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> tuple[bool, str]:
    sc, oc = sorted(spark_pdf.columns), sorted(oracle_pdf.columns)
    if sc != oc:
        return False, f"columns differ: spark={sc} oracle={oc}"
    if len(spark_pdf) != len(oracle_pdf):
        return False, f"row count differs: spark={len(spark_pdf)} oracle={len(oracle_pdf)}"
    a, b = _rows(spark_pdf, sc), _rows(oracle_pdf, sc)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return False, f"row {i} differs:\n spark ={x}\n oracle={y}\n cols={sc}"
    return True, f"{len(a)} rows match"


def spark_to_pandas(df) -> pd.DataFrame:
    rows = df.collect()
    return pd.DataFrame([r.asDict() for r in rows], columns=df.columns)
