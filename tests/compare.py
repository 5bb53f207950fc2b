"""Order-insensitive comparison of a Spark and a pandas/DuckDB result."""

from __future__ import annotations

import pandas as pd


def canon(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)]
    rows = []
    for rec in df.itertuples(index=False):
        out = []
        for v in rec:
            if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
                out.append("NULL")
            elif hasattr(v, "isoformat"):
                out.append(pd.Timestamp(v).isoformat())
            else:
                out.append(repr(v) if isinstance(v, float) else str(v))
        rows.append("|".join(out))
    return sorted(rows)


def same(a: pd.DataFrame, b: pd.DataFrame) -> bool:
    return sorted(a.columns) == sorted(b.columns) and canon(a) == canon(b)
