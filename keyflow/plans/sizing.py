"""Size checks before broadcasting, and partition sizing helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only if it provably has at most this many rows.
BROADCAST_MAX_ROWS = 1_000_000


# ... and at most so many bytes, by the width of its schema and of its strings.
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def rows_and_bytes(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and about their size in memory.

    A plain aggregate: every task sends one row, whatever the input's size.
    """
    fixed = 16 + sum(8 if not isinstance(f.dataType, (T.StringType, T.BinaryType)) else 16 for f in df.schema)
    wide = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    text = F.coalesce(F.sum(sum(wide, F.lit(0)).cast("long")), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), text.alias("b")).first()
    return row["n"], row["n"] * fixed + row["b"]


def has_at_most(df: DataFrame, n: int, n_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True if ``df`` has at most ``n`` rows and ``n_bytes`` bytes."""
    rows, size = rows_and_bytes(df)
    return rows <= n and size <= n_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint behind a check of rows and bytes; otherwise unchanged
    (Spark's sort-merge / shuffled-hash join, or AQE's runtime broadcast).

    A streaming query plans the hint once: pass rules that do not grow, or
    exclude per micro-batch (``streaming.exclude``), which checks each batch.
    """
    return F.broadcast(df) if has_at_most(df, max_rows) else df
