"""Number types that lose nothing: sums and extremes keep the kind of their input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_whole(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, _WHOLE)


def wide(df: DataFrame, col: str) -> Column:
    """``col`` as LONG if it is an integer type, as DOUBLE if a float; decimals as they are."""
    t = df.schema[col].dataType
    if isinstance(t, _WHOLE):
        return F.col(col).cast("long")
    return F.col(col) if isinstance(t, T.DecimalType) else F.col(col).cast("double")
