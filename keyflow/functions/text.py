"""Text encoders for the row-format sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tuple_text(cols: Sequence[str | Column], open_: str = "(", close: str = ")",
               sep: str = ",") -> Column:
    """``(a,b,c)`` rendering of a row, nulls written as ``null``.

    ``concat_ws`` alone would skip null fields and shift positions.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("null"))
             for c in cols]
    return F.concat(F.lit(open_), F.concat_ws(sep, *parts), F.lit(close))
