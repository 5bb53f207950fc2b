"""Filters and stream splitting (side outputs)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_country(df: DataFrame, country: str = "US", col: str = "country") -> DataFrame:
    return df.where(F.col(col) == F.lit(country))


def ongoing_with_dropoff(df: DataFrame) -> DataFrame:
    """Ongoing trips that have a drop-off.

    The pickup is *not* checked (the reference's comment says it should be,
    its code does not); a missing pickup later forms its own group.
    """
    return df.where(F.col("ongoing") & F.col("dropoff").isNotNull())


def split_by(df: DataFrame, predicates: Mapping[str, Column]) -> dict[str, DataFrame]:
    """Named outputs of one input, one filter each (side outputs).

    In batch each output is its own scan with the predicate pushed down.
    For a single pass over live input use
    ``keyflow.streaming.sinks.write_split`` (one ``foreachBatch``, several writes).
    """
    return {name: df.where(p) for name, p in predicates.items()}


def parity(col: str = "n") -> dict[str, Column]:
    """Even / odd predicates.  ``%`` keeps the sign (``-3 % 2 = -1``), so the
    odd test is ``!= 0``, not ``== 1``."""
    even = (F.col(col) % 2) == 0
    return {"even": even, "odd": ~even}
