"""Output files of bounded size and age, planned before they are written.

A row's line takes its bytes and a line end.  The prefix sum of bytes in arrival
order (hot-key safe) says where each line would begin in one endless file; lines
that begin in the same cell of that file make a part.  A cell is half the limit
wide and a part's lines are at most half the limit long, so no part exceeds the
limit and all but the last of a period are filled to about a half.  A line
longer than that is a part of its own (the only way to exceed the limit is one
line that does so alone).

With ``max_age`` a part holds rows of one period of that length only, so its
oldest row is never older than that when it is closed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.plans.scan import Agg, as_long, prefix_scan
from keyflow.plans.time import interval_micros


def assign_parts(df: DataFrame, line: str, order: Sequence[str], max_bytes: int, keys: Sequence[str] = (),
                 time_col: str | None = None, max_age: str | None = None, **scan_opts) -> DataFrame:
    """Adds ``period`` (0 without ``max_age``), ``part`` (text, unique within keys and period) and ``bytes``."""
    if max_bytes < 2:
        raise ValueError("a part holds two bytes at least")
    if (time_col is None) != (max_age is None):
        raise ValueError("time_col and max_age go together")
    half = max_bytes // 2
    size = (F.coalesce(F.octet_length(line), F.lit(0)) + 1).cast("long")
    period = F.lit(0).cast("long")
    if max_age:
        period = F.floor(as_long(df, time_col) / F.lit(interval_micros(max_age))).cast("long")
    d = df.withColumn("bytes", size).withColumn("period", period)
    narrow = F.col("bytes") <= half
    zero = F.lit(0).cast("long")
    d = prefix_scan(d, [*keys, "period"], list(order), [
        Agg("__kf_end", "sum", F.when(narrow, F.col("bytes")).otherwise(zero)),
        Agg("__kf_wide", "sum", F.when(narrow, zero).otherwise(F.lit(1).cast("long")))], **scan_opts)
    cell = F.expr(f"(__kf_end - bytes) div {max_bytes - half}")
    part = F.when(narrow, F.concat(F.lit("n"), cell.cast("string"))).otherwise(
        F.concat(F.lit("w"), (F.col("__kf_wide") - 1).cast("string")))
    return d.withColumn("part", part).drop("__kf_end", "__kf_wide")


def part_sizes(parts: DataFrame, order_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per part: its rows, its bytes, its first and last row."""
    return parts.groupBy(*keys, "period", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"),
        F.min(order_col).alias("first_row"), F.max(order_col).alias("last_row"))


def write_parts(df: DataFrame, line: str, order: Sequence[str], path: str, max_bytes: int, keys: Sequence[str] = (),
                time_col: str | None = None, max_age: str | None = None, **scan_opts) -> None:
    """Write every part as one text file under ``path/<keys>/period=P/part=X``, its lines in arrival order."""
    by = [*keys, "period", "part"]
    parts = assign_parts(df, line, order, max_bytes, keys, time_col, max_age, **scan_opts)
    told = parts.select(*dict.fromkeys([*by, *order, line])).repartition(*by).sortWithinPartitions(*by, *order)
    told.select(*by, F.coalesce(line, F.lit("")).alias("value")).write.mode("overwrite").partitionBy(*by).text(path)
