"""Watermarks and late rows, batch twin of the streaming behaviour.

On a stream, ``withWatermark(ts, bound)`` drops rows whose window already
closed.  The deterministic batch twin replays an arrival order: the
watermark seen by a row is ``max(ts of rows that arrived before it) -
bound``; a row is late when its window ended at or before that watermark.
The running max over *all* rows is a global prefix scan, computed in two
levels (per arrival range, then over range summaries) so it never runs in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.plans.scan import Agg, assign_buckets, prefix_scan
from keyflow.plans.time import interval_micros


def late_flag(df: DataFrame, time_col: str, arrival: Sequence[str], size: str,
              bound: str, **scan_opts) -> DataFrame:
    """Add ``watermark`` (before this row) and ``late`` for a tumbling window ``size``."""
    r = prefix_scan(df, [], list(arrival), [Agg("__maxts", "max", F.col(time_col))],
                    inclusive=False, **scan_opts)
    wm = F.col("__maxts") - F.expr(f"INTERVAL {interval_micros(bound)} MICROSECONDS")
    wend = F.window(time_col, size).end
    return (r.withColumn("watermark", wm)
             .withColumn("late", F.coalesce(wend <= F.col("watermark"), F.lit(False)))
             .drop("__maxts"))


def tumbling_drop_late(df: DataFrame, time_col: str, arrival: Sequence[str], size: str,
                       bound: str, value: str, **scan_opts) -> DataFrame:
    """Tumbling-window sums after dropping late rows (no allowed lateness)."""
    flagged = late_flag(df, time_col, arrival, size, bound, **scan_opts)
    g = flagged.where(~F.col("late")).groupBy(F.window(time_col, size).alias("__w")).agg(
        F.sum(value).cast("long").alias("total"), F.count(F.lit(1)).alias("n"))
    return g.select(F.col("__w.start").alias("window_start"),
                    F.col("__w.end").alias("window_end"), "total", "n")


def late_rows(df: DataFrame, time_col: str, arrival: Sequence[str], bound: str,
              **scan_opts) -> DataFrame:
    """Flag rows older than the watermark at their arrival (``late``): the rule a
    streaming stateful operator (session windows, de-duplication) drops by."""
    r = prefix_scan(df, [], list(arrival), [Agg("__maxts", "max", F.col(time_col))],
                    inclusive=False, **scan_opts)
    wm = F.col("__maxts") - F.expr(f"INTERVAL {interval_micros(bound)} MICROSECONDS")
    return (r.withColumn("watermark", wm)
             .withColumn("late", F.coalesce(F.col(time_col) < F.col("watermark"), F.lit(False)))
             .drop("__maxts"))


def sessions_drop_late(df: DataFrame, time_col: str, arrival: Sequence[str], gap: str,
                       bound: str, value: str, keys: Sequence[str] = (),
                       **scan_opts) -> DataFrame:
    """Session windows over the rows that are not late under ``bound`` (the
    bounded out-of-orderness session job, replayed deterministically).

    The slices of the session step are found on the input, before late rows are
    dropped: they bound the rows that are left just as well, and the late-row
    scan does not run once more for them.
    """
    from keyflow.operators.windows import sessions
    sliced, pairs = assign_buckets(df, list(keys), time_col, scan_opts.get("rows_per_bucket"),
                                   then=[a for a in arrival if a != time_col])
    sliced = sliced.withColumnRenamed("__kf_bucket", "__kf_slice")
    on_time = late_rows(sliced, time_col, arrival, bound, **scan_opts).where(~F.col("late"))
    return sessions(on_time.drop("late", "watermark"), time_col, gap, keys=keys,
                    value=value, bucket=F.col("__kf_slice"), pairs=pairs)
