"""Event-time and processing-time windows on live input.

``withWatermark`` rejects TIMESTAMP_NTZ, so the event-time column is first
converted zone-free to TIMESTAMP (``event_time``).  With a watermark and
``append`` output a window is emitted once, after ``max(event time) - bound``
passes its end; rows older than the watermark are dropped (the reference's
behaviour).  Spark drops a row against the watermark of the *previous*
micro-batch, so a late row arriving in the batch that closes its window is
still counted; the exact rule is replayed in batch by
``keyflow.operators.lateness``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.functions.time import event_time, with_ingest_time


def with_event_time(df: DataFrame, time_col: str = "ts", out: str = "event_ts",
                    bound: str = "0 seconds") -> DataFrame:
    """Add a TIMESTAMP event-time column with a watermark ``bound`` behind the max."""
    return df.withColumn(out, event_time(time_col)).withWatermark(out, bound)


def stream_window_reduce(df: DataFrame, time_col: str, size: str, slide: str | None = None,
                         keys: Sequence[str] = (), value: str | None = None,
                         order: Sequence[str] = (), carry: Sequence[str] = (),
                         bound: str = "0 seconds", processing_time: bool = False,
                         total: str = "total", with_avg: bool = False) -> DataFrame:
    """Tumbling / sliding window reduce on a stream (append mode).

    ``processing_time=True`` windows on the ingest time instead of ``time_col``
    (non-deterministic; the reference's processing-time jobs).
    """
    if processing_time:
        d = with_ingest_time(df, "__t").withWatermark("__t", bound)
    else:
        d = with_event_time(df, time_col, "__t", bound)
    w = F.window("__t", size, slide) if slide else F.window("__t", size)
    aggs = []
    if carry:
        first = F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order or [time_col])],
                         *[F.col(c) for c in carry])
        aggs.append(F.min(first).alias("__first"))
    if value is not None:
        aggs.append(F.sum(value).alias(total))
    aggs.append(F.count(F.lit(1)).alias("n"))
    g = d.groupBy(*keys, w.alias("__w")).agg(*aggs)
    cols = [*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
            *[F.col(f"__first.{c}").alias(c) for c in carry]]
    return g.select(*cols, *_totals(value, total, with_avg))


def _totals(value: str | None, total: str, with_avg: bool) -> list:
    cols = [] if value is None else [F.col(total)]
    cols.append(F.col("n"))
    if with_avg and value is not None:
        cols.append((F.col(total) / F.col("n")).alias(f"avg_{value}"))
    return cols


def stream_sessions(df: DataFrame, time_col: str, gap: str, keys: Sequence[str] = (),
                    value: str | None = None, bound: str = "0 seconds",
                    total: str = "total", order: Sequence[str] = (), carry: Sequence[str] = (),
                    with_avg: bool = False) -> DataFrame:
    """Session windows on a stream (append mode), with the first row's ``carry`` fields.

    Streaming sessions need a grouping key besides the window: a global
    session gets a constant key.  Under ``session.DEFAULT_CONF`` each task merges
    its own rows into sessions before the exchange, so only session rows meet in
    one task; the caller's session settings are left as they are.
    """
    d = with_event_time(df, time_col, "__t", bound)
    ks = list(keys)
    if not ks:
        d = d.withColumn("__all", F.lit(0))
        ks = ["__all"]
    aggs = ([F.sum(value).alias(total)] if value is not None else [])
    if carry:
        aggs.append(F.min(F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order or [time_col])],
                                   *[F.col(c) for c in carry])).alias("__first"))
    g = d.groupBy(*ks, F.session_window("__t", gap).alias("__w")).agg(
        *aggs, F.count(F.lit(1)).alias("n"))
    cols = [*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
            *[F.col(f"__first.{c}").alias(c) for c in carry]]
    return g.select(*cols, *_totals(value, total, with_avg))


def stream_clicks_per_key(clicks: DataFrame, key: str = "website", time_col: str = "ts",
                          size: str = "1 hour", bound: str = "0 seconds") -> DataFrame:
    """Clicks per key per window, keeping the window column for chaining."""
    d = with_event_time(clicks, time_col, "__t", bound)
    return d.groupBy(key, F.window("__t", size).alias("window")).agg(
        F.count(F.lit(1)).alias("clicks"))


def stream_top_key(counts: DataFrame, key: str = "website", size: str = "1 hour",
                   kind: str = "max") -> DataFrame:
    """Second, chained window aggregation: the key with most (fewest) clicks
    per window.  Chaining uses ``window_time`` of the first window."""
    by = F.max_by if kind == "max" else F.min_by
    g = counts.groupBy(F.window(F.window_time("window"), size).alias("__w")).agg(
        by(key, F.struct("clicks", key)).alias(key),
        (F.max if kind == "max" else F.min)("clicks").alias("clicks"))
    return g.select(key, F.col("__w.start").alias("window_start"),
                    F.col("__w.end").alias("window_end"), "clicks")


def stream_extreme_per_key(counts: DataFrame, key: str = "website", size: str = "1 day",
                           kind: str = "max") -> DataFrame:
    """Second, chained window: each key's own most (fewest) clicks of a first window within ``size``."""
    g = counts.groupBy(key, F.window(F.window_time("window"), size).alias("__w")).agg(
        (F.max if kind == "max" else F.min)("clicks").alias("clicks"))
    return g.select(key, F.col("__w.start").alias("window_start"),
                    F.col("__w.end").alias("window_end"), "clicks")


def stream_int_avg_per_key(clicks: DataFrame, key: str = "website", value: str = "time_spent",
                           time_col: str = "ts", size: str = "1 hour", bound: str = "0 seconds") -> DataFrame:
    """Truncated integer average of ``value`` per key and window."""
    d = with_event_time(clicks, time_col, "__t", bound)
    g = d.groupBy(key, F.window("__t", size).alias("__w")).agg(
        F.sum(value).alias("__s"), F.count(F.lit(1)).alias("__n"))
    return g.select(key, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
                    F.expr("__s div __n").alias(f"avg_{value}"))
