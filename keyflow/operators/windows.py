"""Time windows: tumbling, sliding and session; keyed or global.

Window aggregates emit ``window_start, window_end`` (epoch-aligned, as in the
reference) plus the reduction.  The profit reducer keeps the non-summed
fields of the window's *first* row (``carry``): that is a ``min`` over a
struct led by the arrival order, deterministic after any shuffle (unlike
``first()``).

Tumbling and sliding windows aggregate partially per task, so neither a hot
key nor a global (un-keyed) window funnels rows into one task.  Session
windows need care: ``groupBy(key, session_window(...))`` sends all rows of a
key to one task.  ``sessions`` instead cuts hot keys (more rows than one
task should sort; see ``keyflow.plans.scan.assign_buckets``) into time
slices, sessionizes inside each (key, slice) in parallel and stitches only
the first and last session of each slice: at most two rows per slice meet
in the stitching window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.plans.scan import assign_buckets
from keyflow.plans.time import interval_micros


def _first(order: Sequence[str], carry: Sequence[str]) -> Column:
    return F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)],
                    *[F.col(c) for c in carry])


def _reduce_aggs(value: str | None, order: Sequence[str], carry: Sequence[str],
                 total: str) -> list[Column]:
    aggs = []
    if carry:
        aggs.append(F.min(_first(order, carry)).alias("__first"))
    if value is not None:
        aggs.append(F.sum(value).alias(total))
    aggs.append(F.count(F.lit(1)).alias("n"))
    return aggs


def _merge_aggs(value: str | None, carry: Sequence[str], total: str) -> list[Column]:
    """Reductions of partial rows made by ``_reduce_aggs``."""
    aggs = [F.min("__first").alias("__first")] if carry else []
    if value is not None:
        aggs.append(F.sum(total).alias(total))
    aggs.append(F.sum("n").alias("n"))
    return aggs


def _finish(df: DataFrame, keys: Sequence[str], start: str, end: str,
            carry: Sequence[str], value: str | None, total: str, with_avg: bool) -> DataFrame:
    cols = [*keys, F.col(start).alias("window_start"), F.col(end).alias("window_end"),
            *[F.col(f"__first.{c}").alias(c) for c in carry]]
    if value is not None:
        cols.append(total)
    cols.append("n")
    if with_avg and value is not None:
        cols.append((F.col(total) / F.col("n")).alias(f"avg_{value}"))
    return df.select(*cols)


def window_reduce(df: DataFrame, time_col: str, size: str, slide: str | None = None,
                  keys: Sequence[str] = (), value: str | None = None,
                  order: Sequence[str] = (), carry: Sequence[str] = (),
                  total: str = "total", with_avg: bool = False) -> DataFrame:
    """Tumbling (``slide=None``) or sliding window reduce per key (or global).

    Output: keys, window_start, window_end, carry (first row), total, n[, avg].
    """
    aggs = _reduce_aggs(value, order or [time_col], carry, total)
    if slide:
        # reduce to panes that every window holds whole, then merge the few pane rows per window:
        # the input is not copied once for each window it lies in
        pane = math.gcd(interval_micros(size), interval_micros(slide))
        g = df.groupBy(*keys, F.window(time_col, f"{pane} microseconds").alias("__p")).agg(*aggs)
        g = g.withColumn("__t", F.col("__p.start"))
        g = g.groupBy(*keys, F.window("__t", size, slide).alias("__w")).agg(*_merge_aggs(value, carry, total))
    else:
        g = df.groupBy(*keys, F.window(time_col, size).alias("__w")).agg(*aggs)
    g = g.withColumn("__ws", F.col("__w.start")).withColumn("__we", F.col("__w.end"))
    return _finish(g, keys, "__ws", "__we", carry, value, total, with_avg)


def sessions(df: DataFrame, time_col: str, gap: str, keys: Sequence[str] = (),
             value: str | None = None, order: Sequence[str] = (),
             carry: Sequence[str] = (), total: str = "total", with_avg: bool = False,
             bucket: Column | None = None,
             rows_per_bucket: int | None = None, pairs: int | None = None) -> DataFrame:
    """Session windows: a new session starts when the gap to the previous row
    of the key is *greater* than ``gap`` (rows exactly ``gap`` apart merge).

    Same rows as ``groupBy(keys, session_window(time_col, gap))``; window_end
    is the last row's time + gap.  ``bucket`` and ``pairs``: slices of
    ``time_col`` found before (``plans.scan.assign_buckets``).
    """
    keys = list(keys)
    order = list(order) or [time_col]
    gap_us = interval_micros(gap)
    df = df.where(F.col(time_col).isNotNull())  # as session_window: no time, no session
    if bucket is None:
        # rows on one time are cut by the next order column: their sessions meet again in step 3
        d, pairs = assign_buckets(df, keys, time_col, rows_per_bucket, then=[o for o in order if o != time_col])
        d = d.withColumnRenamed("__kf_bucket", "__b")
    else:
        d = df.withColumn("__b", bucket)

    # 1. sessionize inside each (key, bucket) slice
    w = Window.partitionBy(*keys, "__b").orderBy(time_col, *[o for o in order if o != time_col])
    prev = F.lag(time_col).over(w)
    new = F.when(prev.isNull() | (F.col(time_col) > prev + F.expr(f"INTERVAL {gap_us} MICROSECONDS")), 1).otherwise(0)
    d = d.withColumn("__new", new)
    d = d.withColumn("__sid", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    aggs = [F.min(time_col).alias("__start"), F.max(time_col).alias("__last")]
    aggs += _reduce_aggs(value, order, carry, total)
    local = d.groupBy(*keys, "__b", "__sid").agg(*aggs)
    if pairs == 0:
        # no key was sliced: every key is one slice, its sessions are final
        local = local.withColumn("__end", F.col("__last") + F.expr(
            f"INTERVAL {gap_us} MICROSECONDS"))
        return _finish(local, keys, "__start", "__end", carry, value, total, with_avg)

    # 2. only the first and last session of a slice can touch another slice
    sw = Window.partitionBy(*keys, "__b")
    local = local.withColumn("__edge", (F.col("__sid") == 1)
                             | (F.col("__sid") == F.max("__sid").over(sw)))
    inner = local.where(~F.col("__edge"))
    edges = local.where(F.col("__edge"))

    # 3. stitch edge sessions over the summary rows (<= 2 per slice)
    ew = Window.partitionBy(*keys).orderBy("__start", "__b", "__sid")
    prev_last = F.max("__last").over(ew.rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.withColumn("__gnew", F.when(
        prev_last.isNull()
        | (F.col("__start") > prev_last + F.expr(f"INTERVAL {gap_us} MICROSECONDS")), 1).otherwise(0))
    edges = edges.withColumn("__gid", F.sum("__gnew").over(
        ew.rowsBetween(Window.unboundedPreceding, 0)))
    merge = [F.min("__start").alias("__start"), F.max("__last").alias("__last")]
    merge += _merge_aggs(value, carry, total)
    merged = edges.groupBy(*keys, "__gid").agg(*merge)

    cols = [*keys, "__start", "__last"] + (["__first"] if carry else []) \
        + ([total] if value is not None else []) + ["n"]
    alls = inner.select(*cols).unionByName(merged.select(*cols))
    alls = alls.withColumn("__end", F.col("__last") + F.expr(f"INTERVAL {gap_us} MICROSECONDS"))
    return _finish(alls, keys, "__start", "__end", carry, value, total, with_avg)


def session_reduce_simple(df: DataFrame, time_col: str, gap: str, keys: Sequence[str] = (),
                          value: str | None = None, order: Sequence[str] = (),
                          carry: Sequence[str] = (), total: str = "total",
                          with_avg: bool = False) -> DataFrame:
    """``groupBy(keys, session_window)`` form (test reference; one task per key)."""
    g = df.groupBy(*keys, F.session_window(time_col, gap).alias("__w")).agg(
        *_reduce_aggs(value, order or [time_col], carry, total))
    g = g.withColumn("__ws", F.col("__w.start")).withColumn("__we", F.col("__w.end"))
    return _finish(g, keys, "__ws", "__we", carry, value, total, with_avg)


# --- click analytics (chained windows) ------------------------------------

def clicks_per_key(clicks: DataFrame, key: str = "website", time_col: str = "ts",
                   size: str = "1 hour") -> DataFrame:
    """Clicks per key per tumbling window."""
    g = clicks.groupBy(key, F.window(time_col, size).alias("__w")).agg(
        F.count(F.lit(1)).alias("clicks"))
    return g.select(key, F.col("__w.start").alias("window_start"),
                    F.col("__w.end").alias("window_end"), "clicks")


def extreme_per_key(counts: DataFrame, kind: str = "max", key: str = "website",
                    size: str = "1 hour") -> DataFrame:
    """Second window over ``clicks_per_key`` output, keyed by the same key:
    each key's own max (min) count per window (the reference's literal form).

    ``size`` should be a multiple of the first window's size.
    """
    agg = F.max if kind == "max" else F.min
    g = counts.groupBy(key, F.window("window_start", size).alias("__w")).agg(
        agg("clicks").alias("clicks"))
    return g.select(key, F.col("__w.start").alias("window_start"),
                    F.col("__w.end").alias("window_end"), "clicks")


def extreme_key(counts: DataFrame, kind: str = "max", key: str = "website",
                size: str = "1 hour") -> DataFrame:
    """The key with the most (fewest) clicks per window, ties to the larger
    (smaller) key name: the reference's intended "website with max clicks"."""
    by = F.max_by if kind == "max" else F.min_by
    agg = F.max if kind == "max" else F.min
    g = counts.groupBy(F.window("window_start", size).alias("__w")).agg(
        by(key, F.struct("clicks", key)).alias(key), agg("clicks").alias("clicks"))
    return g.select(key, F.col("__w.start").alias("window_start"),
                    F.col("__w.end").alias("window_end"), "clicks")


def int_avg_per_key(clicks: DataFrame, key: str = "website", value: str = "time_spent",
                    time_col: str = "ts", size: str = "1 hour") -> DataFrame:
    """Integer (truncated) average of ``value`` per key per window."""
    g = clicks.groupBy(key, F.window(time_col, size).alias("__w")).agg(
        F.sum(value).cast("long").alias("__s"), F.count(F.lit(1)).alias("__n"))
    return g.select(key, F.col("__w.start").alias("window_start"),
                    F.col("__w.end").alias("window_end"),
                    F.expr("__s div __n").alias(f"avg_{value}"))
