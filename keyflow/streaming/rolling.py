"""Rolling aggregates on live input (update mode).

Spark's sink contract emits one row per *changed key per micro-batch*
(the reference emits one per record; for per-record output use the
processors in ``keyflow.streaming.processors``).  State is one aggregation
buffer per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.plans.scan import as_long


def rolling_update(df: DataFrame, key: str, value: str, kind: str,
                   order: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """Running sum / min / max (``kind``) per key, first-row carry fields;
    min_by / max_by (``kind='min_by'|'max_by'``) return the whole holding record."""
    aggs = []
    if kind in ("sum", "min", "max"):
        fn = {"sum": F.sum, "min": F.min, "max": F.max}[kind]
        aggs.append(fn(value).alias(f"{kind}_{value}"))
        if carry:
            first = F.struct(*[F.col(o) for o in order], *[F.col(c) for c in carry])
            aggs.append(F.min(first).alias("__first"))
        g = df.groupBy(key).agg(*aggs)
        return g.select(key, *[F.col(f"__first.{c}").alias(c) for c in carry], f"{kind}_{value}")
    rec = F.struct(*[F.col(c) for c in carry])
    # ties go to the earliest record: for the maximum the order counts backwards
    at = [as_long(df, o) for o in order]
    cmp = F.struct(F.col(value), *(at if kind == "min_by" else [-o for o in at]))
    cmp = F.when(F.col(value).isNotNull(), cmp)
    by = F.min_by if kind == "min_by" else F.max_by
    g = df.groupBy(key).agg(by(rec, cmp).alias("__held"), (F.min if kind == "min_by" else F.max)(value).alias(value))
    return g.select(key, *[F.col(f"__held.{c}").alias(c) for c in carry], value)


def running_avg_update(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg((F.sum(value) / F.count(F.lit(1))).alias(f"avg_{value}"),
                               F.count(F.lit(1)).alias("n"))


def distinct_count_update(df: DataFrame, key: str, item: str, exact: bool = True,
                          watermark_col: str | None = None) -> DataFrame:
    """Distinct ``item`` per ``key``: exact via de-duplication (state = the
    distinct pairs; bound it with ``dropDuplicatesWithinWatermark`` when a
    watermark is set) or approximate with a fixed-size sketch."""
    if not exact:
        return df.groupBy(key).agg(F.approx_count_distinct(item).alias("distinct_count"))
    if watermark_col:
        d = df.dropDuplicatesWithinWatermark([key, item])
    else:
        d = df.dropDuplicates([key, item])
    return d.groupBy(key).agg(F.count(F.lit(1)).alias("distinct_count"))


def website_metrics_update(clicks: DataFrame, key: str = "website") -> DataFrame:
    """Running website metrics on live input (update mode): clicks, total time,
    average time (0 when empty) and distinct users from a fixed-size sketch.
    Exact distinct counts need their own de-duplicating query
    (``distinct_count_update``): de-duplication would drop the repeat clicks
    the other metrics count."""
    return clicks.groupBy(key).agg(
        F.count(F.lit(1)).alias("clicks"),
        F.sum("time_spent").cast("long").alias("total_time"),
        F.approx_count_distinct("user_id").alias("distinct_users_approx"),
        F.coalesce(F.try_divide(F.sum("time_spent").cast("long"), F.count(F.lit(1))),
                   F.lit(0.0)).alias("avg_time"))
