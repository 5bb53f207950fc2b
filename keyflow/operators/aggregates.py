"""Keyed group aggregates: trips analytics, profit per month, website metrics.

All are plain ``groupBy().agg()``: Spark aggregates partially per task
(map-side combine) before the shuffle, so hot keys cost one partial row per
task, not one row per record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.operators.rolling import running_sum_count
from keyflow.plans.scan import Agg, prefix_scan


def passengers_per_destination(trips: DataFrame) -> DataFrame:
    """Total passengers per drop-off (the reference's "popular destinations")."""
    return trips.groupBy("dropoff").agg(
        F.sum("passengers").cast("long").alias("total_passengers"))


def passengers_per_destination_running(trips: DataFrame, order: Sequence[str] = ("id",),
                                       **scan_opts) -> DataFrame:
    """Running passengers per drop-off after every trip (the per-record form)."""
    r = prefix_scan(trips, ["dropoff"], list(order),
                    [Agg("total_passengers", "sum", F.col("passengers").cast("long"))],
                    **scan_opts)
    return r.select("dropoff", *order, "total_passengers")


def top_destinations(trips: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` drop-offs with most passengers (ties by name).  A top-k report."""
    totals = passengers_per_destination(trips)
    return totals.orderBy(F.desc("total_passengers"), F.asc("dropoff")).limit(k)


def avg_passengers_by(trips: DataFrame, key: str) -> DataFrame:
    """Average passengers per ``key`` (double), plus trips per key.

    A null key (trip without pickup) is its own group.
    """
    return trips.groupBy(key).agg(
        (F.sum("passengers").cast("long") / F.count(F.lit(1))).alias("avg_passengers"),
        F.count(F.lit(1)).alias("trips"))


def avg_passengers_by_running(trips: DataFrame, key: str, order: Sequence[str] = ("id",),
                              **scan_opts) -> DataFrame:
    r = running_sum_count(trips, key, "passengers", list(order), **scan_opts)
    return r.select(key, *order, F.col("running_avg").alias("avg_passengers"),
                    F.col("running_count").alias("trips"))


def profit_per_month(profit: DataFrame) -> DataFrame:
    """Profit sum, record count and average per month (the fold's intent)."""
    return profit.groupBy("month").agg(
        F.sum("profit").cast("long").alias("profit_sum"),
        F.count(F.lit(1)).alias("n"),
        (F.sum("profit").cast("long") / F.count(F.lit(1))).alias("avg_profit"))


def website_metrics(clicks: DataFrame) -> DataFrame:
    """Clicks, total time, distinct users and average time per website.

    Average is 0 for a website without clicks (guarded division).
    """
    return clicks.groupBy("website").agg(
        F.count(F.lit(1)).alias("clicks"),
        F.sum("time_spent").cast("long").alias("total_time"),
        F.count_distinct("user_id").alias("distinct_users"),
        F.coalesce(F.try_divide(F.sum("time_spent").cast("long"), F.count(F.lit(1))),
                   F.lit(0.0)).alias("avg_time"))


def website_metrics_partials(clicks: DataFrame, time_col: str = "ts",
                             slot: str = "1 hour") -> DataFrame:
    """Mergeable partial accumulators per (website, time slot, user).

    Keeping the user in the partial key makes the distinct count mergeable
    exactly without holding any set in one row.
    """
    return (clicks.groupBy("website", F.window(time_col, slot).start.alias("slot"), "user_id")
            .agg(F.count(F.lit(1)).alias("clicks"),
                 F.sum("time_spent").cast("long").alias("total_time")))


def merge_website_metrics(partials: DataFrame) -> DataFrame:
    """Merge partial accumulators into the same metrics as ``website_metrics``."""
    return partials.groupBy("website").agg(
        F.sum("clicks").cast("long").alias("clicks"),
        F.sum("total_time").cast("long").alias("total_time"),
        F.count_distinct("user_id").alias("distinct_users"),
        F.coalesce(F.try_divide(F.sum("total_time"), F.sum("clicks")),
                   F.lit(0.0)).alias("avg_time"))


def website_metrics_sketch(clicks: DataFrame, time_col: str = "ts",
                           slot: str = "1 hour") -> DataFrame:
    """Approximate roll-up for incremental use: HLL sketches per slot, unioned."""
    parts = clicks.groupBy("website", F.window(time_col, slot).start.alias("slot")).agg(
        F.count(F.lit(1)).alias("clicks"), F.sum("time_spent").cast("long").alias("total_time"),
        F.hll_sketch_agg("user_id").alias("users_sketch"))
    return parts.groupBy("website").agg(
        F.sum("clicks").alias("clicks"), F.sum("total_time").alias("total_time"),
        F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias("distinct_users_approx"))


