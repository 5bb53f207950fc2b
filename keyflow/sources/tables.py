"""Record views over the test tables.

Each view has the record layout one of the analytics jobs reads (profit,
timed number, keyed number, trip, click, employee, exclusion rule, integer),
built with column expressions only, so scans prune columns and push filters.
Money and durations are integer cents: float sums depend on summation order,
integer sums do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.functions.time import month_name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 100).cast("long")


def profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profit records ``date, month, category, product, profit`` (no order)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.date_format("l_shipdate", "dd-MM-yyyy").alias("date"),
        month_name("l_shipdate").alias("month"),
        F.col("l_returnflag").alias("category"),
        F.col("l_linestatus").alias("product"),
        cents("l_extendedprice").cast("int").alias("profit"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profit records in arrival order ``(ts, event_id)``, keyed by month.

    All test events fall in one month, so the key is maximally hot: every
    keyed operator on this view must survive one key holding all rows.
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts",
        month_name("ts").alias("month"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("product"),
        cents("value").cast("int").alias("profit"),
    )


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed numbers ``event_id, ts, num`` (event time, ascending)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", cents("value").alias("num"))


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed numbers ``event_id, ts, key, num``; arrival order ``(ts, event_id)``."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", F.col("user_id").alias("key"),
                     cents("value").alias("num"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click records; arrival order ``(ts, event_id)``."""
    ev = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    return ev.select(
        "event_id", "ts",
        F.concat(F.lit("u"), uid.cast("string")).alias("user_id"),
        F.concat(F.lit("net"), (uid % 4).cast("string")).alias("network"),
        F.concat_ws(".", F.lit("10"), (uid % 256).cast("string"),
                    (F.col("event_id") % 256).cast("string"), F.lit("1")).alias("ip"),
        F.when(uid % 3 == 0, "US").when(uid % 3 == 1, "IN").otherwise("DE").alias("country"),
        F.col("event_type").alias("website"),
        cents("value").cast("int").alias("time_spent"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip records; arrival order ``id``.  Some pickups / drop-offs are missing."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k = F.col("o_orderkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, c.c_nationkey == n.n_nationkey)
             .select(
                 k.alias("id"),
                 F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("license_plate"),
                 F.col("o_orderpriority").alias("car_type"),
                 F.concat(F.lit("D"), (F.col("o_custkey") % 50).cast("string")).alias("driver"),
                 (F.col("o_orderstatus") == "O").alias("ongoing"),
                 F.when(k % 11 == 0, F.lit(None).cast("string"))
                  .otherwise(F.col("n_name")).alias("pickup"),
                 F.when(k % 7 == 0, F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("Z"), (F.col("o_custkey") % 20).cast("string")))
                  .alias("dropoff"),
                 F.when(k % 7 == 0, 0).otherwise(k % 5 + 1).cast("int").alias("passengers"),
             ))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employee records ``id, department``; arrival order ``id``."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("department"))


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclusion rules ``id, effective_ts`` (arrival position of the rule)."""
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("id"),
        ((F.col("c_custkey") * 7919) % 1500).alias("effective_ts"))


def integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed integers ``event_id, n`` (negative odd values included)."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", (cents("value") - 20000).cast("int").alias("n"))
