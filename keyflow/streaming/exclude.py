"""Live exclusion with rules that change while the stream runs.

The rule table is re-read at every micro-batch, so a rule added between
batches applies from the next batch on (a rule only affects records that
arrive after it, as in the reference).  Per-key running counts continue
across batches through a counter table kept in the shared checkpoint
folder: batch ``N`` reads the counters that batch ``N - 1`` left, numbers its own surviving rows per key in arrival order (hot-key safe
ordinal) and writes both its output and the new counters under
``epoch=N``, overwriting on replay, so a re-run batch gives the same result
(exactly-once output without in-memory state).  The counter table has one
row per key.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyflow.operators.exclude import exclude
from keyflow.plans.scan import row_ordinal
from keyflow.session import checkpoint_dir


def _counts_before(spark: SparkSession, state: str, epoch: int, key: str) -> DataFrame | None:
    """The counters that the batch before ``epoch`` left.

    Exactly that batch's folder is read, and a failing read fails the batch
    (Spark then replays it): counts never restart silently.
    """
    if epoch == 0:
        return None
    return spark.read.parquet(f"{state}/epoch={epoch - 1}").select(
        F.col(key).alias("__key"), F.col("count").alias("__prev"))


def _drop(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exclude_running_count_live(stream: DataFrame, load_rules: Callable[[SparkSession], DataFrame],
                               key: str, order: Sequence[str], out_path: str, name: str,
                               id_col: str = "id", checkpoint: str | None = None,
                               available_now: bool = False) -> StreamingQuery:
    """Start the query; output rows ``key, order..., count`` under ``out_path/epoch=N``."""
    base = checkpoint or os.path.join(checkpoint_dir(stream.sparkSession), "queries", name)
    state = f"{base.rstrip('/')}/counts"

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        kept = exclude(batch, load_rules(spark), id_col=id_col)
        numbered = row_ordinal(kept, [key], list(order), name="__rn")
        prev = _counts_before(spark, state, epoch_id, key)
        if prev is not None:
            numbered = numbered.join(prev, F.col(key).eqNullSafe(F.col("__key")), "left")
        else:
            numbered = numbered.withColumn("__prev", F.lit(None).cast("long"))
        out = numbered.select(key, *order,
                              (F.coalesce(F.col("__prev"), F.lit(0)) + F.col("__rn")).alias("count"))
        written = f"{out_path.rstrip('/')}/epoch={epoch_id}"
        out.write.mode("overwrite").parquet(written)
        # from the rows just written, so the batch is computed once
        counts = spark.read.schema(out.schema).parquet(written).groupBy(key).agg(F.max("count").alias("count"))
        if prev is not None:
            carried = prev.select(F.col("__key").alias(key), F.col("__prev").alias("count"))
            counts = carried.unionByName(counts).groupBy(key).agg(F.max("count").alias("count"))
        counts.write.mode("overwrite").parquet(f"{state}/epoch={epoch_id}")
        if epoch_id > 1:  # a replay needs the batch before this one at most
            _drop(spark, f"{state}/epoch={epoch_id - 2}")

    w = (stream.writeStream.foreachBatch(run)
         .option("checkpointLocation", os.path.join(base, "stream")).queryName(name))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
