"""A feedback edge on live input: rows that are not done come back with the next micro-batch.

Epoch ``N`` takes its new rows and the rows epoch ``N - 1`` left unfinished,
runs ``rounds`` rounds of ``step`` over them, writes what is done under
``path/epoch=N`` and leaves the rest for epoch ``N + 1``.  The rest is a table
per epoch (``versions``), so a replayed or restarted epoch sees the same rows and
gives the same output.

Rows can only come back when a micro-batch runs.  ``start_feedback`` therefore
reads a clock beside the input, which starts one every ``tick`` also while the
input is silent.  ``drain`` finishes what a stopped query left.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keyflow.operators.iterate import iterate
from keyflow.plans.time import interval_micros
from keyflow.session import checkpoint_dir
from keyflow.streaming.versions import Versioned

_TICK = "kf_tick"

Step = Callable[[DataFrame], DataFrame]
Done = Callable[[DataFrame], Column]


def _base(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return (checkpoint or os.path.join(checkpoint_dir(spark), "queries", name)).rstrip("/")


def _rounds(live: DataFrame, step: Step, done: Done, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Rows done within ``rounds`` rounds, and the others, from one frame that is computed once.

    A row that is done passes through further rounds unchanged.
    """
    columns = live.columns
    d = live.withColumn("kf_done", done(live))
    for _ in range(rounds):
        moved = step(d.where(~F.col("kf_done")).select(*columns)).select(*columns)
        d = d.where("kf_done").unionByName(moved.withColumn("kf_done", done(moved)))
    return d.where("kf_done").drop("kf_done"), d.where("NOT kf_done").drop("kf_done")


def start_feedback(stream: DataFrame, step: Step, done: Done, path: str, name: str, rounds: int = 1,
                   tick: str = "1 second", checkpoint: str | None = None) -> StreamingQuery:
    """Start the loop; it runs until stopped.  ``step`` must not change rows that are ``done``'s."""
    spark = stream.sparkSession
    base = _base(spark, name, checkpoint)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in stream.schema])
    waiting = Versioned(f"{base}/waiting", schema)
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.lit(True).alias(_TICK))
    both = stream.withColumn(_TICK, F.lit(False)).unionByName(clock, allowMissingColumns=True)

    def run(batch: DataFrame, epoch: int) -> None:
        new = batch.where(~F.col(_TICK)).drop(_TICK)
        live = new.unionByName(waiting.before(batch.sparkSession, epoch)).persist()
        try:
            finished, rest = _rounds(live, step, done, rounds)
            finished.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
            waiting.write(rest, epoch)
        finally:
            live.unpersist()

    return (both.writeStream.foreachBatch(run).option("checkpointLocation", f"{base}/stream").queryName(name)
            .trigger(processingTime=f"{interval_micros(tick) // 1000} milliseconds").start())


def unfinished(spark: SparkSession, name: str, schema: T.StructType, checkpoint: str | None = None) -> DataFrame:
    """The rows that the last committed epoch of a stopped loop left."""
    base = _base(spark, name, checkpoint)
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/stream/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    epochs = [int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit()]
    return Versioned(f"{base}/waiting", schema).at(spark, max(epochs))


def drain(spark: SparkSession, name: str, schema: T.StructType, step: Step, done: Done, max_iter: int,
          checkpoint: str | None = None) -> DataFrame:
    """What the rows left by a stopped loop become, by the bounded batch loop."""
    return iterate(unfinished(spark, name, schema, checkpoint), step, done, max_iter)
