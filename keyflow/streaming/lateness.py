"""Exact late rows on live input: the watermark a row sees is that of the rows before it, also within a micro-batch.

Spark drops rows against the watermark of the micro-batch before.  Here every
micro-batch takes its rows in arrival order and gives each the running maximum
of event time before it, less ``bound``: a distributed prefix scan that starts
from the maximum the batch before left (one number).  So which rows are late
does not depend on how rows fall into micro-batches, and equals
``operators.lateness``.

Late rows are a side output.  Rows in time are reduced into their windows; the
open windows' partial sums go from epoch to epoch as a small table (one row per
key and open window), and a window is emitted once, by the micro-batch whose
rows move the watermark past its end.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keyflow.functions.number import wide
from keyflow.functions.time import epoch_micros
from keyflow.plans.scan import Agg, prefix_scan
from keyflow.plans.time import interval_micros
from keyflow.session import checkpoint_dir
from keyflow.streaming.versions import Versioned


def _end(time_us: Column, size: int) -> Column:
    return time_us - F.pmod(time_us, F.lit(size)) + F.lit(size)


def _at(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def start_exact_windows(stream: DataFrame, time_col: str, arrival: Sequence[str], size: str, bound: str, value: str,
                        path: str, name: str, keys: Sequence[str] = (), checkpoint: str | None = None,
                        available_now: bool = False, interval: str | None = "1 second") -> StreamingQuery:
    """Tumbling sums per key, exact late rows aside.

    Writes ``path/windows/epoch=N`` (keys, window_start, window_end, total, n) and
    ``path/late/epoch=N`` (the late rows with the ``watermark`` each met).
    """
    base = checkpoint or os.path.join(checkpoint_dir(stream.sparkSession), "queries", name)
    size_us, bound_us = interval_micros(size), interval_micros(bound)
    keys = list(keys)
    whole = wide(stream, value)
    number = stream.select(whole.alias("x")).schema["x"].dataType
    number = number if isinstance(number, T.DecimalType) else T.LongType() if isinstance(number, T.LongType) else T.DoubleType()
    open_schema = T.StructType([*[stream.schema[k] for k in keys], T.StructField("kf_end", T.LongType()),
                                T.StructField("total", number), T.StructField("n", T.LongType())])
    clock = Versioned(f"{base}/clock", "latest LONG")
    windows = Versioned(f"{base}/open", open_schema)

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        row = clock.before(spark, epoch).agg(F.max("latest")).first()
        latest = F.lit(row[0]).cast("long")
        rows = batch.withColumn("kf_us", epoch_micros(time_col))
        seen = prefix_scan(rows, [], list(arrival), [Agg("kf_seen", "max", F.col("kf_us"))], inclusive=False)
        mark = F.greatest("kf_seen", latest) - F.lit(bound_us)
        flagged = seen.withColumn("kf_mark", mark).withColumn(
            "kf_late", F.coalesce(_end(F.col("kf_us"), size_us) <= F.col("kf_mark"), F.lit(False)))
        # one computation of the micro-batch for its outputs
        flagged = flagged.persist()
        try:
            late = flagged.where("kf_late").withColumn("watermark", _at(F.col("kf_mark")))
            late.select(*batch.columns, "watermark").write.mode("overwrite").parquet(f"{path}/late/epoch={epoch}")
            on_time = flagged.where(~F.col("kf_late") & F.col("kf_us").isNotNull())
            now = on_time.groupBy(*keys, _end(F.col("kf_us"), size_us).alias("kf_end")).agg(
                F.sum(whole).cast(number).alias("total"), F.count(F.lit(1)).alias("n"))
            known = now.unionByName(windows.before(spark, epoch)).groupBy(*keys, "kf_end").agg(
                F.sum("total").cast(number).alias("total"), F.sum("n").alias("n")).persist()
            top = flagged.agg(F.greatest(F.max("kf_us"), latest).alias("latest")).first()[0]
            clock.write(spark.createDataFrame([(top,)], "latest LONG"), epoch)
            over = F.col("kf_end") <= F.lit(None if top is None else top - bound_us).cast("long")
            over = F.coalesce(over, F.lit(False))
            known.where(over).select(*keys, _at(F.col("kf_end") - size_us).alias("window_start"),
                                     _at(F.col("kf_end")).alias("window_end"), "total", "n").write.mode(
                "overwrite").parquet(f"{path}/windows/epoch={epoch}")
            windows.write(known.where(~over), epoch)
            known.unpersist()
        finally:
            flagged.unpersist()

    w = (stream.writeStream.foreachBatch(run).option("checkpointLocation", os.path.join(base, "stream")).queryName(name))
    if available_now:
        w = w.trigger(availableNow=True)
    elif interval:
        w = w.trigger(processingTime=interval)
    return w.start()


def open_windows(spark, checkpoint: str, epoch: int, schema: T.StructType | str) -> DataFrame:
    """The windows that epoch ``epoch`` left open, with their partial sums (``kf_end``: epoch microseconds)."""
    return Versioned(f"{checkpoint}/open", schema).at(spark, epoch)
