"""Number sequences (both ends inclusive, like the reference's generator)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sequence(spark: SparkSession, start: int, end: int, streaming: bool = False,
             rows_per_batch: int = 1) -> DataFrame:
    """``start..end`` inclusive as column ``value`` (LONG).

    The streaming form uses the ``rate-micro-batch`` source and stops growing
    meaningfully only by the caller's filter ``value <= end``.
    """
    if not streaming:
        return spark.range(start, end + 1).select(F.col("id").alias("value"))
    s = (spark.readStream.format("rate-micro-batch")
         .option("rowsPerBatch", str(rows_per_batch)).load())
    return s.select((F.col("value") + start).alias("value")).where(F.col("value") <= end)
