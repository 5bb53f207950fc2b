"""Small tables that one micro-batch leaves for the next, by epoch.

Epoch ``N`` reads exactly what epoch ``N - 1`` wrote and writes its own folder
with overwrite, so a replayed micro-batch finds the same input and leaves the
same result.  A failing read fails the micro-batch; nothing restarts silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Versioned:
    """A table under ``path`` with one version per epoch; before the first it is empty."""

    def __init__(self, path: str, schema: T.StructType | str):
        self.path, self.schema = path.rstrip("/"), schema

    def before(self, spark: SparkSession, epoch: int) -> DataFrame:
        """What the epoch before ``epoch`` left."""
        if epoch == 0:
            return spark.createDataFrame([], self.schema)
        return self.at(spark, epoch - 1)

    def at(self, spark: SparkSession, epoch: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/epoch={epoch}")

    def write(self, df: DataFrame, epoch: int) -> DataFrame:
        """Write the version of ``epoch`` and read it back; drop the one no replay can need."""
        df.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")
        if epoch > 1:
            old = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{self.path}/epoch={epoch - 2}")
            old.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(old, True)
        return self.at(df.sparkSession, epoch)
