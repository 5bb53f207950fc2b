"""Small helpers shared by the text operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.session import checkpoint_dir

#: the six ASCII white-space characters that part words
SPACE = " \t\n\x0b\f\r"
SPACE_RE = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared checkpoint folder and read it back.

    Compressed and columnar, so later readers fetch only what they need, and
    any executor can be lost afterwards without recomputing ``df``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/keyflow-{uuid.uuid4().hex}"
    df.write.parquet(path)
    free_shuffles(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._keyflow_saved = (path, None)
    return out


def save_bucketed(df: DataFrame, key: str) -> DataFrame:
    """``save`` as a table bucketed by ``key``: later joins on it move only the other side."""
    spark = df.sparkSession
    name = f"keyflow_{uuid.uuid4().hex}"
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    free_shuffles(spark)
    out = spark.table(name)
    out._keyflow_saved = (path, name)
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables written by ``save`` or ``save_bucketed`` once all that reads them has been written itself."""
    for df in tables:
        spark, (path, name) = df.sparkSession, df._keyflow_saved
        if name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that no DataFrame needs any more.

    Its cleaner learns of them from the driver's garbage collector, which may
    not run for half an hour; until then they fill the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def words(c: Column) -> Column:
    """White-space words of a text; none for null, empty or blank texts."""
    t = F.trim(F.coalesce(c, F.lit("")), F.lit(SPACE))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RE))


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so extra columns never clash with its own."""
    return df.select(*[df[n] for n in names])
