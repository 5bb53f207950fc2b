"""What a checkpoint holds, as tables: counters, open windows, buffered rows.

Spark's state data source reads the state of a stopped (or running) query at its
last committed micro-batch.  The readers below name the state of this library's
processors, so a checkpoint can be checked against a batch result, exported, or
used as the initial state of another query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query: ``operatorId``, ``operatorName``, state stores and batches."""
    return spark.read.format("state-metadata").load(checkpoint)


def read_state(spark: SparkSession, checkpoint: str, variable: str, operator: int = 0,
               batch: int | None = None) -> DataFrame:
    """One state variable of a processor: its key's columns, then its value's.

    ``variable``: such as ``count`` of a running count, ``open`` of a buffer or count
    window.  Lists give a row per element, maps a row per entry (``map_*`` columns).
    """
    r = spark.read.format("statestore").option("path", checkpoint).option("operatorId", str(operator))
    r = r.option("stateVarName", variable)
    if batch is not None:
        r = r.option("batchId", str(batch))
    df = r.load()
    cols = []
    for name in ("key", "user_map_key", "value", "list_element", "user_map_value"):
        if name in df.columns:
            inner = df.select(f"{name}.*").columns
            mark = "map_" if name == "user_map_key" else ""
            cols += [F.col(f"{name}.{c}").alias(f"{mark}{c}") for c in inner]
    return df.select(*cols)


def counters(spark: SparkSession, checkpoint: str, key: str, operator: int = 0) -> DataFrame:
    """``key, count`` of a running count (``processors.RunningCount``, ``rules.StartedCount``)."""
    found = read_state(spark, checkpoint, "count", operator)
    return found.toDF(key, "count")


def remainders(spark: SparkSession, checkpoint: str, keys: Sequence[str], operator: int = 0) -> DataFrame:
    """Rows that wait in a buffer or in an open count window: the key, then the row's columns."""
    found = read_state(spark, checkpoint, "open", operator)
    return found.toDF(*keys, *found.columns[len(keys):])
