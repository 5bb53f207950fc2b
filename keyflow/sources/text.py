"""Delimited text lines: the reference jobs' only record format.

``read_lines`` reads a file (batch) or a directory of files (stream) into a
``value`` column; live sources (socket, kafka) give the same single column and
plug into the same parsers.  ``to_lines`` renders columns as such lines,
which is how the tests derive text input from the parquet tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# sentinel the trip layout uses for a missing field (fixed value)
NULL_TEXT = "'null'"


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    if not streaming:
        return spark.read.text(path)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def with_line_number(lines: DataFrame) -> DataFrame:
    """Adds ``line``: the row's place among those its task read, live or in batch.

    A task reads the lines of a split one after the other, so with the file and the
    split's start this is the order of lines; a replayed micro-batch reads the same
    splits.  (Spark's own row ids are refused on live input.)
    """
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(range(n, n + len(b)), pa.int64())], [*b.schema.names, "line"])
            n += len(b)

    return lines.mapInArrow(number, T.StructType([*lines.schema, T.StructField("line", T.LongType())]))


def to_lines(df: DataFrame, cols: Sequence[str | Column], sep: str = ",",
             keep: Sequence[str] = ()) -> DataFrame:
    """One ``value`` line per row; nulls written as the ``'null'`` sentinel.

    ``keep`` columns are carried next to ``value`` (e.g. the arrival order).
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"),
                        F.lit(NULL_TEXT)) for c in cols]
    return df.select(*keep, F.concat_ws(sep, *parts).alias("value"))
