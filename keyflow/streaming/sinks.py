"""Sinks: tuple text files, checkpointed queries, buffered groups, split outputs.

All streaming writes go through ``checkpointLocation`` (offset log, commit
log, state): a restarted query replays the uncommitted batch and the file
sink's commit log makes the output exactly-once.  Checkpoints belong in the
cluster's shared checkpoint folder (``keyflow.session.checkpoint_dir``).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyflow.functions.text import tuple_text
from keyflow.plans.scan import row_ordinal
from keyflow.session import checkpoint_dir


def as_tuple_text(df: DataFrame, cols: Sequence[str | Column] | None = None) -> DataFrame:
    """One ``(f0,f1,...)`` text line per row (column ``value``)."""
    return df.select(tuple_text(cols or df.columns).alias("value"))


def write_text(df: DataFrame, path: str, cols: Sequence[str | Column] | None = None,
               max_records_per_file: int | None = None) -> None:
    """Batch tuple-text sink; ``max_records_per_file`` rolls files by size."""
    w = as_tuple_text(df, cols).write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.text(path)


def start_query(df: DataFrame, path: str, name: str, fmt: str = "text",
                cols: Sequence[str | Column] | None = None, output_mode: str = "append",
                interval: str | None = "1 second", available_now: bool = False,
                checkpoint: str | None = None,
                max_records_per_file: int | None = None) -> StreamingQuery:
    """Start an exactly-once streaming write with a checkpoint every ``interval``.

    ``fmt='text'`` writes tuple text lines; any other file format writes the
    columns.  Files roll per micro-batch (the trigger interval) and by
    ``max_records_per_file``.
    """
    ck = checkpoint or os.path.join(checkpoint_dir(df.sparkSession), "queries", name)
    out = as_tuple_text(df, cols) if fmt == "text" else df
    w = (out.writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", ck).option("path", path).queryName(name))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if available_now:
        w = w.trigger(availableNow=True)
    elif interval:
        w = w.trigger(processingTime=interval)
    return w.start()


def buffered_sink(size: int, write_group: Callable[[DataFrame, int], None],
                  order: Sequence[str], key: str | None = None):
    """``foreachBatch`` function that hands rows over in groups of ``size``.

    Within each micro-batch rows are numbered in arrival ``order`` (per
    ``key`` if given) with the hot-key safe ordinal; ``grp = (rn-1) div size``.
    The last, partial group of a batch is flushed with the batch (a replayed
    batch re-creates the same groups, so no buffer has to be saved).
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        keys = [key] if key else []
        numbered = row_ordinal(batch, keys, list(order))
        write_group(numbered.withColumn("grp", F.expr(f"(rn - 1) div {size}")), epoch_id)
    return run


def write_split(df: DataFrame, predicates: Mapping[str, Column], paths: Mapping[str, str],
                name: str, checkpoint: str | None = None, fmt: str = "parquet",
                available_now: bool = False) -> StreamingQuery:
    """One pass over a stream, several outputs (side outputs): each micro-batch
    is persisted once and every named filter is written to its own path."""
    ck = checkpoint or os.path.join(checkpoint_dir(df.sparkSession), "queries", name)

    def run(batch: DataFrame, epoch_id: int) -> None:
        # one folder per micro-batch, overwritten on replay: exactly-once output
        batch.persist()
        try:
            for out, pred in predicates.items():
                (batch.where(pred).write.mode("overwrite").format(fmt)
                 .save(os.path.join(paths[out], f"epoch={epoch_id}")))
        finally:
            batch.unpersist()

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", ck).queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
