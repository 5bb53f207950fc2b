"""A sink's buffer on live input: rows are held until a group of ``size`` is full.

The open group of a key is list state, so it outlives micro-batches and
restarts: group borders depend on the arrival order alone, never on how many
files a trigger reads.  Groups are numbered per key, and a row carries its
group's number and its place in it; a replayed micro-batch gives the same
numbers, so a sink that writes by ``(key, grp)`` is idempotent.  Rows of the
last, open group stay in state (``streaming.state`` reads them back).

Without a key, rows are dealt over ``lanes`` buffers by their order columns, as
the parallel writers of a sink each hold a buffer of their own.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keyflow.plans.time import interval_micros
from keyflow.session import checkpoint_dir
from keyflow.streaming.processors import _collect, _ddl, _plain

LANE = "lane"


class Buffer(StatefulProcessor):
    """Holds rows of a key until ``size`` are there, then hands the whole group on.

    State: the number of full groups so far and the open group's rows (fewer than ``size``).
    """

    def __init__(self, key: str, cols: Sequence[str], ddl: str, order: Sequence[str], size: int):
        self.key, self.cols, self.ddl, self.order, self.size = key, list(cols), ddl, list(order), size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.groups = handle.getValueState("groups", "n LONG")
        self.open = handle.getListState("open", self.ddl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        done = self.groups.get()[0] if self.groups.exists() else 0
        kept = [tuple(r) for r in self.open.get()] if self.groups.exists() else []
        columns = [[k[i] for k in kept] + c for i, c in enumerate(_plain(df, self.cols, self.ddl))]
        n = len(kept) + len(df)
        full = n // self.size
        cut = full * self.size
        self.groups.update((done + full,))
        self.open.clear()
        if cut < n:
            self.open.put(list(zip(*[c[cut:] for c in columns])))
        if full:
            at = np.arange(cut, dtype="int64")
            out = {self.key: [key[0]] * cut}
            out |= {name: c[:cut] for name, c in zip(self.cols, columns)}
            out |= {"grp": done + at // self.size, "pos": at % self.size}
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def buffered_stream(df: DataFrame, order: Sequence[str], size: int, key: str | None = None,
                    lanes: int = 8) -> DataFrame:
    """The rows of every full group with ``grp`` (from 0, per key) and ``pos`` (from 0, per group)."""
    if key is None:
        key = LANE
        df = df.withColumn(LANE, F.pmod(F.xxhash64(*order), F.lit(lanes)).cast("int"))
    cols = [c for c in df.columns if c != key]
    schema = T.StructType([df.schema[key], *[df.schema[c] for c in cols],
                           T.StructField("grp", T.LongType()), T.StructField("pos", T.LongType())])
    return df.groupBy(key).transformWithStateInPandas(
        Buffer(key, cols, _ddl(df, cols), order, size), schema, "append", "None")


def start_buffered(df: DataFrame, order: Sequence[str], size: int, path: str, name: str, key: str | None = None,
                   lanes: int = 8, fmt: str = "parquet", checkpoint: str | None = None,
                   available_now: bool = False, interval: str | None = "1 second") -> StreamingQuery:
    """Write full groups under ``path/epoch=N``; a replayed epoch overwrites its own folder.

    A group is always whole: all its rows leave the buffer in one micro-batch.
    """
    ck = checkpoint or os.path.join(checkpoint_dir(df.sparkSession), "queries", name)

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(os.path.join(path, f"epoch={epoch_id}"))

    w = (buffered_stream(df, order, size, key, lanes).writeStream.foreachBatch(write)
         .option("checkpointLocation", ck).queryName(name))
    if available_now:
        w = w.trigger(availableNow=True)
    elif interval:
        w = w.trigger(processingTime=interval)
    return w.start()


class Parts(StatefulProcessor):
    """Numbers the output parts of a key's lines as they arrive.

    A part is full once its bytes reach ``max_bytes``, and over once ``idle``
    microseconds passed without a line; the next line then begins another.  State: the
    open part's number, its bytes and the time of its last line.
    """

    def __init__(self, key: str, line: str, at: str, cols: Sequence[str], order: Sequence[str], max_bytes: int,
                 idle: int | None):
        self.key, self.line, self.at, self.cols, self.order = key, line, at, list(cols), list(order)
        self.max_bytes, self.idle = max_bytes, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.part = handle.getValueState("part", "part LONG, bytes LONG, at LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        part, size, last = self.part.get() if self.part.exists() else (0, 0, None)
        parts = np.empty(len(df), dtype="int64")
        sizes = [1 + len(x.encode()) if isinstance(x, str) else 1 for x in df[self.line]]
        for i, (n, at) in enumerate(zip(sizes, df[self.at].tolist(), strict=True)):
            idle = self.idle is not None and last is not None and at - last >= self.idle
            if size and (size >= self.max_bytes or idle):
                part, size = part + 1, 0
            size, last = size + n, at
            parts[i] = part
        self.part.update((part, size, last))
        yield df[self.cols].assign(**{self.key: [key[0]] * len(df), "part": parts, "bytes": sizes})[
            [self.key, *self.cols, "part", "bytes"]]

    def close(self) -> None:
        pass


def rolled_stream(df: DataFrame, line: str, order: Sequence[str], max_bytes: int, at: str, idle: str | None = None,
                  key: str | None = None, lanes: int = 8) -> DataFrame:
    """Every row with its output ``part`` (per key or lane) and its ``bytes``; ``at``: LONG microseconds of arrival.

    Parts go on over micro-batches and restarts.  Write with ``partitionBy(key, "part")``.
    """
    if key is None:
        key = LANE
        df = df.withColumn(LANE, F.pmod(F.xxhash64(*order), F.lit(lanes)).cast("int"))
    cols = [c for c in df.columns if c != key]
    schema = T.StructType([df.schema[key], *[df.schema[c] for c in cols],
                           T.StructField("part", T.LongType()), T.StructField("bytes", T.LongType())])
    proc = Parts(key, line, at, cols, order, max_bytes, interval_micros(idle) if idle else None)
    return df.groupBy(key).transformWithStateInPandas(proc, schema, "append", "None")
