"""Distinct values per key on live input, counted record by record.

Step one is keyed by (key, value) and remembers only that the pair was seen: a
value costs one entry of state, looked up by its key, and a key with a billion
values is spread over all tasks.  It marks each record as the pair's first or
not.  Step two is keyed by the key alone, puts its records in arrival order and
adds the marks up: its state is one counter.

``ttl`` forgets a pair that had no record for that long (processing time); the
count then rises again with its next record, so it is a count of values per
rolling presence, not since the start.  With ``ttl`` the query runs until it is
stopped: Spark keeps starting micro-batches for it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keyflow.plans.time import interval_micros
from keyflow.streaming.processors import _collect, _schema

_NEW = "kf_new"


class FirstSeen(StatefulProcessor):
    """Marks a pair's first record.  State: that the pair was seen."""

    def __init__(self, cols: Sequence[str], order: Sequence[str], counts: str, ttl: int | None):
        self.cols, self.order, self.counts, self.ttl = list(cols), list(order), counts, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "yes BOOLEAN", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        new = np.zeros(len(df), dtype="int64")
        # a missing value is no value, as in COUNT(DISTINCT)
        if df[self.counts].notna().iloc[0]:
            new[0] = not self.seen.exists()
            self.seen.update((True,))
        yield df[self.cols].assign(**{_NEW: new})

    def close(self) -> None:
        pass


class RunningMarks(StatefulProcessor):
    """Running sum of the marks per key.  State: the sum."""

    def __init__(self, key: str, order: Sequence[str], out: str):
        self.key, self.order, self.out = key, list(order), out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "c LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        c0 = self.count.get()[0] if self.count.exists() else 0
        c = c0 + np.cumsum(df[_NEW].to_numpy(dtype="int64"))
        self.count.update((int(c[-1]),))
        yield pd.DataFrame({self.key: [key[0]] * len(df)} | {o: df[o].to_numpy() for o in self.order} | {self.out: c})

    def close(self) -> None:
        pass


def distinct_stream(df: DataFrame, key: str, value: str, order: Sequence[str], out: str = "distinct_count",
                    ttl: str | None = None) -> DataFrame:
    """Per record the number of distinct ``value`` of its key so far: ``key, order..., out``."""
    cols = [key, *order]
    d = df.select(*dict.fromkeys([*cols, value]))
    mode = "ProcessingTime" if ttl else "None"
    first = FirstSeen(cols, order, value, interval_micros(ttl) // 1000 if ttl else None)
    marked = d.groupBy(key, value).transformWithStateInPandas(
        first, _schema(d, cols, [T.StructField(_NEW, T.LongType())]), "append", mode)
    return marked.groupBy(key).transformWithStateInPandas(
        RunningMarks(key, order, out), _schema(d, cols, [T.StructField(out, T.LongType())]), "append", mode)
