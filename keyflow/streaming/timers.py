"""Windows in processing time, closed by timers.

A window of rows as they arrive must close when its time is over, also if no
further row comes.  Each key keeps one running reduction per open window and a
processing-time timer at the window's end; when the timer fires, the window is
emitted and forgotten.  Spark looks at timers with every micro-batch and starts
micro-batches without rows for them, so a stream that falls silent still emits
its last windows, once.

Tumbling and sliding windows are aligned to the epoch.  A session closes when no
row came for ``gap``: every micro-batch that brings rows moves its timer.
Reductions are exact for integers: sums as LONG.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keyflow.functions.number import is_whole
from keyflow.plans.time import interval_micros
from keyflow.streaming.processors import _collect, _ddl, _Numbers, _plain

_ALL = "kf_all"


def _millis(interval: str) -> int:
    us = interval_micros(interval)
    if us <= 0 or us % 1000:
        raise ValueError(f"a processing-time interval is whole milliseconds, not {interval!r}")
    return us // 1000


class _Windows(StatefulProcessor):
    """Reductions of a key's open windows, by the window's start."""

    def __init__(self, key: str, value: str, order: Sequence[str], carry: Sequence[str], carry_ddl: str, whole: bool):
        self.key, self.value, self.order = key, value, list(order)
        self.carry, self.carry_ddl, self.num = list(carry), carry_ddl, _Numbers(whole)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = f"until LONG, total {self.num.ddl}, n LONG"
        self.open = handle.getMapState("open", "start LONG", ", ".join(filter(None, [fields, self.carry_ddl])))

    def _add(self, start: int, until: int, df: pd.DataFrame) -> None:
        """Take rows into the window that begins at ``start``."""
        v, there = self.num.read(df[self.value].tolist())
        total = self.num.py(v.sum()) if there.any() else None
        if self.open.containsKey((start,)):
            _, before, n, *first = self.open.getValue((start,))
            total = before if total is None else total if before is None else before + total
        else:
            n, first = 0, [c[0] for c in _plain(df.iloc[:1], self.carry, self.carry_ddl)]
        self.open.updateValue((start,), (until, total, n + len(df), *first))

    def _emit(self, key: tuple, start: int) -> pd.DataFrame:
        until, total, n, *first = self.open.getValue((start,))
        self.open.removeKey((start,))
        out = {self.key: [key[0]], "start_ms": [start], "end_ms": [until]}
        out |= {c: [x] for c, x in zip(self.carry, first)}
        return pd.DataFrame(out | {"total": pd.Series([total], dtype=object), "n": [n]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        due = [s[0] for s, w in self.open.iterator() if w[0] <= now]
        for start in sorted(due):
            yield self._emit(key, start)

    def close(self) -> None:
        pass


class TimeWindow(_Windows):
    """Tumbling (``slide == size``) and sliding windows of the time at which rows are processed."""

    def __init__(self, size: int, slide: int, *args):
        super().__init__(*args)
        self.size, self.slide = size, slide

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.slide
        while start > now - self.size:
            if not self.open.containsKey((start,)):
                self.handle.registerTimer(start + self.size)
            self._add(start, start + self.size, df)
            start -= self.slide
        yield from ()


class TimeSession(_Windows):
    """A session of rows with less than ``gap`` between the times at which they are processed."""

    def __init__(self, gap: int, *args):
        super().__init__(*args)
        self.gap = gap

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now
        for s, w in list(self.open.iterator()):
            if w[0] > now:
                start = s[0]
                self.handle.deleteTimer(w[0])
            else:  # it is over, though its timer has not been looked at yet
                self.handle.deleteTimer(w[0])
                yield self._emit(key, s[0])
        self.handle.registerTimer(now + self.gap)
        self._add(start, now + self.gap, df)


def _run(df: DataFrame, make, value: str, order: Sequence[str], key: str | None, carry: Sequence[str], total: str) -> DataFrame:
    by = key or _ALL
    d = df if key else df.withColumn(_ALL, F.lit(0))
    number = T.LongType() if is_whole(df, value) else T.DoubleType()
    schema = T.StructType([d.schema[by], T.StructField("start_ms", T.LongType()), T.StructField("end_ms", T.LongType()),
                           *[df.schema[c] for c in carry], T.StructField("total", number), T.StructField("n", T.LongType())])
    proc = make(by, value, order, carry, _ddl(df, carry), is_whole(df, value))
    out = d.groupBy(by).transformWithStateInPandas(proc, schema, "append", "ProcessingTime")
    return out.select(*([key] if key else []), F.timestamp_millis("start_ms").alias("window_start"),
                      F.timestamp_millis("end_ms").alias("window_end"), *carry, F.col("total").alias(total), "n")


def processing_windows(df: DataFrame, size: str, value: str, order: Sequence[str], slide: str | None = None,
                       key: str | None = None, carry: Sequence[str] = (), total: str = "total") -> DataFrame:
    """Sum, count and first row's fields per key and window of processing time, emitted when the window is over.

    Without ``key`` one task holds the (constant) state of all windows; the rows of a
    micro-batch pass through it, so bound the micro-batch or pass a key.
    """
    ms = _millis(size)
    step = _millis(slide) if slide else ms
    if step > ms:
        raise ValueError("slide must not exceed size")
    return _run(df, lambda *a: TimeWindow(ms, step, *a), value, order, key, carry, total)


def processing_sessions(df: DataFrame, gap: str, value: str, order: Sequence[str], key: str | None = None,
                        carry: Sequence[str] = (), total: str = "total") -> DataFrame:
    """Sum, count and first row's fields per key and session of processing time, emitted ``gap`` after its last row."""
    ms = _millis(gap)
    return _run(df, lambda *a: TimeSession(ms, *a), value, order, key, carry, total)
