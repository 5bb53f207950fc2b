"""Per-key managed-state operators for live input (``transformWithStateInPandas``).

These are the streaming forms of the count windows and per-record counters
whose batch forms live in ``keyflow.operators.counts`` / ``exclude``.  Each
processor keeps only bounded state per key:

* ``CountWindow``      window number and the open window's numbers (at most
                       ``size - 1``);
* ``CountTrigger``     ordinal, running total, the first row's carry fields;
* ``CountEvictor``     ordinal and the last ``keep`` rows;
* ``RunningCount``     one counter;
* ``RollingReduce``    the running value and the held / first record.

Rows of one key reach ``handleInputRows`` as an iterator of pandas frames in
no particular order; every processor concatenates them and sorts by the
arrival-order columns before touching state.  Work inside a call is
vectorized with numpy; Spark shuffles the rows by key and checkpoints state
(RocksDB provider) with every micro-batch, so a restarted query resumes
exactly where the committed batch left off.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keyflow.functions.number import is_whole


def _collect(rows: Iterator[pd.DataFrame], order: Sequence[str]) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if not frames:
        return pd.DataFrame()
    df = pd.concat(frames, ignore_index=True)
    return df.sort_values(list(order), kind="stable").reset_index(drop=True)


class _Numbers:
    """How a processor reads and keeps numbers: LONG for integer columns, DOUBLE otherwise.

    A missing number counts as a row and takes no part in sums or extremes,
    as in the batch operators; a reduction of none is missing itself.
    """

    def __init__(self, whole: bool = True):
        self.ddl = "LONG" if whole else "DOUBLE"
        self.np, self.py = (np.int64, int) if whole else (np.float64, float)
        info = np.iinfo(np.int64) if whole else None
        self.low, self.high = (info.min, info.max) if whole else (-np.inf, np.inf)

    def read(self, values: Sequence) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where missing), and which are there."""
        there = pd.notna(pd.Series(values, dtype=object)).to_numpy()
        out = np.zeros(len(there), dtype=self.np)
        out[there] = [self.py(x) for x, ok in zip(values, there) if ok]
        return out, there

    def maybe(self, values: np.ndarray, there: np.ndarray) -> list:
        return [self.py(x) if ok else None for x, ok in zip(values, there)]


_WHOLE_DDL = ("tinyint", "smallint", "int", "bigint")


def _plain(df: pd.DataFrame, cols: Sequence[str], ddl: str) -> list[list]:
    """Columns as Python values for state: missing ones as None, integers as int
    (pandas turns integer columns with gaps into floats)."""
    kinds = dict(x.split(" ", 1) for x in ddl.split(", ")) if cols else {}
    out = []
    for c in cols:
        cast = int if kinds[c] in _WHOLE_DDL else (lambda x: x)
        out.append([None if x is None or x is pd.NaT or x != x else cast(x) for x in df[c].tolist()])
    return out


def _key_frame(key_names: Sequence[str], key: tuple, n: int) -> dict:
    return {k: [v] * n for k, v in zip(key_names, key)}


class CountWindow(StatefulProcessor):
    """Tumbling count window of ``size`` rows per key; emits full windows only.

    Output: keys, ``win`` (0-based), one column per reducer (LONG or DOUBLE, as
    the input), and ``items`` (the window's values as text, each preceded by a
    space) when ``as_text``.  Full windows are reduced along an axis at once.
    """

    def __init__(self, key_names: Sequence[str], value: str, order: Sequence[str],
                 size: int = 10, reducers: Sequence[str] = ("sum",), as_text: bool = False,
                 whole: bool = True):
        self.key_names, self.value, self.order = list(key_names), value, list(order)
        self.size, self.reducers, self.as_text = size, list(reducers), as_text
        self.num = _Numbers(whole)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.win = handle.getValueState("win", "win LONG")
        self.open = handle.getListState("open", f"x {self.num.ddl}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        win = self.win.get()[0] if self.win.exists() else 0
        kept = [r[0] for r in self.open.get()] if self.win.exists() else []
        v, there = self.num.read(kept + df[self.value].tolist())
        full = len(v) // self.size
        cut = full * self.size
        self.win.update((win + full,))
        self.open.clear()
        if cut < len(v):
            self.open.put([(x,) for x in self.num.maybe(v[cut:], there[cut:])])
        if not full:
            return
        v, there = v[:cut].reshape(full, self.size), there[:cut].reshape(full, self.size)
        some = there.any(axis=1)
        fns = {"sum": lambda: v.sum(axis=1),
               "min": lambda: np.where(there, v, self.num.high).min(axis=1),
               "max": lambda: np.where(there, v, self.num.low).max(axis=1)}
        res = _key_frame(self.key_names, key, full)
        res["win"] = win + np.arange(full, dtype="int64")
        for r in self.reducers:
            res[r] = self.num.maybe(fns[r](), some)
        if self.as_text:
            res["items"] = [" " + " ".join(str(self.num.py(x)) for x, ok in zip(a, b) if ok) for a, b in zip(v, there)]
        yield pd.DataFrame(res)

    def close(self) -> None:
        pass


class CountTrigger(StatefulProcessor):
    """Global window per key, count trigger ``every`` without purge: at every
    ``every``-th row emit the running total since the start, the ordinal and
    the first row's ``carry`` fields."""

    def __init__(self, key_names: Sequence[str], value: str, order: Sequence[str],
                 every: int = 5, carry: Sequence[str] = (), carry_ddl: str = "", whole: bool = True):
        self.key_names, self.value, self.order = list(key_names), value, list(order)
        self.every, self.carry, self.carry_ddl, self.num = every, list(carry), carry_ddl, _Numbers(whole)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", f"rn LONG, total {self.num.ddl}")
        if self.carry:
            self.first = handle.getValueState("first", self.carry_ddl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        rn0, t0 = self.acc.get() if self.acc.exists() else (0, 0)
        if self.carry:
            if self.first.exists():
                first = tuple(self.first.get())
            else:
                first = tuple(x[0] for x in _plain(df.iloc[:1], self.carry, self.carry_ddl))
                self.first.update(first)
        v, there = self.num.read(df[self.value].tolist())
        rn = rn0 + np.arange(1, len(v) + 1, dtype="int64")
        seen = np.logical_or.accumulate(there) | (rn0 > 0 and t0 is not None)
        tot = (t0 or 0) + np.cumsum(v)
        self.acc.update((int(rn[-1]), self.num.py(tot[-1]) if seen[-1] else None))
        fire = rn % self.every == 0
        if fire.any():
            res = _key_frame(self.key_names, key, int(fire.sum()))
            res["rn"] = rn[fire]
            for i, c in enumerate(self.carry):
                res[c] = [first[i]] * int(fire.sum())
            res["total"] = self.num.maybe(tot[fire], seen[fire])
            res["n"] = rn[fire]
            yield pd.DataFrame(res)

    def close(self) -> None:
        pass


class CountEvictor(StatefulProcessor):
    """Count trigger ``every`` + count evictor ``keep``: at every ``every``-th
    row reduce the last ``keep`` rows (sum, count, carry of the oldest kept).
    State: the ordinal and the last ``keep`` rows."""

    def __init__(self, key_names: Sequence[str], value: str, order: Sequence[str],
                 every: int = 5, keep: int = 4, carry: Sequence[str] = (),
                 carry_ddl: str = "", whole: bool = True):
        self.key_names, self.value, self.order = list(key_names), value, list(order)
        self.every, self.keep, self.carry, self.carry_ddl = every, keep, list(carry), carry_ddl
        self.num = _Numbers(whole)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rn = handle.getValueState("rn", "rn LONG")
        ddl = f"v {self.num.ddl}" + (", " + self.carry_ddl if self.carry else "")
        self.buf = handle.getListState("buf", ddl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        rn0 = self.rn.get()[0] if self.rn.exists() else 0
        kept = list(self.buf.get()) if rn0 else []
        # columns of (kept rows ++ this call's rows), as arrays
        vals, there = self.num.read([k[0] for k in kept] + df[self.value].tolist())
        carry = [np.array([k[1 + i] for k in kept] + x, dtype=object)
                 for i, x in enumerate(_plain(df, self.carry, self.carry_ddl))]
        base = rn0 - len(kept)  # ordinal of row 0 of the arrays is base + 1
        csum = np.concatenate([np.zeros(1, vals.dtype), np.cumsum(vals)])
        some = np.concatenate([[0], np.cumsum(there)])
        rns = np.arange(rn0 + 1, rn0 + len(df) + 1, dtype="int64")
        fires = rns[rns % self.every == 0]
        if len(fires):
            res = _key_frame(self.key_names, key, len(fires))
            hi = fires - base                      # exclusive end index into the arrays
            lo = np.maximum(hi - self.keep, 0)
            res["rn"] = fires
            for i, c in enumerate(self.carry):
                res[c] = carry[i][lo]
            res["total"] = self.num.maybe(csum[hi] - csum[lo], some[hi] > some[lo])
            res["n"] = (hi - lo).astype("int64")
            yield pd.DataFrame(res)
        self.rn.update((int(rn0 + len(df)),))
        tail = slice(max(0, len(vals) - self.keep), len(vals))
        self.buf.clear()
        self.buf.put([(v, *[carry[i][j] for i in range(len(self.carry))])
                      for j, v in zip(range(tail.start, tail.stop), self.num.maybe(vals[tail], there[tail]))])

    def close(self) -> None:
        pass


class RunningCount(StatefulProcessor):
    """Per-record running count per key (counter defaults to 0 when absent)."""

    def __init__(self, key_names: Sequence[str], order: Sequence[str], out: str = "count"):
        self.key_names, self.order, self.out = list(key_names), list(order), out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "c LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        c0 = self.count.get()[0] if self.count.exists() else 0
        c = c0 + np.arange(1, len(df) + 1, dtype="int64")
        self.count.update((int(c[-1]),))
        res = _key_frame(self.key_names, key, len(df))
        for o in self.order:
            res[o] = df[o].to_numpy()
        res[self.out] = c
        yield pd.DataFrame(res)

    def close(self) -> None:
        pass


class RollingReduce(StatefulProcessor):
    """Per-record rolling aggregate per key (exact, one output row per input).

    ``kind`` sum / min / max keep the key's first-row ``carry`` fields;
    ``min_by`` / ``max_by`` emit the whole held record (ties keep the
    earliest).  State: the running value (and the held record or first-row
    fields).
    """

    def __init__(self, key_names: Sequence[str], value: str, order: Sequence[str], kind: str,
                 carry: Sequence[str] = (), carry_ddl: str = "", whole: bool = True):
        self.key_names, self.value, self.order = list(key_names), value, list(order)
        self.kind, self.carry, self.carry_ddl, self.num = kind, list(carry), carry_ddl, _Numbers(whole)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", f"v {self.num.ddl}")
        if self.carry:
            self.rec = handle.getValueState("rec", self.carry_ddl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        v, there = self.num.read(df[self.value].tolist())
        known = self.acc.exists()
        prev = self.acc.get()[0] if known else None  # None: no number so far
        res = _key_frame(self.key_names, key, len(v))
        for o in self.order:
            res[f"at_{o}" if self.kind.endswith("_by") else o] = df[o].to_numpy()
        if self.kind in ("sum", "min", "max"):
            op, neutral = {"sum": (np.add, self.num.py(0)), "min": (np.minimum, self.num.high),
                           "max": (np.maximum, self.num.low)}[self.kind]
            run = op.accumulate(np.where(there, v, neutral))
            seen = np.logical_or.accumulate(there)
            if prev is not None:
                run, seen = op(run, prev), np.ones(len(v), bool)
            if self.carry:
                first = tuple(self.rec.get()) if known else tuple(
                    x[0] for x in _plain(df.iloc[:1], self.carry, self.carry_ddl))
                if not known:
                    self.rec.update(first)
                for i, c in enumerate(self.carry):
                    res[c] = [first[i]] * len(v)
            res[f"{self.kind}_{self.value}"] = self.num.maybe(run, seen)
            self.acc.update((self.num.py(run[-1]) if seen[-1] else None,))
        else:
            # a row takes over if its number is there and beats all before it; ties keep the earliest
            sign = 1 if self.kind == "max_by" else -1
            worst = self.num.low if sign > 0 else self.num.high
            best = (np.maximum if sign > 0 else np.minimum).accumulate(np.where(there, v, worst))
            before = np.concatenate([[worst if prev is None else prev], best[:-1]]).astype(v.dtype)
            if prev is not None:
                before = (np.maximum if sign > 0 else np.minimum)(before, self.num.np(prev))
            started = np.concatenate([[False], np.logical_or.accumulate(there)[:-1]]) | (prev is not None)
            takes = there & (((v > before) if sign > 0 else (v < before)) | ~started)
            held = np.maximum.accumulate(np.where(takes, np.arange(len(v)), -1))
            old = tuple(self.rec.get()) if prev is not None else (None,) * len(self.carry)
            rows_ = _plain(df, self.carry, self.carry_ddl)
            for i, c in enumerate(self.carry):
                # index 0 is the record held before this call, then this call's rows
                col = [old[i], *rows_[i]]
                res[c] = [col[k + 1] for k in held]
            last = held[-1]
            if last >= 0:
                self.acc.update((self.num.py(v[last]),))
                self.rec.update(tuple(x[last] for x in rows_))
        yield pd.DataFrame(res)

    def close(self) -> None:
        pass


# --- DataFrame-level wrappers ---------------------------------------------------

def _ddl(df: DataFrame, cols: Sequence[str]) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in cols)


def _schema(df: DataFrame, cols: Sequence[str], extra: Sequence[T.StructField]) -> T.StructType:
    return T.StructType([df.schema[c] for c in cols] + list(extra))


def _number(df: DataFrame, value: str) -> T.DataType:
    return T.LongType() if is_whole(df, value) else T.DoubleType()


def count_windows_stream(df: DataFrame, key: str, value: str, order: Sequence[str],
                         size: int = 10, reducers: Sequence[str] = ("sum",),
                         as_text: bool = False) -> DataFrame:
    extra = [T.StructField("win", T.LongType())]
    extra += [T.StructField(r, _number(df, value)) for r in reducers]
    if as_text:
        extra.append(T.StructField("items", T.StringType()))
    proc = CountWindow([key], value, order, size, reducers, as_text, is_whole(df, value))
    return df.groupBy(key).transformWithStateInPandas(
        proc, _schema(df, [key], extra), "append", "None")


def count_trigger_stream(df: DataFrame, key: str, value: str, order: Sequence[str],
                         every: int = 5, carry: Sequence[str] = ()) -> DataFrame:
    extra = [T.StructField("rn", T.LongType())] + [df.schema[c] for c in carry] + [
        T.StructField("total", _number(df, value)), T.StructField("n", T.LongType())]
    proc = CountTrigger([key], value, order, every, carry, _ddl(df, carry), is_whole(df, value))
    return df.groupBy(key).transformWithStateInPandas(
        proc, _schema(df, [key], extra), "append", "None")


def count_evictor_stream(df: DataFrame, key: str, value: str, order: Sequence[str],
                         every: int = 5, keep: int = 4, carry: Sequence[str] = ()) -> DataFrame:
    extra = [T.StructField("rn", T.LongType())] + [df.schema[c] for c in carry] + [
        T.StructField("total", _number(df, value)), T.StructField("n", T.LongType())]
    proc = CountEvictor([key], value, order, every, keep, carry, _ddl(df, carry), is_whole(df, value))
    return df.groupBy(key).transformWithStateInPandas(
        proc, _schema(df, [key], extra), "append", "None")


def running_count_stream(df: DataFrame, key: str, order: Sequence[str],
                         out: str = "count") -> DataFrame:
    extra = [df.schema[o] for o in order] + [T.StructField(out, T.LongType())]
    return df.groupBy(key).transformWithStateInPandas(
        RunningCount([key], order, out), _schema(df, [key], extra), "append", "None")


def rolling_stream(df: DataFrame, key: str, value: str, order: Sequence[str], kind: str,
                   carry: Sequence[str] = ()) -> DataFrame:
    """Per-record rolling sum / min / max (with first-row ``carry``) or
    min_by / max_by (``carry`` = the record fields to hold, without the key)."""
    if key in carry:
        raise ValueError("carry must not repeat the key column")
    if kind in ("sum", "min", "max"):
        extra = [df.schema[o] for o in order] + [df.schema[c] for c in carry] + [
            T.StructField(f"{kind}_{value}", _number(df, value))]
    else:
        extra = [T.StructField(f"at_{o}", df.schema[o].dataType) for o in order] + [
            df.schema[c] for c in carry]
    proc = RollingReduce([key], value, order, kind, carry, _ddl(df, carry), is_whole(df, value))
    return df.groupBy(key).transformWithStateInPandas(
        proc, _schema(df, [key], extra), "append", "None")


class Reduced(StatefulProcessor):
    """Any associative function of the caller over a key's rows, in arrival order.

    ``size`` None: one output row per input, the reduction so far; else the reduction of
    every full window of ``size`` rows.  State: the reduction, and how many rows it holds.
    """

    def __init__(self, key: str, values: Sequence[str], ddl: str, order: Sequence[str], merge, size: int | None):
        self.key, self.values, self.ddl, self.order = key, list(values), ddl, list(order)
        self.merge, self.size = merge, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", f"{self.ddl}, rows LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, self.order)
        if df.empty:
            return
        got, n = None, 0
        if self.acc.exists():
            *got, n = self.acc.get()
            got = tuple(got)
        out, wins = [], []
        for row in zip(*_plain(df, self.values, self.ddl), strict=True):
            got = row if self.size and n % self.size == 0 or got is None else self.merge(got, row)
            n += 1
            if self.size is None:
                out.append(got)
            elif n % self.size == 0:
                out.append(got)
                wins.append(n // self.size - 1)
        self.acc.update((*got, n))
        if out:
            res = _key_frame([self.key], key, len(out))
            res |= {"win": wins} if self.size else {o: df[o].to_numpy() for o in self.order}
            yield pd.DataFrame(res | {c: [x[i] for x in out] for i, c in enumerate(self.values)})

    def close(self) -> None:
        pass


def reduced_stream(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str], merge,
                   size: int | None = None) -> DataFrame:
    """Live twin of ``operators.reduce``: ``merge(earlier, later)`` over tuples of the value columns."""
    extra = [T.StructField("win", T.LongType())] if size else [df.schema[o] for o in order]
    proc = Reduced(key, values, _ddl(df, values), order, merge, size)
    return df.groupBy(key).transformWithStateInPandas(
        proc, _schema(df, [key], [*extra, *[df.schema[v] for v in values]]), "append", "None")
