"""Reductions by any associative function of the caller.

A ``Reducer`` merges two partial results, the earlier one first; it must be
associative, not commutative.  It is given as Python over tuples, and may be
given as column expressions over structs too, which then run inside the JVM.

Rows of a key are numbered in arrival order by the hot-key safe ordinal and cut
into blocks of ``BLOCK`` rows.  A block is folded in one task; the blocks'
results are rows of the same shape, a ``BLOCK``-th as many, and are folded the
same way until one is left.  A running reduction adds to each block what the
running reduction of the blocks' results gives for the block before it.  So no
task ever holds more than a block of a key, and a key of ``n`` rows takes
``log(n) / log(BLOCK)`` rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.plans.scan import row_ordinal
from keyflow.session import checkpoint_dir

BLOCK = 256

_V, _RN, _BLK, _ITEMS = "__kf_v", "__kf_rn", "__kf_blk", "__kf_items"


@dataclass(frozen=True)
class Reducer:
    """``merge(earlier, later)`` of two tuples of the value columns, or as ``columns`` of two structs of them."""

    merge: Callable[[tuple, tuple], tuple]
    columns: Callable[[Column, Column], Column] | None = None


def _values(df: DataFrame, values: Sequence[str]) -> tuple[Column, T.StructType]:
    kind = T.StructType([T.StructField(v, df.schema[v].dataType) for v in values])
    return F.struct(*[F.col(v) for v in values]), kind


def _tuple(x) -> tuple:
    return tuple(x.values()) if isinstance(x, dict) else tuple(x)


def _merged(reducer: Reducer, kind: T.StructType) -> Callable[[Column, Column], Column]:
    """The reducer over two struct columns of one row."""
    if reducer.columns is not None:
        return lambda a, b: reducer.columns(a, b).cast(kind)
    names, merge = kind.names, reducer.merge

    @F.pandas_udf(kind)
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows = [merge(x, y) for x, y in zip(a.itertuples(index=False, name=None), b.itertuples(index=False, name=None), strict=True)]
        return pd.DataFrame(rows, columns=names)

    return run


def _folded(items: Column, reducer: Reducer, kind: T.StructType, running: bool) -> Column:
    """Fold of an ordered array of structs, or the array of its running folds."""
    if reducer.columns is not None:
        merge = _merged(reducer, kind)
        rest = F.slice(items, F.lit(2), F.size(items))
        if not running:
            return F.aggregate(rest, F.element_at(items, 1).cast(kind), merge)
        return F.aggregate(rest, F.array(F.element_at(items, 1).cast(kind)),
                           lambda got, x: F.concat(got, F.array(merge(F.element_at(got, -1), x))))
    names, merge = kind.names, reducer.merge

    @F.pandas_udf(T.ArrayType(kind) if running else kind)
    def run(blocks: pd.Series) -> pd.Series:
        out = []
        for block in blocks:
            got = [_tuple(block[0])]
            for x in block[1:]:
                got.append(merge(got[-1], _tuple(x)))
            out.append([dict(zip(names, g)) for g in got] if running else dict(zip(names, got[-1])))
        return pd.Series(out)

    @F.pandas_udf(kind)
    def last(blocks: pd.Series) -> pd.DataFrame:
        rows = []
        for block in blocks:
            got = _tuple(block[0])
            for x in block[1:]:
                got = merge(got, _tuple(x))
            rows.append(got)
        return pd.DataFrame(rows, columns=names)

    return run(items) if running else last(items)


def _blocks(df: DataFrame, by: Sequence[str], number: str, size: int, extra: Sequence[str] = ()) -> DataFrame:
    """``by``, block number and the block's rows as an array in order of ``number`` (from 1)."""
    block = F.expr(f"({number} - 1) div {size}").alias(_BLK)
    items = F.sort_array(F.collect_list(F.struct(F.col(number).alias(_RN), F.col(_V), *extra)))
    return df.groupBy(*by, block).agg(items.alias(_ITEMS))


def _item_values() -> Column:
    return F.transform(_ITEMS, lambda x: x[_V])


def _running(df: DataFrame, by: Sequence[str], number: str, reducer: Reducer, kind: T.StructType,
             extra: Sequence[str], size: int) -> DataFrame:
    """``by``, ``extra``, the row's number and the running fold of ``__kf_v`` up to it."""
    checkpoint_dir(df.sparkSession)
    blocks = _blocks(df, by, number, size, extra).withColumn("__kf_run", _folded(_item_values(), reducer, kind, True))
    # read three times: for the totals, for the offsets and for the result
    blocks = blocks.checkpoint(eager=True)
    if blocks.agg(F.max(_BLK)).first()[0]:  # None or 0: every key is one block
        totals = blocks.select(*by, (F.col(_BLK) + 1).alias(_RN), F.element_at("__kf_run", -1).alias(_V))
        before = _running(totals, by, _RN, reducer, kind, (), size).select(
            *[F.col(k).alias(f"__kf_k{i}") for i, k in enumerate(by)], F.col(_RN).alias("__kf_next"), F.col(_V).alias("__kf_off"))
        on = F.col(_BLK) == F.col("__kf_next")
        for i, k in enumerate(by):
            on = on & F.col(k).eqNullSafe(F.col(f"__kf_k{i}"))
        blocks = blocks.join(before, on, "left")
    else:
        blocks = blocks.withColumn("__kf_off", F.lit(None).cast(kind))
    zipped = F.explode(F.arrays_zip(F.col(_ITEMS), F.col("__kf_run"))).alias("__kf_z")
    rows = blocks.select(*by, "__kf_off", zipped).select(
        *by, *[F.col(f"__kf_z.{_ITEMS}.{c}").alias(c) for c in (*extra, _RN)], "__kf_off", F.col("__kf_z.__kf_run").alias("__kf_in"))
    merge = _merged(reducer, kind)
    first = rows.where(F.col("__kf_off").isNull()).select(*by, *extra, _RN, F.col("__kf_in").alias(_V))
    later = rows.where(F.col("__kf_off").isNotNull()).select(
        *by, *extra, _RN, merge(F.col("__kf_off"), F.col("__kf_in")).alias(_V))
    return first.unionByName(later)


def reduce_running(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
                   reducer: Reducer, block: int = BLOCK, **scan_opts) -> DataFrame:
    """Every row's ``keys`` and ``order`` with the reduction of its key's rows up to it."""
    v, kind = _values(df, values)
    numbered = row_ordinal(df.select(*keys, *order, v.alias(_V)), list(keys), list(order), name=_RN, **scan_opts)
    out = _running(numbered, list(keys), _RN, reducer, kind, list(order), block)
    return out.select(*keys, *order, *[F.col(f"{_V}.{c}").alias(c) for c in values])


def reduce_all(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
               reducer: Reducer, block: int = BLOCK, **scan_opts) -> DataFrame:
    """One row per key: the reduction of all its rows, by a tree of blocks."""
    v, kind = _values(df, values)
    rows = row_ordinal(df.select(*keys, *order, v.alias(_V)), list(keys), list(order), name=_RN, **scan_opts)
    checkpoint_dir(df.sparkSession)
    while True:
        rows = _blocks(rows, list(keys), _RN, block).select(
            *keys, (F.col(_BLK) + 1).alias(_RN), _folded(_item_values(), reducer, kind, False).alias(_V)).checkpoint(eager=True)
        if (rows.agg(F.max(_RN)).first()[0] or 1) == 1:
            return rows.select(*keys, *[F.col(f"{_V}.{c}").alias(c) for c in values])


def count_windows_by(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str], reducer: Reducer,
                     size: int = 10, **scan_opts) -> DataFrame:
    """``key, win`` and the reduction of every full window of ``size`` consecutive rows of a key."""
    v, kind = _values(df, values)
    numbered = row_ordinal(df.select(key, *order, v.alias(_V)), [key], list(order), name=_RN, **scan_opts)
    full = _blocks(numbered, [key], _RN, size).where(F.size(_ITEMS) == size)
    got = full.select(key, F.col(_BLK).alias("win"), _folded(_item_values(), reducer, kind, False).alias(_V))
    return got.select(key, "win", *[F.col(f"{_V}.{c}").alias(c) for c in values])
