"""Running (prefix) aggregates that scale past hot keys.

A running aggregate per key in arrival order is naturally written as
``agg(x).over(Window.partitionBy(key).orderBy(order).rowsBetween(-inf, 0))``.
That puts every row of a key into one task: with a key holding a third of
all rows, one task sorts a third of the table.

``prefix_scan`` splits each *hot* key's ordered rows into buckets of the
leading order column (a monotone function of arrival order) and computes
the same result in two levels:

1. in-bucket running value: window over ``(key, bucket)``;
2. bucket totals: the running value at the last row of each bucket (read
   off the same window output, so no second scan or aggregation);
3. exclusive prefix of the totals over the buckets of a key: a window over
   the *summary* rows, only for keys that span several buckets;
4. combine: ``offset (+|least|greatest) in-bucket value`` through a
   broadcast join against the summary, which keeps the window's partitioning.

Hot keys are found with one partial aggregation ``groupBy(keys).agg(count)``
keeping keys with more than ``rows_per_bucket`` rows; that small table is
computed once and broadcast (or, past the broadcast bound, materialized in
the shared checkpoint folder and shuffle-joined).  Each hot key is cut at
quantiles of its own rows (one mergeable sketch per key) into about
``count / rows_per_bucket`` buckets, so bursts, outliers and backfills do not
unbalance them; a single order value that fills several buckets is cut by the
next order column.  Every other key stays in bucket 0 and costs nothing extra.
The summary's number of rows is bounded by the sum of the split points, which
is computed (not guessed) before anything is broadcast.

Only associative aggregates are allowed: ``sum``, ``min``, ``max``.  Arg-min
/ arg-max and "value of the first row" are ``min``/``max`` over a struct whose
leading fields are the comparison value and the order columns (structs
compare field by field), so they are covered too.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.functions.time import epoch_micros
from keyflow.plans.sizing import BROADCAST_MAX_ROWS
from keyflow.session import checkpoint_dir

# Upper bound of rows one (key, bucket) task sorts on evenly spread input.
# Override per session with the conf key below (e.g. tiny values in tests to
# force many buckets).
DEFAULT_ROWS_PER_BUCKET = 2_000_000
ROWS_PER_BUCKET_CONF = "spark.keyflow.scan.rowsPerBucket"
# Hot-key tables up to this many rows are fetched to the driver and broadcast.
LOCAL_HOT_ROWS = 10_000
# Slices that one pass cuts a key into at most; keys that need more are cut again, slice by slice.
MAX_SLICES = 4096

_B = "__kf_bucket"


@dataclass(frozen=True)
class Agg:
    """One running aggregate: output ``name`` = ``kind``(``expr``)."""

    name: str
    kind: str  # "sum" | "min" | "max"
    expr: Column

    def __post_init__(self):
        if self.kind not in ("sum", "min", "max"):
            raise ValueError(f"prefix_scan supports sum/min/max, not {self.kind}")


def _fn(kind: str):
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind]


def _combine(kind: str, offset: Column, inner: Column) -> Column:
    if kind == "sum":
        return F.coalesce(offset + inner, offset, inner)
    # least / greatest skip nulls: a missing offset leaves the in-bucket value
    return (F.least if kind == "min" else F.greatest)(offset, inner)


def as_long(df: DataFrame, col: str) -> Column:
    """Monotone LONG image of an order column (timestamps -> epoch micros).

    TIMESTAMP_NTZ is converted field by field, without any time zone, so
    the mapping is monotone whatever the session zone (no DST folds).
    """
    dt = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dt, T.TimestampNTZType):
        return epoch_micros(c)
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    raise TypeError(f"cannot bucket on {col} of type {dt}")


def resolve_rows_per_bucket(df: DataFrame, rows_per_bucket: int | None) -> int:
    if rows_per_bucket:
        return rows_per_bucket
    conf = df.sparkSession.conf.get(ROWS_PER_BUCKET_CONF, None)
    return int(conf) if conf else DEFAULT_ROWS_PER_BUCKET


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], rprefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"{rprefix}{k}"])
    return cond


def _quantiles(v: Column, n: Column, slices: int, rows_per_bucket: int) -> Column:
    """About ``n / rows_per_bucket`` ascending split points of ``v``, repeats kept.

    One mergeable sketch per group, so a group's rows are never gathered.
    """
    grid = F.percentile_approx(v, [i / slices for i in range(1, slices + 1)], max(10_000, 20 * slices))
    nb = F.least(F.lit(slices), F.ceil(n / F.lit(rows_per_bucket))).cast("int")
    return F.transform(F.sequence(F.lit(1), nb - 1),
                       lambda i: F.element_at(grid, F.ceil(i * slices / nb).cast("int")))


def _slice(splits: Column, v: Column) -> Column:
    """Slice of ``v`` among distinct ascending split points, by binary search: ``2 k`` between
    the ``k``-th and the next, ``2 k + 1`` on the next.  Rows on a split point have a slice
    to themselves, so it can be split further by another column."""
    steps = F.array(*[F.lit(1 << k) for k in range(MAX_SLICES.bit_length() - 1, -1, -1)])
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(splits, at + step - 1) < v, at + step).otherwise(at))
    on = F.coalesce(F.get(splits, below) == v, F.lit(False))
    return (2 * below + F.when(on, 1).otherwise(0)).cast("long")


def _bounded_side(side: DataFrame, points: int) -> DataFrame:
    """Broadcast a table of split points if it is proven small; otherwise leave the join to Spark."""
    return F.broadcast(side) if points <= BROADCAST_MAX_ROWS else side


def assign_buckets(df: DataFrame, keys: Sequence[str], col: str,
                   rows_per_bucket: int | None = None,
                   then: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """Add ``__kf_bucket``: 0 for ordinary keys, slices of ``col`` for hot keys.

    Slices end at quantiles of each hot key's own rows, so outliers, bursts
    and backfills do not unbalance them.  Where one value of ``col`` alone
    fills several slices, its rows are sliced by the next order column
    (``then[0]``), again at quantiles.  A key that needs more than
    ``MAX_SLICES`` slices is cut level by level: its slices are cut in the same
    way as if they were keys, and the bucket is then a struct of the levels.
    Returns the frame and an upper bound of the number of ``(hot key, bucket)``
    pairs.
    """
    keys = list(keys)
    out, pairs, most = _cut(df, keys, col, rows_per_bucket, then)
    level = 0
    while most is not None:
        up = f"__kf_up{level}"
        upper = out.withColumnRenamed(_B, up)
        out, more, left = _cut(upper, [*keys, up], col, rows_per_bucket, then)
        out = out.select(*[out[c] for c in df.columns], F.struct(up, _B).alias(_B))
        pairs, level = pairs + more, level + 1
        most = left if left is not None and left < most else None  # rows equal in all order columns stay together
    return out, pairs


def _cut(df: DataFrame, keys: list[str], col: str, rows_per_bucket: int | None,
         then: Sequence[str]) -> tuple[DataFrame, int, int | None]:
    """One level of ``assign_buckets``; also the rows of the largest key if it needs a further level."""
    rpb = resolve_rows_per_bucket(df, rows_per_bucket)
    spark = df.sparkSession
    v = as_long(df, col)
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rpb)
    # The hot-key table is at most n / rows_per_bucket rows.  Small (the usual
    # case: a handful of keys) it is fetched once; larger, it is materialized
    # in the shared checkpoint folder.
    rows = hot.limit(LOCAL_HOT_ROWS + 1).collect()
    if not rows:
        return df.withColumn(_B, F.lit(0).cast("long")), 0, None
    if len(rows) <= LOCAL_HOT_ROWS:
        hot, n_hot = spark.createDataFrame(rows, schema=hot.schema), len(rows)
        most, total = max(r["n"] for r in rows), sum(r["n"] for r in rows)
    else:
        checkpoint_dir(spark)
        hot = hot.checkpoint(eager=True)
        n_hot, most, total = hot.agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
    slices = min(MAX_SLICES, max(2, math.ceil(most / rpb)))
    points = total // rpb + n_hot
    again = most if most > MAX_SLICES * rpb else None

    def with_keys(side: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        return side.select(*[F.col(k).alias(f"__kf_h_{k}") for k in keys], *extra)

    side = _bounded_side(with_keys(hot, ["n"]), n_hot)
    mine = df.join(side, _null_safe(df, side, keys, "__kf_h_")).select(
        *[df[k] for k in keys], v.alias("__kf_v"), F.col("n").alias("__kf_n"),
        *[as_long(df, t).alias("__kf_t") for t in then[:1] if _sliceable(df, t)])
    raw = mine.groupBy(*keys).agg(_quantiles(F.col("__kf_v"), F.max("__kf_n"), slices, rpb).alias("__kf_raw"))
    checkpoint_dir(spark)
    raw = (spark.createDataFrame(raw.collect(), schema=raw.schema) if points <= LOCAL_HOT_ROWS
           else raw.checkpoint(eager=True))
    side = _bounded_side(with_keys(raw, [F.array_sort(F.array_distinct("__kf_raw")).alias("__kf_s")]), points)
    j = df.join(side, _null_safe(df, side, keys, "__kf_h_"), "left")
    # rows with a null order value sort first (ascending, nulls first): bucket -1
    first = F.when(F.col("__kf_s").isNull(), F.lit(0).cast("long")).otherwise(
        F.coalesce(F.when(v.isNotNull(), _slice(F.col("__kf_s"), v)), F.lit(-1).cast("long")))
    out = j.select(*[df[c] for c in df.columns], first.alias(_B))
    pairs = 2 * points + 2 * n_hot

    # a value on several split points fills several slices alone
    tied = raw.select(*keys, F.explode(F.array_distinct("__kf_raw")).alias("__kf_v"), "__kf_raw").select(
        *keys, "__kf_v", F.size(F.filter("__kf_raw", lambda x: x == F.col("__kf_v"))).alias("times")).where("times > 1")
    ties = tied.agg(F.count(F.lit(1)).alias("k"), F.max("times").alias("most"), F.sum("times").alias("all")).first()
    if not ties["k"] or not then or not _sliceable(df, then[0]):
        return out, int(pairs), again
    side = _bounded_side(with_keys(tied, [F.col("__kf_v").alias("__kf_tv"), "times"]), ties["k"])
    low = mine.join(side, _null_safe(mine, side, keys, "__kf_h_") & (mine["__kf_v"] == side["__kf_tv"]))
    low = low.groupBy(*[mine[k] for k in keys], "__kf_tv").agg(_quantiles(
        F.col("__kf_t"), (F.max("times") + 1) * F.lit(rpb), min(MAX_SLICES, ties["most"] + 1), rpb).alias("__kf_raw"))
    low = low.checkpoint(eager=True)
    side = _bounded_side(with_keys(low, ["__kf_tv", F.array_sort(F.array_distinct("__kf_raw")).alias("__kf_s2")]),
                         ties["all"])
    j = out.join(side, _null_safe(out, side, keys, "__kf_h_") & (as_long(out, col) == side["__kf_tv"]), "left")
    t = as_long(out, then[0])
    second = F.when(F.col("__kf_s2").isNull() | t.isNull(), F.lit(0).cast("long")).otherwise(_slice(F.col("__kf_s2"), t) + 1)
    width = 4 * MAX_SLICES
    return (j.select(*[out[c] for c in df.columns], (out[_B] * width + second).alias(_B)),
            int(pairs + 2 * ties["all"] + 4 * ties["k"]), again)


def _sliceable(df: DataFrame, col: str) -> bool:
    try:
        as_long(df, col)
    except TypeError:
        return False
    return True


def prefix_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                aggs: Sequence[Agg], bucket: Column | None = None,
                inclusive: bool = True,
                rows_per_bucket: int | None = None, pairs: int | None = None) -> DataFrame:
    """Add one column per ``Agg``: its running value per key in ``order``.

    ``order`` names the arrival-order columns; together they must be unique
    within a key.  ``bucket`` (optional) must be non-decreasing along
    ``order``; by default hot keys are sliced on the first order column.
    Where ``df`` is the result of other work, slice its input instead
    (``assign_buckets``), carry the slices along and pass them here with
    ``pairs``: the work is then not run once more to find them.
    ``inclusive=False`` gives the value over the rows strictly *before* each
    row.  Null keys form their own group.
    """
    keys, order = list(keys), list(order)
    if bucket is None:
        d, pairs = assign_buckets(df, keys, order[0], rows_per_bucket, then=order[1:])
    else:
        d = df.withColumn(_B, bucket)

    w_part = Window.partitionBy(*keys, _B).orderBy(*order)
    w_inc = w_part.rowsBetween(Window.unboundedPreceding, 0)
    w_exc = w_part.rowsBetween(Window.unboundedPreceding, -1)
    cols = [_fn(a.kind)(a.expr).over(w_inc).alias(f"__kf_inc_{a.name}") for a in aggs]
    if not inclusive:
        cols += [_fn(a.kind)(a.expr).over(w_exc).alias(f"__kf_exc_{a.name}") for a in aggs]
    cols.append(F.lead(F.lit(1)).over(w_part).isNull().alias("__kf_last"))
    running = d.select("*", *cols)
    mine = "__kf_inc_" if inclusive else "__kf_exc_"

    if pairs == 0:  # nothing was split: the in-bucket value is the answer
        return running.select(*[running[c] for c in df.columns],
                              *[F.col(f"{mine}{a.name}").alias(a.name) for a in aggs])

    # bucket totals = inclusive running value at each bucket's last row
    totals = running.where(F.col("__kf_last")).select(
        *[F.col(k).alias(f"__kf_o_{k}") for k in keys], F.col(_B).alias("__kf_ob"),
        *[F.col(f"__kf_inc_{a.name}").alias(f"__kf_t_{a.name}") for a in aggs])
    w_b = (Window.partitionBy(*[f"__kf_o_{k}" for k in keys]).orderBy("__kf_ob")
           .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        *[f"__kf_o_{k}" for k in keys], "__kf_ob",
        *[_fn(a.kind)(F.col(f"__kf_t_{a.name}")).over(w_b).alias(f"__kf_off_{a.name}")
          for a in aggs])
    # the first bucket of each key has no offset: drop it, so only keys that
    # span several buckets remain (at most `pairs` rows)
    any_offset = F.lit(False)
    for a in aggs:
        any_offset = any_offset | F.col(f"__kf_off_{a.name}").isNotNull()
    offsets = offsets.where(any_offset)
    if pairs is not None and pairs <= BROADCAST_MAX_ROWS:
        offsets = F.broadcast(offsets)

    cond = _null_safe(running, offsets, keys, "__kf_o_") & (running[_B] == offsets["__kf_ob"])
    joined = running.join(offsets, cond, "left")
    out = [running[c] for c in df.columns]
    out += [_combine(a.kind, F.col(f"__kf_off_{a.name}"), F.col(f"{mine}{a.name}")).alias(a.name)
            for a in aggs]
    return joined.select(*out)


def simple_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                aggs: Sequence[Agg], inclusive: bool = True) -> DataFrame:
    """One-window form of ``prefix_scan`` (reference for tests; fine when
    every key is small)."""
    upper = 0 if inclusive else -1
    w = (Window.partitionBy(*keys).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, upper))
    return df.select("*", *[_fn(a.kind)(a.expr).over(w).alias(a.name) for a in aggs])


def row_ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                name: str = "rn", bucket: Column | None = None,
                rows_per_bucket: int | None = None) -> DataFrame:
    """1-based arrival ordinal per key (``row_number``), hot-key safe."""
    return prefix_scan(df, keys, order, [Agg(name, "sum", F.lit(1).cast("long"))],
                       bucket=bucket, rows_per_bucket=rows_per_bucket)
