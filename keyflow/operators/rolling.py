"""Rolling (un-windowed) keyed aggregates: one output row per input row.

Batch forms order each key's rows by explicit arrival-order columns and are
built on ``keyflow.plans.scan.prefix_scan`` (hot-key safe).  Streaming forms
(update mode, one row per changed key per micro-batch) are in
``keyflow.streaming.rolling``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.number import wide
from keyflow.plans.scan import Agg, as_long, assign_buckets, prefix_scan


def _first_struct(order: Sequence[str], carry: Sequence[str]) -> Column:
    """Struct whose minimum is the key's first row (ordered by ``order``)."""
    return F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)],
                    *[F.col(c) for c in carry])


def rolling_reduce(df: DataFrame, key: str, value: str, kind: str,
                   order: Sequence[str], carry: Sequence[str] = (),
                   out: str | None = None, **scan_opts) -> DataFrame:
    """Running ``sum`` / ``min`` / ``max`` of ``value`` per ``key``.

    Other fields (``carry``) keep the values of the key's *first* row, as the
    positional rolling aggregates of the reference do.  Output: key, the
    order columns of the triggering row, carry, ``out``.
    """
    out = out or f"{kind}_{value}"
    aggs = [Agg(out, kind, F.col(value))]
    if carry:
        aggs.append(Agg("__first", "min", _first_struct(order, carry)))
    r = prefix_scan(df, [key], order, aggs, **scan_opts)
    return r.select(key, *order, *[F.col(f"__first.{c}").alias(c) for c in carry], out)


def rolling_by(df: DataFrame, key: str, value: str, order: Sequence[str],
               record: Sequence[str], kind: str = "min", **scan_opts) -> DataFrame:
    """Running min-by / max-by: the whole record holding the extreme value so far.

    Ties go to the earliest record.  For ``max`` the order columns are negated
    inside the comparison struct so the earliest still wins.  Output: key,
    ``at_<order>`` of the triggering row, then the held record's fields.
    """
    if kind == "min":
        cmp = [F.col(value).alias("__v")] + [as_long(df, o).alias(f"__o{i}")
                                           for i, o in enumerate(order)]
    else:
        cmp = [F.col(value).alias("__v")] + [(-as_long(df, o)).alias(f"__o{i}")
                                           for i, o in enumerate(order)]
    # a missing value never holds: as null, the struct is skipped by min and max
    s = F.when(F.col(value).isNotNull(), F.struct(*cmp, *[F.col(c) for c in record]))
    r = prefix_scan(df, [key], order, [Agg("__held", kind, s)], **scan_opts)
    return r.select(key, *[F.col(o).alias(f"at_{o}") for o in order],
                    *[F.col(f"__held.{c}").alias(c) for c in record])


def running_sum_count(df: DataFrame, key: str, value: str, order: Sequence[str],
                      **scan_opts) -> DataFrame:
    """Running ``(sum, count)`` per key; the running average is ``sum / count``."""
    r = prefix_scan(df, [key], order,
                    [Agg("running_sum", "sum", wide(df, value)),
                     Agg("running_count", "sum", F.lit(1).cast("long"))], **scan_opts)
    return r.withColumn("running_avg", F.col("running_sum") / F.col("running_count"))


def first_seen(df: DataFrame, key: str, item: str, order: Sequence[str], out: str = "__new") -> DataFrame:
    """Add flag ``out``: 1 if this row is the first of its ``(key, item)`` pair (a missing item: 0).

    The pairs' first places are aggregated map-side before they are shuffled, so
    a pair holding a large share of the rows is one row of that side of the join.
    """
    firsts = df.where(F.col(item).isNotNull()).groupBy(F.col(key).alias("__kf_k"), F.col(item).alias("__kf_i")).agg(
        F.min(F.struct(*order)).alias("__kf_first"))
    on = F.col(key).eqNullSafe(F.col("__kf_k")) & (F.col(item) == F.col("__kf_i"))
    return df.join(firsts, on, "left").select(
        *[df[c] for c in df.columns], F.struct(*order).eqNullSafe(F.col("__kf_first")).cast("long").alias(out))


def running_distinct(df: DataFrame, key: str, item: str, order: Sequence[str],
                     out: str = "distinct_count", **scan_opts) -> DataFrame:
    """Running number of distinct ``item`` per ``key`` after every row.

    Linear: first-seen flag, then a running sum; no set is held in memory
    (the reference keeps every row of the key in list state).  Hot keys are
    sliced on the input, so the flags are worked out once.
    """
    sliced, pairs = assign_buckets(df, [key], order[0], scan_opts.get("rows_per_bucket"), then=order[1:])
    flagged = first_seen(sliced.withColumnRenamed("__kf_bucket", "__kf_slice"), key, item, order)
    r = prefix_scan(flagged, [key], order, [Agg(out, "sum", F.col("__new"))], bucket=F.col("__kf_slice"), pairs=pairs)
    return r.select(key, *order, item, out)
