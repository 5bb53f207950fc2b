"""Count-based windows per key (batch forms).

All of these depend on each key's arrival ordinal ``rn``.  It comes from the
hot-key safe ``row_ordinal`` (two-level prefix count), after which every
count window is a plain ``groupBy(key, block)`` with blocks of at most
``size`` rows, so no task ever holds more than one block of a key.

Streaming forms (per-key managed state) are in
``keyflow.streaming.processors``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.number import wide
from keyflow.plans.scan import Agg, prefix_scan, row_ordinal


def _first(order: Sequence[str], carry: Sequence[str]) -> Column:
    return F.struct(*[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)],
                    *[F.col(c) for c in carry])


def count_trigger(df: DataFrame, key: str, value: str, order: Sequence[str],
                  every: int = 5, carry: Sequence[str] = (), **scan_opts) -> DataFrame:
    """Global window per key with a count trigger that fires and does not purge.

    At every ``every``-th row of a key, emit the reduction of *all* rows of
    the key so far: sum of ``value``, row count, and the carry fields of the
    key's first row.  Output: key, rn, carry, total, n.
    """
    aggs = [Agg("rn", "sum", F.lit(1).cast("long")),
            Agg("total", "sum", wide(df, value))]
    if carry:
        aggs.append(Agg("__first", "min", _first(order, carry)))
    r = prefix_scan(df, [key], list(order), aggs, **scan_opts)
    r = r.where(F.col("rn") % every == 0)
    return r.select(key, "rn", *[F.col(f"__first.{c}").alias(c) for c in carry],
                    "total", F.col("rn").alias("n"))


def count_evictor(df: DataFrame, key: str, value: str, order: Sequence[str],
                  every: int = 5, keep: int = 4, carry: Sequence[str] = (),
                  **scan_opts) -> DataFrame:
    """Count trigger ``every`` with a count evictor ``keep`` (evict before).

    At every ``every``-th row, the window holds only the last ``keep`` rows
    (evicted rows are gone for good), and they are reduced: sum, count and
    the carry fields of the oldest kept row.  Output: key, rn, carry, total, n.
    """
    if keep > every:
        return _count_evictor_long(df, key, value, order, every, keep, carry, **scan_opts)
    r = row_ordinal(df, [key], list(order), **scan_opts)
    r = r.withColumn("__blk", F.expr(f"(rn - 1) div {every}"))
    kept = r.where((F.col("rn") - F.col("__blk") * every) > (every - keep))
    aggs = [F.max("rn").alias("rn"), F.sum(wide(df, value)).alias("total"),
            F.count(F.lit(1)).alias("n")]
    if carry:
        aggs.append(F.min(_first(order, carry)).alias("__first"))
    g = kept.groupBy(key, "__blk").agg(*aggs).where(F.col("rn") % every == 0)
    return g.select(key, "rn", *[F.col(f"__first.{c}").alias(c) for c in carry],
                    "total", "n")


def _count_evictor_long(df, key, value, order, every, keep, carry, **scan_opts):
    """``keep > every``: the kept rows span blocks; use prefix sums.

    total(rn) = S(rn) - S(rn - keep); the oldest kept row is ``rn - keep + 1``.
    Both are equi-joins on (key, ordinal): no hot partition.
    """
    r = prefix_scan(df, [key], list(order),
                    [Agg("rn", "sum", F.lit(1).cast("long")),
                     Agg("__S", "sum", wide(df, value))], **scan_opts)
    fires = r.where(F.col("rn") % every == 0).select(key, "rn", "__S")
    back = r.select(F.col(key).alias("__k"), F.col("rn").alias("__rn"),
                    F.col("__S").alias("__S0"),
                    *[F.col(c).alias(f"__c_{c}") for c in carry])
    j = fires.join(back, (F.col(key).eqNullSafe(F.col("__k")))
                   & (F.col("__rn") == F.col("rn") - keep), "left")
    first = fires.join(back, (F.col(key).eqNullSafe(F.col("__k")))
                       & (F.col("__rn") == F.greatest(F.col("rn") - keep + 1, F.lit(1))), "left")
    tot = j.select(key, "rn", (F.col("__S") - F.coalesce(F.col("__S0"), F.lit(0))).alias("total"),
                   F.least(F.col("rn"), F.lit(keep)).cast("long").alias("n"))
    fc = first.select(F.col(key).alias("__k2"), F.col("rn").alias("__rn2"),
                      *[F.col(f"__c_{c}").alias(c) for c in carry])
    out = tot.join(fc, F.col(key).eqNullSafe(F.col("__k2")) & (F.col("rn") == F.col("__rn2")))
    return out.select(key, "rn", *carry, "total", "n")


def count_windows(df: DataFrame, key: str, value: str, order: Sequence[str],
                  size: int = 10, reducers: Sequence[str] = ("sum",),
                  as_text: bool = False, **scan_opts) -> DataFrame:
    """Tumbling count window per key: every ``size`` consecutive rows of a key
    form one window, reduced and emitted; a trailing partial window is never
    emitted (state is kept, the trigger never fires).

    ``reducers`` any of sum, min, max, count.  ``as_text`` adds ``items``:
    the window's numbers as text in arrival order, each preceded by a space
    (the list-state job's output).  Output: key, win (0-based), reductions.
    """
    r = row_ordinal(df, [key], list(order), **scan_opts)
    r = r.withColumn("win", F.expr(f"(rn - 1) div {size}"))
    fns = {"sum": F.sum, "min": F.min, "max": F.max}
    aggs = [F.count(F.lit(1)).alias("__n")]
    for red in reducers:
        if red == "count":
            continue
        aggs.append(fns[red](wide(df, value)).alias(red))
    if as_text:
        # window holds exactly `size` rows: sorting them in the task is bounded
        items = F.sort_array(F.collect_list(F.struct("rn", F.col(value).cast("string").alias("x"))))
        aggs.append(F.concat(F.lit(" "), F.array_join(F.transform(items, lambda s: s["x"]), " "))
                    .alias("items"))
    g = r.groupBy(key, "win").agg(*aggs).where(F.col("__n") == size)
    cols = [key, "win"] + [red if red != "count" else F.col("__n").alias("count")
                           for red in reducers]
    if as_text:
        cols.append("items")
    return g.select(*cols)


def buffered_groups(df: DataFrame, key: str, order: Sequence[str], size: int,
                    id_col: str, **scan_opts) -> DataFrame:
    """Groups of ``size`` consecutive rows per key, as a buffering sink flushes
    them: key, group number, row count, first and last id of the group.
    Only full groups are emitted in batch; the streaming sink flushes the
    remainder of every micro-batch (see ``streaming.sinks.buffered_sink``)."""
    r = row_ordinal(df, [key], list(order), **scan_opts)
    r = r.withColumn("grp", F.expr(f"(rn - 1) div {size}"))
    g = r.groupBy(key, "grp").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min_by(id_col, F.col("rn")).alias("first_id"),
        F.max_by(id_col, F.col("rn")).alias("last_id"))
    return g.where(F.col("rows") == size)
