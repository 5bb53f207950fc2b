"""Bounded iteration with a feedback edge.

``iterate`` runs ``step`` on the rows that are not ``done`` until none are
left.  Each round is one distributed job over the live rows; the driver only
decides whether to go on (an emptiness check).  Lineage is cut with a
reliable ``checkpoint()`` in the cluster's checkpoint folder, so a lost
executor recomputes at most one round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.session import checkpoint_dir


_DONE = "__kf_done"


class IterationLimitError(RuntimeError):
    pass


def iterate(df: DataFrame, step: Callable[[DataFrame], DataFrame],
            done: Callable[[DataFrame], Column], max_iter: int,
            rounds_per_job: int = 4) -> DataFrame:
    """Apply ``step`` until every row satisfies ``done``; return the finished rows.

    Rows that are done before any step leave unchanged.  ``rounds_per_job``
    rounds are unrolled into one plan between lineage cuts, so a loop of k
    rounds costs about k / rounds_per_job materializations.  Raises
    ``IterationLimitError`` if rows are still live after ``max_iter`` rounds
    (a start value that never reaches the exit condition).
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    finished: list[DataFrame] = []
    live = df
    steps = 0
    while True:
        parts: list[DataFrame] = []
        for _ in range(rounds_per_job):
            parts.append(live.where(done(live)).withColumn(_DONE, F.lit(True)))
            live = live.where(~done(live))
            if steps == max_iter:
                break
            live = step(live)
            steps += 1
        # finished rows are stored at each cut, with the live ones: no round is run again for the result
        cut = live.withColumn(_DONE, F.lit(False))
        for p in parts:
            cut = cut.unionByName(p)
        cut = cut.checkpoint(eager=True)
        finished.append(cut.where(_DONE).drop(_DONE))
        live = cut.where(f"NOT {_DONE}").drop(_DONE)
        if live.isEmpty():
            break
        if steps == max_iter:
            raise IterationLimitError(f"rows still live after {max_iter} rounds")
    out = finished[0]
    for f in finished[1:]:
        out = out.unionByName(f)
    return out
