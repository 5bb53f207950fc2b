"""Records and exclusion rules as one keyed stream.

Two inputs are read as one: a rule row and a record row carry the same columns
and a tag.  Step one is keyed by id and keeps the id's rule in state: a record
passes if no rule for its id arrived before it (or with it).  Step two is keyed
by the records' key and keeps one counter.  Both states live in the state store,
so a micro-batch costs what its rows cost, however many rules or keys there are;
nothing is rewritten or broadcast.  Counters can start from ``initial`` counts,
such as those of a batch run over the history.

Within a micro-batch rows of an id are taken in order of ``at``; a rule wins ties.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from keyflow.streaming.processors import RunningCount, _collect, _schema

_RULE, _AT = "kf_rule", "kf_at"


class RuleGate(StatefulProcessor):
    """Records of an id until a rule for it arrives.  State: the place of the id's first rule."""

    def __init__(self, cols: Sequence[str], order: Sequence[str]):
        self.cols, self.order = list(cols), list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rule = handle.getValueState("rule", "at LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _collect(rows, [_AT])
        if df.empty:
            return
        since = self.rule.get()[0] if self.rule.exists() else None
        is_rule = df[_RULE].to_numpy(dtype=bool)
        if is_rule.any():
            first = int(df.loc[is_rule, _AT].min())
            if since is None or first < since:
                since = first
                self.rule.update((since,))
        passes = ~is_rule
        if since is not None:
            passes &= df[_AT].to_numpy() < since
        if passes.any():
            yield df.loc[passes, self.cols]

    def close(self) -> None:
        pass


class StartedCount(RunningCount):
    """A running count per key that may start from a given number."""

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.count.update((int(initialState.iloc[0, -1]),))


def pass_rules(records: DataFrame, rules: DataFrame, record_at: str, rule_at: str, id_col: str = "id",
               rule_id: str | None = None) -> DataFrame:
    """Records without an earlier rule for their id.  ``record_at`` and ``rule_at`` are LONG places in arrival order."""
    cols = records.columns
    a = records.select(*cols, F.col(record_at).cast("long").alias(_AT), F.lit(False).alias(_RULE))
    b = rules.select(F.col(rule_id or id_col).cast(records.schema[id_col].dataType).alias(id_col),
                     F.col(rule_at).cast("long").alias(_AT), F.lit(True).alias(_RULE))
    both = a.unionByName(b, allowMissingColumns=True)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in records.schema])
    return both.groupBy(id_col).transformWithStateInPandas(RuleGate(cols, [_AT]), schema, "append", "None")


def count_passed(passed: DataFrame, key: str, order: Sequence[str], out: str = "count",
                 initial: DataFrame | None = None) -> DataFrame:
    """Running count per key of the records that passed; ``initial``: ``key, count`` to start from."""
    extra = [passed.schema[o] for o in order] + [T.StructField(out, T.LongType())]
    start = None
    if initial is not None:
        start = initial.select(key, F.col("count").cast("long").alias("count")).groupBy(key)
    return passed.groupBy(key).transformWithStateInPandas(
        StartedCount([key], order, out), _schema(passed, [key], extra), "append", "None", start)


def exclude_count_stream(records: DataFrame, rules: DataFrame, key: str, order: Sequence[str], record_at: str,
                         rule_at: str, id_col: str = "id", initial: DataFrame | None = None) -> DataFrame:
    """Running count per key of the records that no earlier rule excludes: ``key, order..., count``."""
    return count_passed(pass_rules(records, rules, record_at, rule_at, id_col), key, order, initial=initial)
