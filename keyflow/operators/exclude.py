"""Exclusion joins: drop records whose id is on a rule list, count the rest.

The reference broadcasts a rule stream to every task and scans all rules per
record.  Here it is a left-anti *hash* join (O(1) per record).  The rule side
is broadcast only when a bounded check proves it small
(``keyflow.plans.sizing.broadcast_if_small``); otherwise Spark's own
shuffle join (and AQE's runtime broadcast conversion) applies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.plans.scan import Agg, prefix_scan
from keyflow.plans.sizing import broadcast_if_small


def exclude(records: DataFrame, rules: DataFrame, id_col: str = "id",
            rule_time: str | None = None, record_time: str | None = None) -> DataFrame:
    """Records whose id has no rule.  With ``rule_time``/``record_time`` a rule
    only excludes records that arrive at or after the rule became effective;
    the two go together."""
    if (rule_time is None) != (record_time is None):
        raise ValueError("rule_time and record_time go together")
    r = broadcast_if_small(rules.select(F.col(id_col).alias("__rid"),
                                        *([F.col(rule_time).alias("__rt")] if rule_time else [])))
    cond = F.col(id_col) == F.col("__rid")
    if rule_time:
        cond = cond & (F.col("__rt") <= F.col(record_time))
    return records.join(r, cond, "left_anti")


def running_count(df: DataFrame, key: str, order: Sequence[str], out: str = "count",
                  **scan_opts) -> DataFrame:
    """Per-record running count of the key (the state counter of the job)."""
    r = prefix_scan(df, [key], list(order), [Agg(out, "sum", F.lit(1).cast("long"))],
                    **scan_opts)
    return r.select(key, *order, out)


def total_count(df: DataFrame, key: str, out: str = "count") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
