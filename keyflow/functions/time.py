"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def from_epoch_millis(c: Column) -> Column:
    """Epoch milliseconds (LONG) -> TIMESTAMP_NTZ, zone-free."""
    return F.timestamp_add("MILLISECOND", c, F.expr(_EPOCH_NTZ))


def epoch_millis(c: Column | str) -> Column:
    """TIMESTAMP_NTZ -> epoch milliseconds, floored (DuckDB: ``epoch_us(ts)//1000``)."""
    us = epoch_micros(c)
    return ((us - F.pmod(us, F.lit(1000))) / 1000).cast("long")


def epoch_micros(c: Column | str) -> Column:
    """TIMESTAMP_NTZ -> epoch microseconds from its fields (no time zone involved)."""
    c = F.col(c) if isinstance(c, str) else c
    day = F.unix_date(F.to_date(c)).cast("long")
    secs = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long")
    micros_in_min = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return day * 86_400_000_000 + secs * 1_000_000 + micros_in_min


def event_time(c: Column | str) -> Column:
    """NTZ -> TIMESTAMP for ``withWatermark`` (which rejects NTZ), zone-free.

    Interprets the wall-clock value as UTC.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(epoch_micros(c))


def with_ingest_time(df: DataFrame, name: str = "ingest_ts") -> DataFrame:
    """Processing-time column (constant within a micro-batch / query)."""
    return df.withColumn(name, F.current_timestamp())


# English month names, as the record layouts write them.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]


def month_name(c: Column | str) -> Column:
    """Full English month name from integer field extraction (no formatter)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(c))

