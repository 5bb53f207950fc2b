"""Parsers for the comma-separated record layouts.

Each parser maps a DataFrame with a ``value`` line column to typed columns
with column expressions (``split`` + index + cast), so parsing runs inside
whole-stage codegen and works on batch and streaming input alike.

``strict=True`` (default) fails the job on a malformed line, as the
reference's ``Integer.parseInt`` does (ANSI casts and array indexing raise).
``strict=False`` turns malformed fields into nulls instead (dead-letter
friendly).  Spark's casts trim surrounding blanks; Java's do not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.time import from_epoch_millis
from keyflow.sources.text import NULL_TEXT


def _fields(value: str = "value") -> Column:
    return F.split(F.col(value), ",", -1)


def _get(parts: Column, i: int, strict: bool) -> Column:
    found = F.get(parts, F.lit(i))
    if strict:  # fails by itself, whatever the session's ANSI setting
        short = F.raise_error(F.concat(F.lit(f"no field {i} in: "), F.array_join(parts, ",")))
        return F.when(F.size(parts) <= i, short).otherwise(found)
    return found


def _cast(c: Column, t: str, strict: bool) -> Column:
    if strict:
        bad = F.raise_error(F.concat(F.lit(f"not a valid {t}: "), c))
        return F.when(c.isNotNull() & c.try_cast(t).isNull(), bad).otherwise(c.try_cast(t))
    return c.try_cast(t)


def _select(df: DataFrame, keep: Sequence[str], cols: list[Column]) -> DataFrame:
    return df.select(*keep, *cols)


def parse_profit(df: DataFrame, with_count: bool = True, strict: bool = True,
                 keep: Sequence[str] = ()) -> DataFrame:
    """``date,month,category,product,profit`` -> month, category, product, profit[, n].

    The date is dropped; ``n`` is the constant 1 used by average-by-reduce.
    """
    p = _fields()
    cols = [_get(p, 1, strict).alias("month"), _get(p, 2, strict).alias("category"),
            _get(p, 3, strict).alias("product"),
            _cast(_get(p, 4, strict), "int", strict).alias("profit")]
    if with_count:
        cols.append(F.lit(1).alias("n"))
    return _select(df, keep, cols)


def parse_timed(df: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """``epoch_millis,number`` -> ts (TIMESTAMP_NTZ), num (LONG)."""
    p = _fields()
    return _select(df, keep, [
        from_epoch_millis(_cast(_get(p, 0, strict), "long", strict)).alias("ts"),
        _cast(_get(p, 1, strict), "long", strict).alias("num")])


def parse_keyed(df: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """``key,number`` -> key (LONG), num (LONG)."""
    p = _fields()
    return _select(df, keep, [_cast(_get(p, 0, strict), "long", strict).alias("key"),
                              _cast(_get(p, 1, strict), "long", strict).alias("num")])


def parse_trip(df: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Trip line -> record.  ``yes`` -> true; ``'null'`` -> null text / 0 passengers."""
    p = _fields()
    g = lambda i: _get(p, i, strict)
    pax = g(7)
    return _select(df, keep, [
        g(0).alias("id"), g(1).alias("license_plate"), g(2).alias("car_type"),
        g(3).alias("driver"), (g(4) == F.lit("yes")).alias("ongoing"),
        F.nullif(g(5), F.lit(NULL_TEXT)).alias("pickup"),
        F.nullif(g(6), F.lit(NULL_TEXT)).alias("dropoff"),
        F.when(pax == F.lit(NULL_TEXT), F.lit(0))
         .otherwise(_cast(pax, "int", strict)).cast("int").alias("passengers")])


def parse_click(df: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """``user_id,network,ip,country,website,time_spent`` -> the six click columns."""
    p = _fields()
    names = ["user_id", "network", "ip", "country", "website"]
    return _select(df, keep, [_get(p, i, strict).alias(n) for i, n in enumerate(names)]
                   + [_cast(_get(p, 5, strict), "int", strict).alias("time_spent")])


def parse_employee(df: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Employee line: field 0 is the id, field 3 the department; others opaque."""
    p = _fields()
    return _select(df, keep, [_get(p, 0, strict).alias("id"),
                              _get(p, 3, strict).alias("department"),
                              F.col("value").alias("line")])


def parse_int(df: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """One integer per line -> ``n`` (INT)."""
    return _select(df, keep, [_cast(F.col("value"), "int", strict).alias("n")])
