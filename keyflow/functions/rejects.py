"""Parsing that keeps what it cannot read: good rows and dead letters in one pass.

A ``Layout`` names the fields of a comma-separated line with their places and
types.  ``check`` reads every line once into a value per field or the first
field that is wrong and why; ``accepted`` and ``rejected`` are views of that.
Both the strict and the lenient parsers of ``functions.parse`` lose the line of
a bad field: this is the third choice, and works on batch and live input alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.sources.text import NULL_TEXT

FIELD, CAUSE, LINE = "reject_field", "reject_cause", "reject_line"


@dataclass(frozen=True)
class Field:
    """Field ``at`` place ``place`` of a line; ``empty`` gives the value of the null marker, if the field may hold it."""

    name: str
    place: int
    type: str = "string"
    nullable: bool = False
    empty: object = None


@dataclass(frozen=True)
class Layout:
    """Fields of a line, and how many it must have at least."""

    fields: Sequence[Field]

    @property
    def width(self) -> int:
        return 1 + max(f.place for f in self.fields)


# The record layouts of the jobs.
PROFIT = Layout([Field("month", 1), Field("category", 2), Field("product", 3), Field("profit", 4, "int")])
TIMED = Layout([Field("millis", 0, "bigint"), Field("num", 1, "bigint")])
KEYED = Layout([Field("key", 0, "bigint"), Field("num", 1, "bigint")])
CLICK = Layout([Field("user_id", 0), Field("network", 1), Field("ip", 2), Field("country", 3), Field("website", 4),
                Field("time_spent", 5, "int")])
EMPLOYEE = Layout([Field("id", 0), Field("department", 3)])
TRIP = Layout([Field("id", 0), Field("license_plate", 1), Field("car_type", 2), Field("driver", 3), Field("ongoing", 4),
               Field("pickup", 5, nullable=True), Field("dropoff", 6, nullable=True),
               Field("passengers", 7, "int", nullable=True, empty=0)])


def _value(text: Column, f: Field) -> Column:
    value = text if f.type == "string" else text.try_cast(f.type)
    if not f.nullable:
        return value
    return F.when(text == NULL_TEXT, F.lit(f.empty).cast(f.type)).otherwise(value)


def check(df: DataFrame, layout: Layout, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """``keep``, the layout's fields (null in a rejected line), ``reject_line``, ``reject_field`` and ``reject_cause``."""
    # the line, its parts and the verdict each in a projection of its own: none is worked out twice
    d = df.select(*keep, F.col(value).alias(LINE))
    d = d.select("*", F.split(LINE, ",", -1).alias("__kf_parts"))
    parts = F.col("__kf_parts")
    bad = F.when(F.col(LINE).isNull(), F.struct(F.lit(None).cast("string").alias("f"), F.lit("no line").alias("c")))
    for f in sorted(layout.fields, key=lambda f: f.place):
        text = F.get(parts, F.lit(f.place))
        bad = bad.when(F.size(parts) <= f.place, F.struct(F.lit(f.name).alias("f"), F.lit("missing").alias("c")))
        if f.type != "string":
            wrong = text.try_cast(f.type).isNull()
            wrong = wrong & (text != NULL_TEXT) if f.nullable else wrong
            bad = bad.when(wrong, F.struct(F.lit(f.name).alias("f"), F.lit(f"not {f.type}").alias("c")))
    d = d.select("*", bad.alias("__kf_bad"))
    good = F.col("__kf_bad").isNull()
    fields = [F.when(good, _value(F.get("__kf_parts", F.lit(f.place)), f)).alias(f.name) for f in layout.fields]
    return d.select(*keep, *fields, LINE, F.col("__kf_bad.f").alias(FIELD), F.col("__kf_bad.c").alias(CAUSE))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(CAUSE).isNull()).drop(LINE, FIELD, CAUSE)


def rejected(checked: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return checked.where(F.col(CAUSE).isNotNull()).select(*keep, LINE, FIELD, CAUSE)


def outputs() -> dict[str, Column]:
    """The two filters for ``streaming.sinks.write_split``: one pass over a live stream, two outputs."""
    return {"accepted": F.col(CAUSE).isNull(), "rejected": F.col(CAUSE).isNotNull()}
