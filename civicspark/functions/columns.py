"""Parsing, casting and calendar functions on columns. What can't be parsed is null, so that it can be rejected later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_date(text: Column) -> Column:
    """A date written yyyy-MM-dd; null for anything else."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def partition_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def wall_clock_to_utc(text: Column, zone: str) -> Column:
    """A naive local wall-clock time as an instant. In an autumn fold the earlier offset counts; in a spring gap the
    clock is taken to have run on."""
    return F.to_utc_timestamp(F.try_to_timestamp(text.cast("string")), zone)


def missing(value: Column, kind: str) -> Column:
    """Whether a value says nothing: null, and the empty string, zero, false or empty array."""
    if kind == "string":
        empty = value == ""
    elif kind in ("boolean",):
        empty = ~value
    elif kind.startswith("array"):
        empty = F.size(value) == 0
    elif kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        empty = value == 0
    else:
        empty = F.lit(False)
    return value.isNull() | F.coalesce(empty, F.lit(False))


def winter(day: Column) -> Column:
    """The year in which the winter of November to March began; null from April to October."""
    return F.when(F.month(day) >= 11, F.year(day)).when(F.month(day) <= 3, F.year(day) - 1)


def in_window(value: Column, start: object, end: object | None = None) -> Column:
    """start <= value < end; no upper bound without end."""
    inside = value >= F.lit(start)
    return inside if end is None else inside & (value < F.lit(end))


def in_lookback(day: Column, until: Column, days: int = 7) -> Column:
    """The ``days`` days that end with ``until``, which is included."""
    return (day > F.date_sub(until, days)) & (day <= until)


def level(score: Column, cuts: Sequence[tuple[float, str]], lowest: str) -> Column:
    """The name of the highest cut that the score reaches."""
    out = F.when(score.isNull(), F.lit(None).cast("string"))
    for least, name in sorted(cuts, reverse=True):
        out = out.when(score >= least, F.lit(name))
    return out.otherwise(lowest)
