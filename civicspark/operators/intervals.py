"""Joins of intervals and of times: overlaps, the latest before, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Days are counted from 1970 on; so many more, and no date's number is negative.
_BASE_DAY = 1 << 20


def _day(column: str) -> Column:
    return F.datediff(F.col(column).cast("date"), F.lit("1970-01-01").cast("date")) + _BASE_DAY


def cover(first: str, last: str, height: int) -> Column:
    """The dyadic ranges (level, place) that make up the days ``first`` to ``last``: at most two of each level up to
    ``height``, so about twice the logarithm of an interval's length however long it is; none if it is empty."""
    left, right = f"ceil(({first}) / shiftleft(1L, k))", f"floor((({last}) + 1) / shiftleft(1L, k))"
    pick = (
        f"filter(array(if({left} < {right} AND {left} % 2 = 1, named_struct('level', k, 'place', {left}), null), "
        f"if({left} < {right} AND {right} % 2 = 1, named_struct('level', k, 'place', {right} - 1), null)), x -> x IS NOT NULL)"
    )
    return F.expr(f"flatten(transform(sequence(0, {height}), k -> {pick}))")


def path(day: str, height: int) -> Column:
    """The dyadic ranges up to ``height`` that hold a day: one of each level."""
    return F.expr(f"transform(sequence(0, {height}), k -> named_struct('level', k, 'place', CAST(shiftright({day}, k) AS BIGINT)))")


def overlaps(left: DataFrame, right: DataFrame, *, on: list[str], left_span: tuple[str, str], right_span: tuple[str, str]) -> DataFrame:
    """Action: rows of both sides whose closed date intervals meet, with equal ``on``. Column names of the sides must differ.

    Of two intervals that meet, the later one begins within the other. An interval is covered by dyadic ranges of days, of
    which one holds that day, so the join is on equal ranges, a pair is found once, and an interval has a few rows whatever
    its length. Rows with a null bound, or that end before they begin, meet nothing. The action is for each side's longest.
    """
    a, b = left_span
    c, d = right_span
    own = lambda df, s, e: df.where(F.col(s) <= F.col(e)).withColumns({"_from": _day(s).cast("long"), "_to": _day(e).cast("long")})
    one, two = own(left, a, b), own(right, c, d).withColumnsRenamed({"_from": "_from_2", "_to": "_to_2"})
    heights = [int(df.agg(F.max(F.expr(f"{e} - {s} + 1"))).first()[0] or 1).bit_length() for df, s, e in ((one, "_from", "_to"), (two, "_from_2", "_to_2"))]
    dealt = lambda df, ranges: df.withColumn("_range", F.explode(ranges))
    keys = [*on, "_range"]
    # the right one begins within the left one, or the left one after the right one's first day
    inside = dealt(one, cover("_from", "_to", heights[0])).join(dealt(two, path("_from_2", heights[0])), keys)
    after = dealt(one, path("_from", heights[1])).join(dealt(two, cover("_from_2 + 1", "_to_2", heights[1])), keys)
    met = inside.unionByName(after).where((F.col(a) <= F.col(d)) & (F.col(c) <= F.col(b)))
    return met.drop("_range", "_from", "_to", "_from_2", "_to_2")


def latest_before(left: DataFrame, right: DataFrame, *, on: list[str], left_time: str, right_time: str, take: list[str]) -> DataFrame:
    """Each left row with ``take`` of the right row that is latest at or before it, for equal ``on``; null without one.

    Both sides are laid in one line by time and the last right row is carried forward, within each month; what a month
    begins with is the last row of the months before, of which each has one row. So no pairs are made, and a key of many
    rows isn't in one task. Equal times of the right side are taken by the larger values of ``take``; null keys are equal.
    """
    only = [c for c in left.columns if c not in on]
    a = left.select(
        *on,
        F.col(left_time).alias("_t"),
        F.lit(1).alias("_side"),
        F.struct(*only).alias("_left"),
        F.lit(None).cast(right.select(F.struct(*take)).schema[0].dataType).alias("_right"),
    )
    b = right.where(F.col(right_time).isNotNull()).select(
        *on,
        F.col(right_time).alias("_t"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(left.select(F.struct(*only)).schema[0].dataType).alias("_left"),
        F.struct(*take).alias("_right"),
    )
    rows = a.unionByName(b).withColumn("_month", F.date_trunc("month", "_t"))
    line = Window.partitionBy(*on, "_month").orderBy("_t", "_side", "_right").rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.withColumn("_last", F.last("_right", ignorenulls=True).over(line)).where("_side = 1")
    ends = rows.groupBy(*on, "_month").agg(F.max(F.when(F.col("_side") == 0, F.struct("_t", "_right"))).alias("_end"))
    months = Window.partitionBy(*on).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(
        *[F.col(c).alias(f"_{c}_2") for c in on], F.col("_month").alias("_month_2"), F.last("_end", ignorenulls=True).over(months).alias("_before")
    )
    same = F.col("_month").eqNullSafe(F.col("_month_2"))
    for c in on:
        same = same & carried[c].eqNullSafe(before[f"_{c}_2"])
    last = F.coalesce("_last", "_before._right")
    found = carried.join(before, same, "left").withColumn("_last", last)
    return found.select(*[carried[c] for c in on], *[F.col(f"_left.{c}").alias(c) for c in only], *[F.col(f"_last.{c}").alias(c) for c in take])


def supply_gaps(
    events: DataFrame,
    zones: DataFrame,
    shifts: DataFrame,
    *,
    supply_start: object,
    event: str = "event_id",
    span: tuple[str, str] = ("start_date", "end_date"),
    zone: str = "zone",
    shift_span: tuple[str, str] = ("shift_start", "shift_end"),
) -> DataFrame:
    """Every event and zone with ``supply_gap``: 1 if no shift of the zone overlaps the event, 0 if one does, null for
    events before the supply series begins. ``zones`` is a list of areas, in one row each, bounded by the city.

    Of shifts of a zone with the same start the longest is enough: they come together before they are shuffled and dealt to
    ranges, in which there are no more of them than starts.
    """
    grid = events.select(event, *span).crossJoin(zones.select(zone))
    longest = shifts.groupBy(zone, shift_span[0]).agg(F.max(shift_span[1]).alias(shift_span[1]))
    met = overlaps(grid, longest, on=[zone], left_span=span, right_span=shift_span).select(event, zone).distinct().withColumn("_met", F.lit(True))
    gap = F.when(F.col(span[0]) >= F.lit(supply_start).cast("date"), F.when(F.col("_met").isNull(), 1).otherwise(0))
    return grid.join(met, [event, zone], "left").select(event, zone, *span, gap.alias("supply_gap"))
