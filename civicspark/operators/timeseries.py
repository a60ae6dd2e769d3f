"""Operators on dated rows: events from daily series, newest revisions, calendars, rolling medians."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .quality import threshold


def segment_events(
    df: DataFrame, *, day: str, measure: str, least: float, gap_days: int = 0, by: Sequence[str] = (), low: str | None = None, prefix: str = "SNOW"
) -> DataFrame:
    """One row for each event: days that reach ``least``, bridging up to ``gap_days`` days that don't.

    Returns ``by``, event_id, start_date, end_date, duration_days (calendar days, bridged ones included), qualifying_days,
    total, peak and, with ``low``, the least of that column. Days are first joined to islands within a series and year,
    and islands then across years, so that a long series isn't in one task.
    """
    if gap_days < 0:
        raise ValueError(f"gap_days must not be negative: {gap_days}")
    rows = threshold(df, measure, least, "least").where(F.col(day).isNotNull())
    rows = rows.select(
        *by,
        F.col(day).cast("date").alias("_from"),
        F.col(day).cast("date").alias("_to"),
        F.col(measure).alias("_total"),
        F.col(measure).alias("_peak"),
        F.lit(1).alias("_days"),
        (F.col(low) if low else F.lit(None).cast("double")).alias("_low"),
    )
    parts = _islands(rows.withColumn("_year", F.year("_from")), [*by, "_year"], gap_days).drop("_year")
    found = _islands(parts, [*by], gap_days)
    out = found.select(
        *by,
        F.concat_ws("-", F.lit(prefix), F.date_format("_from", "yyyyMMdd")).alias("event_id"),
        F.col("_from").alias("start_date"),
        F.col("_to").alias("end_date"),
        (F.datediff("_to", "_from") + 1).cast("int").alias("duration_days"),
        F.col("_days").cast("int").alias("qualifying_days"),
        F.col("_total").alias("total"),
        F.col("_peak").alias("peak"),
        F.col("_low").alias("low"),
    )
    return out if low else out.drop("low")


def _islands(rows: DataFrame, by: list[str], gap_days: int) -> DataFrame:
    """Intervals that follow each other with at most ``gap_days`` days between them, made one."""
    order = Window.partitionBy(*by).orderBy("_from", "_to")
    reach = F.max("_to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.datediff("_from", reach) > gap_days + 1, F.lit(True)).cast("int")
    island = F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = rows.withColumn("_begins", begins).withColumn("_island", island)
    return numbered.groupBy(*by, "_island").agg(
        F.min("_from").alias("_from"),
        F.max("_to").alias("_to"),
        F.sum("_total").alias("_total"),
        F.max("_peak").alias("_peak"),
        F.sum("_days").alias("_days"),
        F.min("_low").alias("_low"),
    ).drop("_island")


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of each key the row that comes first in ``order``, which should leave no ties."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def newest_by(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The same for the largest ``version``, by aggregation: partial results combine before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_best"))
    return best.select(*keys, "_best.*").select(df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Old and new rows, of each key the newest version."""
    return newest_by(old.unionByName(new), keys, version)


def days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """``day`` for each day of [start, end); none if end isn't after start."""
    empty = spark.range(0).select(F.lit(start).cast("date").alias("day"))
    if end <= start:
        return empty
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end - timedelta(days=1)))).alias("day"))


def months(spark: SparkSession, start: date, end: date) -> DataFrame:
    """``month``, the first of each month that [start, end) touches."""
    if end <= start:
        return spark.range(0).select(F.lit(start).cast("date").alias("month"))
    span = F.sequence(F.trunc(F.lit(start), "MM"), F.trunc(F.lit(end - timedelta(days=1)), "MM"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(span).alias("month"))


def rolling_median(
    df: DataFrame, *, day: str, value: str, by: Sequence[str], days_back: int = 30, include_today: bool = False
) -> DataFrame:
    """Adds ``median``, over the rows of the last ``days_back`` days; with or without the row's own day."""
    number = F.datediff(F.col(day), F.lit(date(1970, 1, 1)))
    last = 0 if include_today else -1
    frame = Window.partitionBy(*by).orderBy(number).rangeBetween(last - days_back + 1, last)
    return df.withColumn("median", F.percentile(value, F.lit(0.5)).over(frame))


def date_dimension(spark: SparkSession, start: date, end: date) -> DataFrame:
    day = F.col("day")
    return days(spark, start, end).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"), day, F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"), F.dayofmonth(day).alias("day_of_month"),
        (F.weekday(day) + 1).alias("iso_weekday"), (F.weekday(day) >= 5).alias("is_weekend"), F.when(F.month(day) >= 11, F.year(day)).when(F.month(day) <= 3, F.year(day) - 1).alias("winter"),
    )


def time_dimension(spark: SparkSession) -> DataFrame:
    minute = F.col("id").cast("int")
    hour = F.floor(minute / 60).cast("int")
    part = F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon").otherwise("evening")
    return spark.range(24 * 60).select(
        minute.alias("time_key"), hour.alias("hour"), (minute % 60).alias("minute"), part.alias("part_of_day")
    )
