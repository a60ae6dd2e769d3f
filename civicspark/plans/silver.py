"""From landed records to clean tables: the daily weather archive, hourly forecast revisions and area boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import partition_date, strict_date, wall_clock_to_utc
from ..functions.wkt import multipolygon, valid_rings
from ..operators.quality import Range, tag_rejects
from ..operators.timeseries import newest

# The inclusive plausibility bounds of each measure.
ARCHIVE_RANGES = (Range("snowfall_sum_cm", 0, 200), Range("temperature_2m_min_c", -60, 50), Range("temperature_2m_max_c", -60, 50))
FORECAST_RANGES = (Range("temperature_2m", -40, 50), Range("precipitation", 0), Range("snowfall", 0), Range("windspeed_10m", 0, 200))
BOROUGHS = (1, 2, 3, 4, 5)


def lineage(df: DataFrame, source_id: str) -> DataFrame:
    return df.withColumns({"source_id": F.lit(source_id), "loaded_at": F.current_timestamp()})


def archive_days(raw: DataFrame, source_id: str) -> DataFrame:
    """Daily archive rows with a real date, a partition date, units in the names, and a reason where they are rejected.
    Days are those of the source's own calendar: nothing is shifted."""
    units = {"snowfall_sum": "snowfall_sum_cm", "temperature_2m_min": "temperature_2m_min_c", "temperature_2m_max": "temperature_2m_max_c"}
    day = strict_date(F.col("time"))
    rows = raw.withColumn("weather_date", day).withColumn(
        "date", partition_date(F.col("weather_date"))
    ).drop("time").withColumnsRenamed(units)
    return tag_rejects(lineage(rows, source_id), not_null=["weather_date"], ranges=ARCHIVE_RANGES)


def forecast_hours(raw: DataFrame, source_id: str, zone: str) -> DataFrame:
    """Of each instant the newest revision, in UTC, with a reason where it is rejected. Revisions are compared after the
    conversion, so the two hours of an autumn fold are only merged where their wall clock can't tell them apart."""
    rows = raw.withColumn("time_utc", wall_clock_to_utc(F.col("time"), zone))
    kept = newest(
        rows,
        ["time_utc", "time"],
        [F.col("ingest_date").desc(), *[F.col(r.column).desc() for r in FORECAST_RANGES if r.column in raw.columns]],
    )
    kept = kept.drop("time").withColumn("date", partition_date(F.col("time_utc")))
    return tag_rejects(lineage(kept, source_id), not_null=["time_utc"], ranges=FORECAST_RANGES)


def boundaries(raw: DataFrame, source_id: str) -> DataFrame:
    """Areas with typed scalars and geometry as text; unknown ids, missing geometries and open rings are rejected."""
    number = lambda c, kind: F.col(c).try_cast(kind)
    rows = raw.select(
        "*",
        number("borocode", "int").alias("borough_id"),
        F.col("boroname").alias("borough_name"),
        number("shape_area", "double").alias("shape_area_sqft"),
        number("shape_leng", "double").alias("shape_leng_ft"),
        multipolygon(F.col("the_geom.coordinates")).alias("geometry_wkt"),
    )
    rows = tag_rejects(lineage(rows, source_id), domains={"borough_id": (BOROUGHS, "invalid_borough_id")}, not_null=[])
    reason = F.coalesce(
        "_reject_reason",
        F.when(F.col("geometry_wkt").isNull(), "null_geometry"),
        F.when(~F.coalesce(valid_rings(F.col("the_geom.coordinates")), F.lit(False)), "open_ring"),
    )
    return rows.withColumn("_reject_reason", reason)
