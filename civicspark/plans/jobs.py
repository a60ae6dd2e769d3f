"""The jobs from landed records to clean tables: read, clean, split, enforce, write, gate.

Rows are kept once between the writes and the gates that count them. Gates raise after writing, so that what has been
written can be looked at; a rerun replaces the same partitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from ..operators import quality
from ..operators.timeseries import segment_events
from ..sources import landing
from . import silver


def _fields(text: str) -> StructType:
    kinds = {"s": StringType(), "d": DoubleType(), "i": IntegerType(), "date": DateType(), "ts": TimestampType()}
    return StructType([StructField(n, kinds[k]) for n, k in (x.split(":") for x in text.split())])


ARCHIVE_RAW = _fields("time:s snowfall_sum:d temperature_2m_min:d temperature_2m_max:d")
ARCHIVE = _fields("weather_date:date date:s snowfall_sum_cm:d temperature_2m_min_c:d temperature_2m_max_c:d source_id:s loaded_at:ts")
EVENTS = _fields(
    "event_id:s start_date:date end_date:date duration_days:i total_snowfall_cm:d peak_daily_snowfall_cm:d min_temperature_c:d source_id:s loaded_at:ts"
)
FORECAST_RAW = _fields("time:s temperature_2m:d precipitation:d snowfall:d windspeed_10m:d")
FORECAST = _fields("time_utc:ts date:s temperature_2m:d precipitation:d snowfall:d windspeed_10m:d source_id:s ingest_date:s loaded_at:ts")
GEOMETRY = StructType(
    [StructField("type", StringType()), StructField("coordinates", ArrayType(ArrayType(ArrayType(ArrayType(DoubleType())))))]
)
BOUNDARY_RAW = StructType([*_fields("borocode:s boroname:s shape_area:s shape_leng:s").fields, StructField("the_geom", GEOMETRY)])
BOUNDARY = _fields("borough_id:i borough_name:s shape_area_sqft:d shape_leng_ft:d geometry_wkt:s source_id:s loaded_at:ts")


@dataclass(frozen=True)
class Outcome:
    valid: int
    rejected: int
    events: int | None = None


def _store(tagged: DataFrame, schema: StructType, table: str, rejects: str, mode: str, partition: str | None) -> tuple[int, int]:
    """Writes both sides; returns how many rows are valid and rejected."""
    kept = tagged.persist()
    try:
        valid, rejected = quality.split(kept)
        valid = quality.enforce_schema(valid, schema, mode)
        landing.write_partitions(valid, table, partition) if partition else landing.write_whole(valid, table, files=1)
        landing.write_rejects(rejected, rejects)
        n = kept.agg(
            F.count_if(F.col(quality.REASON).isNull()).alias("v"), F.count_if(F.col(quality.REASON).isNotNull()).alias("r")
        ).first()
        return n["v"], n["r"]
    finally:
        kept.unpersist()


def clean_archive(spark: SparkSession, landed: str, table: str, rejects: str, start: date, end: date, source_id: str) -> Outcome:
    """Daily archive rows of [start, end); too few of them for the window is an error."""
    raw = landing.read_days(spark, landed, ARCHIVE_RAW, start, end).select(ARCHIVE_RAW.fieldNames())
    valid, rejected = _store(silver.archive_days(raw, source_id), ARCHIVE, table, rejects, "strict", "date")
    quality.require(valid, int((end - start).days * 0.9), f"archive of {start} to {end}")
    return Outcome(valid, rejected)


def rebuild_events(spark: SparkSession, table: str, events: str, source_id: str, *, threshold_cm: float = 2.0, gap_days: int = 0) -> int:
    """The whole event table anew from the whole archive, never from a slice of it; no event at all is an error."""
    archive = spark.read.schema(ARCHIVE).parquet(table)
    found = segment_events(
        archive, day="weather_date", measure="snowfall_sum_cm", least=threshold_cm, gap_days=gap_days, low="temperature_2m_min_c"
    )
    named = found.drop("qualifying_days").withColumnsRenamed(
        {"total": "total_snowfall_cm", "peak": "peak_daily_snowfall_cm", "low": "min_temperature_c"}
    )
    landing.write_whole(quality.enforce_schema(silver.lineage(named, source_id), EVENTS), events)
    return quality.require(spark.read.schema(EVENTS).parquet(events).count(), 1, "events")


def clean_forecast(
    spark: SparkSession, landed: str, table: str, rejects: str, start: date, end: date, source_id: str, zone: str
) -> Outcome:
    """The newest revision of each hour among all collections that can touch the same days, those of [start, end) and later
    ones; a window without a collection, or under 12 rows for each, is an error."""
    raw = landing.read_snapshots(spark, landed, FORECAST_RAW, start).drop("_source_file")
    collections = quality.require(
        raw.where(F.col("ingest_date") < end.isoformat()).select("ingest_date").distinct().count(), 1, f"collections of {start} to {end}"
    )
    valid, rejected = _store(silver.forecast_hours(raw, source_id, zone), FORECAST, table, rejects, "report", "date")
    quality.require(valid, 12 * collections, f"{collections} collections")
    return Outcome(valid, rejected)


def clean_boundaries(spark: SparkSession, landed: str, table: str, rejects: str, source_id: str, expected: int = 5) -> Outcome:
    """The reference table of areas, as one file; fewer than expected is an error."""
    raw = landing.read_json(spark, landed, BOUNDARY_RAW)
    valid, rejected = _store(silver.boundaries(raw, source_id), BOUNDARY, table, rejects, "lenient", None)
    quality.require(valid, expected, "areas")
    return Outcome(valid, rejected)
