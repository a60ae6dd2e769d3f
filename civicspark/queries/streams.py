"""Streaming jobs over files that have landed, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import partition_date
from ..session import scratch
from ..streaming import incremental, revisions
from .common import Registry, table

registry = Registry()
query = registry.query


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")


@query(
    "SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n, round(sum(value + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END), 4) AS total FROM events GROUP BY 1"
)
def stream_to_silver(spark: SparkSession, d: str) -> DataFrame:
    landed, clean, state = (scratch(spark, n) for n in ("landed", "clean", "state"))
    rows = _rows(spark, d).withColumn("version", F.lit(1))
    transform = lambda df: df.withColumn("date", partition_date(F.col("ts")))
    run = lambda: incremental.clean_new_files(
        spark, landed, rows.schema, transform, clean, state, file_format="parquet", keys=["event_id"], version=["version"]
    )
    rows.write.parquet(landed)
    run()
    rows.where("event_id % 5 = 0").withColumns({"value": F.col("value") + 1, "version": F.lit(2)}).write.mode("append").parquet(landed)
    run()  # takes the new files alone, and keeps the other rows of their days
    run()  # nothing new
    return spark.read.schema(transform(rows).schema).parquet(clean).groupBy("date").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query("SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events")
def stream_late_duplicates(spark: SparkSession, d: str) -> DataFrame:
    landed, out, state = (scratch(spark, n) for n in ("twice", "once", "seen"))
    rows = _rows(spark, d)
    rows.union(rows.where("event_id % 3 = 0")).write.parquet(landed)
    stream = spark.readStream.schema(rows.schema).parquet(landed)
    incremental.first_seen(stream, "ts", ["event_id"]).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", state
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(out).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("""
WITH e AS (SELECT event_id, date_trunc('second', ts) AS opened, value, date_trunc('second', ts) < TIMESTAMP '2024-01-16' AS early FROM events),
w AS (SELECT max(opened) FILTER (early) - INTERVAL 7 DAY AS first_end, max(opened) - INTERVAL 7 DAY AS last_end FROM e),
v AS (SELECT *, CASE WHEN early AND opened > first_end AND event_id % 5 = 0 THEN 4 WHEN early AND event_id % 3 = 0 THEN 3 ELSE 1 END AS version FROM e, w WHERE opened <= last_end)
SELECT event_id, CAST(version AS BIGINT) AS version, round(value + version, 4) AS value FROM v
""")
def stream_newest_revisions(spark: SparkSession, d: str) -> DataFrame:
    """Two landings with revisions out of order: what comes within a week of an event's time counts, its newest version wins."""
    landed, out, state = (scratch(spark, n) for n in ("revisions", "settled", "state"))
    events = table(spark, d, "events").select("event_id", F.date_trunc("second", "ts").cast("timestamp").alias("opened"), "value")
    early, late = events.where("opened < '2024-01-16'"), events.where("opened >= '2024-01-16'")
    of = lambda df, n: df.select("event_id", "opened", F.lit(n).cast("long").alias("version"), F.round(F.col("value") + n, 4).alias("value"))
    first = of(early, 1).union(of(early.where("event_id % 3 = 0"), 3))
    second = of(late, 1).union(of(early.where("event_id % 3 = 0"), 2)).union(of(early.where("event_id % 5 = 0"), 4))
    for landing in (first, second):
        landing.write.mode("append").parquet(landed)
        revisions.settle_revisions(
            spark, landed, first.schema, out, state, keys=["event_id"], opened="opened", version=["version"], file_format="parquet"
        )
    return spark.read.schema(first.schema).parquet(out).select("event_id", "version", "value")
