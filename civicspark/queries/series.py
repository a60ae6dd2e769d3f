"""Daily series, revisions, calendars and audits."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import in_lookback, in_window, partition_date, winter
from ..operators import audit, timeseries
from .common import Registry, iso, six, table

registry = Registry()
query = registry.query


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        six(F.avg("value")).alias("mean_value"), F.min("value").alias("least")
    )


_ISLANDS = """
WITH s AS ({series}), q AS (SELECT * FROM s WHERE m >= {least}),
f AS (SELECT *, CASE WHEN lag(day) OVER w IS NULL OR date_diff('day', lag(day) OVER w, day) > {gap} + 1 THEN 1 ELSE 0 END AS b FROM q WINDOW w AS (PARTITION BY g ORDER BY day)),
i AS (SELECT *, sum(b) OVER (PARTITION BY g ORDER BY day ROWS UNBOUNDED PRECEDING) AS k FROM f)
SELECT g AS {by}, 'SNOW-' || strftime(min(day), '%Y%m%d') AS event_id, min(day) AS start_date, max(day) AS end_date,
       CAST(date_diff('day', min(day), max(day)) + 1 AS INTEGER) AS duration_days, CAST(count(*) AS INTEGER) AS qualifying_days,
       round(sum(m), 4) AS total, max(m) AS peak{low} FROM i GROUP BY g, k
"""
_EVENT_SERIES = "SELECT event_type AS g, CAST(ts AS DATE) AS day, round(avg(value), 6) AS m, min(value) AS low FROM events GROUP BY 1, 2"
_ORDER_SERIES = "SELECT o_orderpriority AS g, CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS DOUBLE) AS m FROM orders GROUP BY 1, 2"


@query(_ISLANDS.format(series=_EVENT_SERIES, least=50.0, gap=0, by="event_type", low=", min(low) AS low"))
def event_segmentation(spark: SparkSession, d: str) -> DataFrame:
    out = timeseries.segment_events(_daily(spark, d), day="day", measure="mean_value", least=50.0, by=["event_type"], low="least")
    return out.withColumn("total", F.round("total", 4))


@query(_ISLANDS.format(series=_EVENT_SERIES, least=52.0, gap=2, by="event_type", low=", min(low) AS low"))
def event_segmentation_bridged(spark: SparkSession, d: str) -> DataFrame:
    out = timeseries.segment_events(
        _daily(spark, d), day="day", measure="mean_value", least=52.0, gap_days=2, by=["event_type"], low="least"
    )
    return out.withColumn("total", F.round("total", 4))


@query(_ISLANDS.format(series=_ORDER_SERIES, least=2.0, gap=1, by="o_orderpriority", low=""))
def order_surges(spark: SparkSession, d: str) -> DataFrame:
    days = table(spark, d, "orders").groupBy(
        "o_orderpriority", F.to_date("o_orderdate").alias("day")
    ).agg(F.count("*").cast("double").alias("n"))
    return timeseries.segment_events(
        days, day="day", measure="n", least=2.0, gap_days=1, by=["o_orderpriority"]
    ).withColumn("total", F.round("total", 4))


_NEWEST = """
SELECT user_id, strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, event_id, event_type, value FROM (
  SELECT *, date_trunc('hour', ts) AS hour, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
"""


@query(_NEWEST)
def newest_revision(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("hour", F.date_trunc("hour", "ts"))
    out = timeseries.newest(rows, ["user_id", "hour"], [F.desc("ts"), F.desc("event_id")])
    return out.select("user_id", iso(F.col("hour")).alias("hour"), "event_id", "event_type", "value")


@query(_NEWEST)
def newest_revision_by_aggregate(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("hour", F.date_trunc("hour", "ts"))
    out = timeseries.newest_by(rows, ["user_id", "hour"], ["ts", "event_id"])
    return out.select("user_id", iso(F.col("hour")).alias("hour"), "event_id", "event_type", "value")


@query("""
WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS version FROM orders),
b AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, 2 AS version FROM orders WHERE o_orderkey % 3 = 0 UNION ALL
      SELECT o_orderkey + 100000000, 'N', o_totalprice, 1 FROM orders WHERE o_orderkey % 7 = 0)
SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice, version FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS r FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) WHERE r = 1
""")
def late_upsert(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    old = orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(1).alias("version"))
    changed = orders.where("o_orderkey % 3 = 0").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit(2).alias("version")
    )
    added = orders.where("o_orderkey % 7 = 0").select(
        (F.col("o_orderkey") + 100000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice", F.lit(1).alias("version")
    )
    out = timeseries.upsert(old, changed.unionByName(added), ["o_orderkey"], ["version"])
    return out.withColumn("o_totalprice", F.round("o_totalprice", 2))


def _span(df: DataFrame, column: str) -> tuple[date, date]:
    """First and last day of a table: two values for the driver."""
    r = df.agg(F.to_date(F.min(column)).alias("a"), F.to_date(F.max(column)).alias("b")).first()
    return r["a"], r["b"]


@query("""
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders),
c AS (SELECT CAST(unnest(generate_series(a, z - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
SELECT c.day AS day, count(o.o_orderkey) AS orders FROM c LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = c.day GROUP BY c.day
""")
def calendar_days(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    counts = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    return timeseries.days(spark, *_span(orders, "o_orderdate")).join(counts, "day", "left").select(
        "day", F.coalesce("orders", F.lit(0)).cast("long").alias("orders")
    )


@query("""
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders),
c AS (SELECT CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', z - INTERVAL 1 DAY), INTERVAL 1 MONTH)) AS DATE) AS month FROM b)
SELECT c.month AS month, count(o.o_orderkey) AS orders FROM c LEFT JOIN orders o ON date_trunc('month', o.o_orderdate) = c.month GROUP BY c.month
""")
def calendar_months(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    counts = orders.groupBy(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")).agg(F.count("*").alias("orders"))
    return timeseries.months(spark, *_span(orders, "o_orderdate")).join(counts, "month", "left").select(
        "month", F.coalesce("orders", F.lit(0)).cast("long").alias("orders")
    )


@query("""
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders),
c AS (SELECT CAST(unnest(generate_series(a, z - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, day, CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter, CAST(month(day) AS INTEGER) AS month,
       CAST(day(day) AS INTEGER) AS day_of_month, CAST(isodow(day) AS INTEGER) AS iso_weekday, isodow(day) >= 6 AS is_weekend,
       CAST(CASE WHEN month(day) >= 11 THEN year(day) WHEN month(day) <= 3 THEN year(day) - 1 END AS INTEGER) AS winter FROM c
""")
def date_dimension(spark: SparkSession, d: str) -> DataFrame:
    return timeseries.date_dimension(spark, *_span(table(spark, d, "orders"), "o_orderdate"))


@query("""
WITH t AS (SELECT unnest(range(0, 1440)) AS m)
SELECT CAST(m AS INTEGER) AS time_key, CAST(m // 60 AS INTEGER) AS hour, CAST(m % 60 AS INTEGER) AS minute,
       CASE WHEN m < 360 THEN 'night' WHEN m < 720 THEN 'morning' WHEN m < 1080 THEN 'afternoon' ELSE 'evening' END AS part_of_day, count(e.event_id) AS events
FROM t LEFT JOIN events e ON hour(e.ts) * 60 + minute(e.ts) = t.m GROUP BY m
""")
def time_dimension(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "events").groupBy((F.hour("ts") * 60 + F.minute("ts")).alias("time_key")).agg(F.count("*").alias("events"))
    return timeseries.time_dimension(spark).join(counts, "time_key", "left").withColumn(
        "events", F.coalesce("events", F.lit(0)).cast("long")
    )


@query("""
SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events, (SELECT CAST(max(ts) AS DATE) AS z FROM events)
WHERE CAST(ts AS DATE) > z - 7 AND CAST(ts AS DATE) <= z GROUP BY ALL
""")
def trailing_lookback(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    last = _span(events, "ts")[1]
    return events.where(in_lookback(F.col("day"), F.lit(last))).groupBy("event_type", "day").agg(F.count("*").alias("n"))


@query(
    "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00' GROUP BY event_type"
)
def incremental_window(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    bounds = [F.lit(x).cast("timestamp_ntz") for x in ("2024-01-10 00:00:00", "2024-01-20 12:00:00")]
    return events.where(in_window(F.col("ts"), bounds[0], bounds[1])).groupBy("event_type").agg(F.count("*").alias("n"))



def _present(spark: SparkSession, d: str, column: str = "ts") -> tuple[DataFrame, DataFrame, date]:
    """Partitions of each dataset: the days on which a type had a value of 99 or more; and the day after the last."""
    events = table(spark, d, "events").select(F.col("event_type").alias("dataset"), F.to_date(column).alias("day"), "value")
    return events.select("dataset").distinct(), events.where("value >= 199").select("dataset", "day").distinct(), _span(events, "day")[1]


_AUDIT = """
WITH e AS (SELECT event_type AS dataset, CAST(ts AS DATE) AS day, value FROM events), t AS (SELECT max(day) AS today FROM e),
ds AS (SELECT DISTINCT dataset FROM e), p AS (SELECT DISTINCT dataset, day FROM e WHERE value >= 199),
x AS (SELECT dataset, CAST(unnest(generate_series(today - INTERVAL 14 DAY, today - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS missing FROM ds, t),
g AS (SELECT x.* FROM x ANTI JOIN p ON x.dataset = p.dataset AND x.missing = p.day)
"""


@query(_AUDIT + "SELECT dataset, missing, true AS recoverable FROM g")
def daily_gap_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.daily_gaps(*_present(spark, d))


@query(_AUDIT + "SELECT dataset, missing, false AS recoverable FROM g")
def snapshot_gap_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.daily_gaps(*_present(spark, d), recoverable=False)


@query("""
WITH o AS (SELECT o_orderpriority || '/' || o_orderstatus AS dataset, CAST(o_orderdate AS DATE) AS day, o_totalprice AS v FROM orders), t AS (SELECT max(day) AS today FROM o),
ds AS (SELECT DISTINCT dataset FROM o), p AS (SELECT DISTINCT dataset, date_trunc('month', day) AS m FROM o WHERE v >= 480000),
x AS (SELECT dataset, CAST(unnest(generate_series(date_trunc('month', today) - INTERVAL 3 MONTH, date_trunc('month', today) - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS missing FROM ds, t)
SELECT x.dataset, x.missing, true AS recoverable FROM x ANTI JOIN p ON x.dataset = p.dataset AND x.missing = p.m
""")
def monthly_gap_audit(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("dataset"), F.to_date("o_orderdate").alias("day"), "o_totalprice"
    )
    return audit.monthly_gaps(
        orders.select("dataset").distinct(), orders.where("o_totalprice >= 480000").select("dataset", "day"), _span(orders, "day")[1]
    )


@query(_AUDIT + "SELECT dataset, min(missing) AS fill_start, max(missing) + 1 AS fill_end FROM g GROUP BY dataset")
def gap_fill_ranges(spark: SparkSession, d: str) -> DataFrame:
    return audit.fill_ranges(audit.daily_gaps(*_present(spark, d)))


@query(_AUDIT + """, k AS (SELECT dataset, count(*) AS gaps, min(missing) AS first_gap, max(missing) AS last_gap FROM g GROUP BY dataset)
SELECT ds.dataset, a.audit, coalesce(k.gaps, 0) AS gaps, k.first_gap, k.last_gap,
       CASE WHEN coalesce(k.gaps, 0) = 0 THEN 'clean' WHEN ds.dataset = 'error' THEN 'fill failed' ELSE 'gap' END AS status
FROM ds CROSS JOIN (VALUES ('daily'), ('snapshot')) a(audit) LEFT JOIN k ON k.dataset = ds.dataset""")
def audit_report(spark: SparkSession, d: str) -> DataFrame:
    datasets, present, today = _present(spark, d)
    gaps = {"daily": audit.daily_gaps(datasets, present, today), "snapshot": audit.daily_gaps(datasets, present, today, recoverable=False)}
    return audit.report(datasets, gaps, datasets.where("dataset = 'error'")).withColumn("gaps", F.col("gaps").cast("long"))


@query("""
WITH m AS (SELECT event_type AS dataset, strftime(ts, '%Y-%m-%d') AS partition_key, CAST(sum(CASE WHEN value >= 150 THEN 1 ELSE 0 END) AS BIGINT) AS record_count FROM events GROUP BY 1, 2),
s AS (SELECT dataset, CAST(sum(record_count) AS BIGINT) AS total_records, count(*) AS partition_count, min(record_count) AS min_count, max(record_count) AS max_count, CAST(median(record_count) AS DOUBLE) AS median_count FROM m GROUP BY dataset)
SELECT m.*, s.* EXCLUDE (dataset), record_count = 0 AS gap, record_count > 0 AND record_count < 0.5 * median_count AS anomaly_low FROM m JOIN s USING (dataset)
""")
def coverage_map(spark: SparkSession, d: str) -> DataFrame:
    return audit.coverage(_manifests(spark, d), by=["dataset"])


def _manifests(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(
        F.col("event_type").alias("dataset"), partition_date(F.col("ts")).alias("partition_key")
    ).agg(F.count_if(F.col("value") >= 150).alias("record_count"))


@query("""
WITH m AS (SELECT CAST(sum(CASE WHEN value >= 150 THEN 1 ELSE 0 END) AS BIGINT) AS c FROM events GROUP BY event_type, CAST(ts AS DATE)), s AS (SELECT median(c) AS md FROM m)
SELECT CAST(sum(c) AS BIGINT) AS total_records, count(*) AS partition_count, min(c) AS min_count, max(c) AS max_count, CAST(any_value(md) AS DOUBLE) AS median_count,
       count(*) FILTER (c = 0) AS gaps, count(*) FILTER (c > 0 AND c < 0.5 * md) AS anomaly_low FROM m, s
""")
def coverage_summary(spark: SparkSession, d: str) -> DataFrame:
    return audit.coverage_summary(_manifests(spark, d))


@query("""
WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day, value FROM events), k AS (SELECT event_type, day, CAST(count(*) AS DOUBLE) AS expected FROM e GROUP BY ALL),
a AS (SELECT event_type, day, count(*) AS actual FROM e WHERE value >= 35 GROUP BY ALL)
SELECT k.event_type, k.day, k.expected, coalesce(a.actual, 0) AS actual, CASE WHEN coalesce(a.actual, 0) = 0 THEN 'no rows' ELSE 'low' END AS alert
FROM k LEFT JOIN a USING (event_type, day) WHERE coalesce(a.actual, 0) < 0.5 * k.expected
""")
def volume_alerts(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    expected = events.groupBy("event_type", "day").agg(F.count("*").cast("double").alias("expected"))
    actual = events.where("value >= 35").groupBy("event_type", "day").agg(F.count("*").alias("actual"))
    return audit.volume_alerts(expected, actual, ["event_type", "day"]).withColumn("actual", F.col("actual").cast("long"))


@query("""
WITH c AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL)
SELECT c.o_orderpriority, c.day, c.n, m.median, coalesce(c.n > 1.5 * m.median, false) AS is_anomaly
FROM c LEFT JOIN (SELECT a.o_orderpriority, a.day, CAST(median(b.n) AS DOUBLE) AS median FROM c a JOIN c b ON a.o_orderpriority = b.o_orderpriority AND b.day >= a.day - 30 AND b.day < a.day GROUP BY ALL) m
ON m.o_orderpriority = c.o_orderpriority AND m.day = c.day
""")
def load_anomalies(spark: SparkSession, d: str) -> DataFrame:
    from ..plans.city import load_anomalies as flag

    daily = table(spark, d, "orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return flag(timeseries.rolling_median(daily, day="day", value="n", by=["o_orderpriority"]), "n", "median")


@query("""
SELECT CAST(CASE WHEN month(o_orderdate) >= 11 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER) AS winter, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders WHERE month(o_orderdate) >= 11 OR month(o_orderdate) <= 3 GROUP BY 1
""")
def winter_seasons(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").withColumn("winter", winter(F.col("o_orderdate"))).where("winter is not null").groupBy("winter").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
