"""Demand, supply, scores and recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import winter
from ..operators import geo, intervals, timeseries
from ..plans import city
from .common import Registry, six, table

registry = Registry()
query = registry.query


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity AS v, 1 AS version FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity + 1, 2 FROM lineitem WHERE l_orderkey % 4 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY version DESC, v DESC, l_returnflag DESC) AS n FROM r)
SELECT l_returnflag, count(*) AS rows, count(DISTINCT l_orderkey) AS cases, round(sum(v), 2) AS total FROM k WHERE n = 1 GROUP BY 1
""")
def composite_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").alias("v"))
    twice = rows.withColumn("version", F.lit(1)).unionByName(
        rows.where("l_orderkey % 4 = 0").withColumn("v", F.col("v") + 1).withColumn("version", F.lit(2))
    )
    out = timeseries.newest_by(twice, ["l_orderkey", "l_linenumber"], ["version", "v", "l_returnflag"])
    return out.groupBy("l_returnflag").agg(
        F.count("*").alias("rows"), F.count_distinct("l_orderkey").alias("cases"), F.round(F.sum("v"), 2).alias("total")
    )


@query(
    "SELECT l_shipyear, l_returnflag, contacts, cases FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS l_shipyear, l_returnflag, count(*) AS contacts, count(DISTINCT l_orderkey) AS cases FROM lineitem GROUP BY 1, 2)"
)
def contact_volumes(spark: SparkSession, d: str) -> DataFrame:
    return city.volumes(
        table(spark, d, "lineitem").withColumn("l_shipyear", F.year("l_shipdate")), "l_orderkey", ["l_shipyear", "l_returnflag"]
    )


@query(
    "SELECT CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'VOF' ELSE event_type END AS channel, count(*) AS n FROM events GROUP BY 1"
)
def channel_normalisation(spark: SparkSession, d: str) -> DataFrame:
    mapping = spark.createDataFrame([("view", "VOF"), ("click", "VOF"), ("signup", "VOF")], "raw string, value string")
    return city.normalise(table(spark, d, "events"), "event_type", mapping, "channel").groupBy("channel").agg(F.count("*").alias("n"))


_TYPE = "CASE o_orderkey % 4 WHEN 0 THEN 'Snow Removal Priority ' || p || ' Reg' WHEN 1 THEN 'Sanding Pr ' || p || ' After' WHEN 2 THEN 'Frozen Request After Hours P' || p ELSE 'Notice of Service_vof' END"


def _typed(spark: SparkSession, d: str) -> DataFrame:
    k, p = F.col("o_orderkey") % 4, F.substring("o_orderpriority", 1, 1)
    kind = F.when(
        k == 0, F.concat(F.lit("Snow Removal Priority "), p, F.lit(" Reg"))
    ).when(k == 1, F.concat(
        F.lit("Sanding Pr "), p, F.lit(" After")
    )).when(k == 2, F.concat(F.lit("Frozen Request After Hours P"), p)).otherwise("Notice of Service_vof")
    return table(spark, d, "orders").withColumn("type", kind)


@query(f"""
WITH t AS (SELECT DISTINCT {_TYPE} AS type FROM (SELECT *, substr(o_orderpriority, 1, 1) AS p FROM orders))
SELECT type, CAST(nullif(regexp_extract(type, '(?:Priority |Pr |P)([1-9])', 1), '') AS INTEGER) AS priority, CASE WHEN type LIKE '%After%' THEN 'After' WHEN type LIKE '%Reg' THEN 'Reg' END AS shift, type LIKE '%!_vof' ESCAPE '!' AS is_vof FROM t
""")
def request_type_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return city.type_dictionary(_typed(spark, d), "type")


@query(f"""
WITH t AS (SELECT upper({_TYPE}) AS u FROM (SELECT *, substr(o_orderpriority, 1, 1) AS p FROM orders)), w AS (SELECT unnest(['SNOW', 'FROZEN', 'PLOW', 'PLOUGH', 'SANDING', 'WINDROW', 'ICE CONTROL']) AS word)
SELECT word, count(*) AS n FROM t JOIN w ON contains(u, word) GROUP BY word UNION ALL SELECT 'ANY', count(*) FILTER (regexp_matches(u, 'SNOW|FROZEN|PLOW|PLOUGH|SANDING|WINDROW|ICE CONTROL')) FROM t
""")
def winter_keywords(spark: SparkSession, d: str) -> DataFrame:
    return city.keyword_report(city.keyword_flags(_typed(spark, d), "type"))


@query(
    "SELECT label, count(*) AS n, count(*) FILTER (vec_id % 5 <> 0) AS n_geo, round(avg(CASE WHEN vec_id % 5 <> 0 THEN 1.0 ELSE 0 END), 6) AS geo_share FROM embeddings GROUP BY label"
)
def geo_availability(spark: SparkSession, d: str) -> DataFrame:
    return city.geo_share(_points(spark, d), ["label"], "x", "y")


def _points(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a place, from the first two members of their vector; every fifth has none."""
    at = lambda i: F.when(F.col("vec_id") % 5 != 0, F.col("embedding")[i].cast("double"))
    return table(spark, d, "embeddings").select("vec_id", "label", at(0).alias("x"), at(1).alias("y"))


def _zones(spark: SparkSession, d: str) -> DataFrame:
    """A triangle around the place of each nation's and region's key on a lattice: zones of one polygon or two."""
    n = table(spark, d, "nation")
    x, y = (F.col("n_nationkey") % 5) * 0.1 - 0.25, F.floor(F.col("n_nationkey") / 5) * 0.1 - 0.25
    ring = F.array(F.array(x, y), F.array(x + 0.11, y), F.array(x, y + 0.13), F.array(x, y))
    second = F.array(F.array(x + 0.05, y + 0.05), F.array(x + 0.1, y + 0.05), F.array(x + 0.1, y + 0.1), F.array(x + 0.05, y + 0.05))
    return n.select(
        F.col("n_nationkey").alias("zone"),
        F.when(
            F.col("n_nationkey") % 2 == 0, F.array(F.array(ring), F.array(second))
        ).otherwise(F.array(F.array(ring))).alias("coordinates"),
    )


_PLACED = """
WITH p AS (SELECT vec_id, label, CASE WHEN vec_id % 5 <> 0 THEN CAST(embedding[1] AS DOUBLE) END AS x, CASE WHEN vec_id % 5 <> 0 THEN CAST(embedding[2] AS DOUBLE) END AS y FROM embeddings),
o AS (SELECT n_nationkey AS zone, (n_nationkey % 5) * CAST(0.1 AS DOUBLE) - CAST(0.25 AS DOUBLE) AS a, floor(n_nationkey / 5) * CAST(0.1 AS DOUBLE) - CAST(0.25 AS DOUBLE) AS b FROM nation),
v AS (SELECT zone, 0 AS polygon, [a, a + CAST(0.11 AS DOUBLE), a, a] AS xs, [b, b, b + CAST(0.13 AS DOUBLE), b] AS ys FROM o UNION ALL
  SELECT zone, 1, [a + CAST(0.05 AS DOUBLE), a + CAST(0.1 AS DOUBLE), a + CAST(0.1 AS DOUBLE), a + CAST(0.05 AS DOUBLE)], [b + CAST(0.05 AS DOUBLE), b + CAST(0.05 AS DOUBLE), b + CAST(0.1 AS DOUBLE), b + CAST(0.05 AS DOUBLE)] FROM o WHERE zone % 2 = 0),
e AS (SELECT zone, polygon, xs[i] AS x1, ys[i] AS y1, xs[i + 1] AS x2, ys[i + 1] AS y2 FROM v, (SELECT unnest([1, 2, 3]) AS i)),
h AS (SELECT vec_id, zone, polygon FROM p, e WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1),
f AS (SELECT vec_id, min(zone) AS zone FROM h GROUP BY vec_id)
"""


def _found(spark: SparkSession, d: str) -> DataFrame:
    return geo.points_in_polygons(_points(spark, d), _zones(spark, d), key="vec_id", x="x", y="y")


@query(_PLACED + "SELECT vec_id, zone FROM f")
def points_in_zones(spark: SparkSession, d: str) -> DataFrame:
    return _found(spark, d)


@query(
    _PLACED
    + "SELECT p.label, p.vec_id, coalesce(f.zone, CASE WHEN p.label < 5 THEN CAST(p.label AS BIGINT) END) AS zone, CASE WHEN f.zone IS NOT NULL THEN 'place' WHEN p.label < 5 THEN 'label' END AS zone_source FROM p LEFT JOIN f USING (vec_id)"
)
def zone_assignment(spark: SparkSession, d: str) -> DataFrame:
    points = _points(spark, d)
    labels = points.where("label < 5").select("label", F.col("label").cast("long").alias("zone")).distinct()
    return geo.assign_zones(points.select("label", "vec_id"), _found(spark, d), labels, key="vec_id", label="label")


@query(
    _PLACED
    + "SELECT label, zone, n, round(n / sum(n) OVER (PARTITION BY label), 6) AS share FROM (SELECT p.label, f.zone, count(*) AS n FROM p JOIN f USING (vec_id) GROUP BY ALL)"
)
def zone_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    placed = _points(spark, d).join(_found(spark, d), "vec_id")
    return geo.crosswalk(placed, zone="zone", label="label").withColumn("share", six(F.col("share")))


@query(
    "SELECT n_name, r_name, count(*) AS requests, CAST(sum(CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 3 WHEN '2' THEN 2 WHEN '3' THEN 1 ELSE 0 END) AS BIGINT) AS weighted FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2"
)
def weighted_demand(spark: SparkSession, d: str) -> DataFrame:
    rows = _by_area(spark, d).withColumn("priority", F.substring("o_orderpriority", 1, 1).cast("int"))
    return city.weighted_volume(rows, ["n_name", "r_name"], "priority")


def _by_area(spark: SparkSession, d: str) -> DataFrame:
    orders, customers, nations, regions = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    ).join(regions, F.col("n_regionkey") == F.col("r_regionkey"))


@query(
    "SELECT l_suppkey, count(DISTINCT l_partkey % 22) AS zones_covered, round(count(DISTINCT l_partkey % 22) / 22.0, 6) AS coverage, round(sum(date_diff('second', o_orderdate, l_shipdate)) / 3600.0, 4) AS hours, strftime(max(l_shipdate), '%Y-%m-%d') AS completed FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"
)
def shift_coverage(spark: SparkSession, d: str) -> DataFrame:
    shifts = table(spark, d, "lineitem").join(
        table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).withColumn("zone", F.col("l_partkey") % 22)
    return city.shift_report(
        shifts, "l_suppkey", "zone", "o_orderdate", "l_shipdate", 22
    ).withColumn("completed", F.date_format("completed", "yyyy-MM-dd"))


@query("""
WITH p AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts AS seen_at, value AS peak FROM events WHERE event_type = 'view')
SELECT p.user_id, p.event_id, strftime(v.seen_at, '%Y-%m-%d %H:%M:%S') AS seen_at, v.peak, CAST(date_diff('second', date_trunc('second', v.seen_at), date_trunc('second', p.ts)) AS BIGINT) AS lag_seconds FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.seen_at
""")
def decision_lag(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    decided = e.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    peaks = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("seen_at"), F.col("value").alias("peak"))
    out = intervals.latest_before(decided, peaks, on=["user_id"], left_time="ts", right_time="seen_at", take=["seen_at", "peak"])
    lag = F.unix_timestamp(F.date_trunc("second", "ts").cast("timestamp")) - F.unix_timestamp(
        F.date_trunc("second", "seen_at").cast("timestamp")
    )
    return out.select(
        "user_id", "event_id", F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss").alias("seen_at"), "peak", lag.alias("lag_seconds")
    )


@query("""
WITH s AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey <> 0)
SELECT o_orderpriority, count(*) AS declared, count(s.k) AS with_execution, count(*) - count(s.k) AS without_execution FROM orders LEFT JOIN s ON s.k = o_orderkey GROUP BY 1
""")
def declared_and_done(spark: SparkSession, d: str) -> DataFrame:
    return city.declared_and_done(
        table(spark, d, "orders"), table(spark, d, "lineitem"), key="o_orderkey", done_key="l_orderkey", kind="o_orderpriority"
    )


@query(
    "WITH s AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000) SELECT n_nationkey, n_name, s.k IS NOT NULL AS has_schedule FROM nation LEFT JOIN s ON s.k = n_nationkey"
)
def unscheduled_zones(spark: SparkSession, d: str) -> DataFrame:
    schedule = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"))
    return city.scheduled(
        table(spark, d, "nation").select("n_nationkey", "n_name"), schedule, "n_nationkey"
    ).select("n_nationkey", "n_name", "has_schedule")


_SURGES = """
WITH s AS (SELECT o_orderpriority AS g, CAST(o_orderdate AS DATE) AS day, count(*) AS m FROM orders GROUP BY 1, 2), q AS (SELECT * FROM s WHERE m >= 4),
f AS (SELECT *, CASE WHEN lag(day) OVER w IS NULL OR date_diff('day', lag(day) OVER w, day) > 3 THEN 1 ELSE 0 END AS b FROM q WINDOW w AS (PARTITION BY g ORDER BY day)), i AS (SELECT *, sum(b) OVER (PARTITION BY g ORDER BY day ROWS UNBOUNDED PRECEDING) AS k FROM f),
ev AS (SELECT 'E-' || strftime(min(day), '%Y%m%d') || '-' || g AS event_id, min(day) AS start_date, max(day) AS end_date, CAST(sum(m) AS DOUBLE) AS total FROM i GROUP BY g, k),
sh AS (SELECT s_nationkey AS zone, CAST(l_shipdate AS DATE) AS shift_start, CAST(l_shipdate AS DATE) + 2 AS shift_end FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
gap AS (SELECT ev.event_id, n.n_nationkey AS zone, ev.start_date, ev.end_date, ev.total,
  CAST(CASE WHEN ev.start_date >= DATE '1996-01-01' THEN CASE WHEN EXISTS (SELECT 1 FROM sh WHERE sh.zone = n.n_nationkey AND sh.shift_start <= ev.end_date AND ev.start_date <= sh.shift_end) THEN 0 ELSE 1 END END AS INTEGER) AS supply_gap FROM ev, nation n)
"""


def _surges(spark: SparkSession, d: str) -> DataFrame:
    days = table(spark, d, "orders").groupBy(
        "o_orderpriority", F.to_date("o_orderdate").alias("day")
    ).agg(F.count("*").cast("double").alias("n"))
    found = timeseries.segment_events(days, day="day", measure="n", least=4.0, gap_days=2, by=["o_orderpriority"], prefix="E")
    return found.select(F.concat_ws("-", "event_id", "o_orderpriority").alias("event_id"), "start_date", "end_date", "total")


def _gaps(spark: SparkSession, d: str) -> DataFrame:
    shifts = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    shifts = shifts.select(
        F.col("s_nationkey").alias("zone"),
        F.to_date("l_shipdate").alias("shift_start"),
        F.date_add(F.to_date("l_shipdate"), 2).alias("shift_end"),
    )
    zones = table(spark, d, "nation").select(F.col("n_nationkey").alias("zone"))
    return intervals.supply_gaps(_surges(spark, d), zones, shifts, supply_start="1996-01-01")


@query(_SURGES + "SELECT event_id, zone, start_date, end_date, supply_gap FROM gap")
def supply_gap(spark: SparkSession, d: str) -> DataFrame:
    return _gaps(spark, d)


_SEVERITY = """
WITH x AS (SELECT event_type, CAST(ts AS DATE) AS day, round(avg(value), 6) AS snow, -max(value) / 10 AS cold FROM events GROUP BY 1, 2), e AS (SELECT min(snow) AS s0, max(snow) AS s1, min(cold) AS c0, max(cold) AS c1 FROM x)
SELECT event_type, day, snow, cold <= -25 AS is_cold_day, round(0.5 * (snow - s0) / (s1 - s0) + 0.5 * (1 - (cold - c0) / (c1 - c0)), 6) AS severity FROM x, e
"""


@query(_SEVERITY)
def weather_severity(spark: SparkSession, d: str) -> DataFrame:
    days = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        six(F.avg("value")).alias("snow"), (-F.max("value") / 10).alias("cold")
    )
    return city.severity(days, "snow", "cold").select("event_type", "day", "snow", "is_cold_day", six(F.col("severity")).alias("severity"))


_DOSE = "WITH x AS (SELECT event_type, CAST(ts AS DATE) AS day, round(avg(value), 6) AS dose, CAST(count(*) AS DOUBLE) AS n, max(value) >= 200 AS declared FROM events GROUP BY 1, 2)"


def _doses(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        six(F.avg("value")).alias("dose"), F.count("*").cast("double").alias("n"), (F.max("value") >= 200).alias("declared")
    )


@query(
    _DOSE
    + "SELECT CAST(floor(dose / 5) AS BIGINT) AS bucket, count(*) AS days, round(avg(n), 6) AS mean_response, CAST(median(n) AS DOUBLE) AS median_response FROM x GROUP BY 1"
)
def dose_response(spark: SparkSession, d: str) -> DataFrame:
    return city.dose_response(_doses(spark, d), "dose", "n", 5.0)


@query(
    _DOSE
    + "SELECT min(b) * 5.0::DOUBLE AS threshold FROM (SELECT CAST(floor(dose / 5) AS BIGINT) AS b, avg(CASE WHEN declared THEN 1.0 ELSE 0 END) AS r FROM x GROUP BY 1) WHERE r >= 0.5"
)
def declaration_threshold(spark: SparkSession, d: str) -> DataFrame:
    return city.empirical_threshold(_doses(spark, d), "dose", "declared", 5.0)


_DAYS = "x AS (SELECT o_orderpriority, n_name, date_diff('day', CAST(o_orderdate AS DATE), CAST(done AS DATE)) AS n FROM (SELECT o.*, (SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey) AS done FROM orders o) JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE done IS NOT NULL)"


def _closed(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("done"))
    return _by_area(spark, d).join(done, "o_orderkey", "left")


@query(
    f"WITH {_DAYS} SELECT o_orderpriority, count(*) AS n, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS p50, CAST(quantile_cont(n, 0.9) AS DOUBLE) AS p90 FROM x GROUP BY 1"
)
def response_durations(spark: SparkSession, d: str) -> DataFrame:
    return city.durations(_closed(spark, d), ["o_orderpriority"], "o_orderdate", "done")


@query(
    f"WITH {_DAYS}, m AS (SELECT n_name, CAST(median(n) AS DOUBLE) AS p50 FROM x GROUP BY 1) SELECT count(*) AS areas, round(coalesce(stddev_samp(p50), 0), 6) AS stddev, min(p50) AS least, max(p50) AS most FROM m"
)
def response_dispersion(spark: SparkSession, d: str) -> DataFrame:
    return city.dispersion(city.durations(_closed(spark, d), ["n_name"], "o_orderdate", "done"), "p50")


@query("""
WITH h AS (SELECT n_regionkey, n_name, count(*) AS c FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), p AS (SELECT n_regionkey, round(sum(o_totalprice), 2) AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT h.n_regionkey, n_name, c, round(c / sum(c) OVER (PARTITION BY h.n_regionkey), 6) AS share, round(v * c / sum(c) OVER (PARTITION BY h.n_regionkey), 2) AS allocated FROM h JOIN p USING (n_regionkey)
""")
def area_allocation(spark: SparkSession, d: str) -> DataFrame:
    rows = _by_area(spark, d)
    history = rows.groupBy("n_regionkey", "n_name").agg(F.count("*").alias("c"))
    parents = rows.groupBy("n_regionkey").agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    out = city.allocate(parents, history, parent="n_regionkey", child="n_name", value="v", count="c")
    return out.select("n_regionkey", "n_name", "c", six(F.col("share")).alias("share"), F.round("allocated", 2).alias("allocated"))


_SCORE = _SURGES + """,
dm AS (SELECT c_nationkey AS zone, count(*) AS demand FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1), ad AS (SELECT c_nationkey AS zone, count(*) AS addresses FROM customer GROUP BY 1),
w AS (SELECT max(total) AS mx FROM ev), g AS (SELECT gap.event_id, gap.zone, supply_gap, demand / CAST(nullif(addresses, 0) AS DOUBLE) AS rate, total / mx AS weather FROM gap JOIN w ON true LEFT JOIN dm USING (zone) LEFT JOIN ad USING (zone)),
t AS (SELECT event_id, zone, 0.4::DOUBLE * coalesce(rate / max(rate) OVER (PARTITION BY event_id), 0) AS a, 0.3::DOUBLE * coalesce(supply_gap, 0) AS b, 0.3::DOUBLE * coalesce(weather, 0) AS c FROM g),
sc AS (SELECT event_id, zone, round(100 * (a + b + c), 6) AS score, CASE WHEN a >= b AND a >= c THEN 'demand' WHEN b >= c THEN 'gap' ELSE 'weather' END AS driver FROM t),
lv AS (SELECT *, CASE WHEN score >= 75 THEN 'CRITICAL' WHEN score >= 50 THEN 'HIGH' WHEN score >= 25 THEN 'MED' ELSE 'LOW' END AS level FROM sc)
"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    rows = _by_area(spark, d)
    demand = rows.groupBy(F.col("c_nationkey").alias("zone")).agg(F.count("*").alias("demand"))
    addresses = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("zone")).agg(F.count("*").alias("addresses"))
    surges = _surges(spark, d)
    weather = surges.crossJoin(F.broadcast(surges.agg(F.max("total").alias("mx")))).select(
        "event_id", (F.col("total") / F.col("mx")).alias("weather")
    )
    grid = _gaps(spark, d).join(weather, "event_id").join(demand, "zone", "left").join(addresses, "zone", "left")
    return city.load_score(grid, demand="demand", addresses="addresses", gap="supply_gap", weather="weather", event="event_id")


@query(_SCORE + "SELECT event_id, zone, score, driver, level FROM lv")
def load_score(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("event_id", "zone", "score", "driver", "level")


@query(_SCORE + """
SELECT event_id, zone, score, place, CASE WHEN level = 'HIGH' AND driver = 'gap' THEN 'send crews' WHEN level = 'HIGH' THEN 'stand by' WHEN level = 'MED' THEN 'watch' END AS recommendation
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY score DESC, zone) AS INTEGER) AS place FROM lv) WHERE place <= 3
""")
def recommendations(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(
        [("HIGH", "gap", "send crews"), ("HIGH", None, "stand by"), ("MED", None, "watch")], "level string, driver string, text string"
    )
    return city.recommend(
        _scored(spark, d), rules, event="event_id", zone="zone", top=3
    ).select("event_id", "zone", "score", "place", "recommendation")


_SEASONS = """
WITH s AS (SELECT n_name, CAST(CASE WHEN month(o_orderdate) >= 11 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INTEGER) AS winter, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE month(o_orderdate) >= 11 OR month(o_orderdate) <= 3 GROUP BY 1, 2), b AS (SELECT *, avg(n) OVER (PARTITION BY n_name ORDER BY winter RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS baseline FROM s)
"""


def _seasons(spark: SparkSession, d: str) -> DataFrame:
    rows = _by_area(spark, d).withColumn(
        "winter", winter(F.col("o_orderdate"))
    ).where("winter is not null").groupBy("n_name", "winter").agg(F.count("*").alias("n"))
    return city.seasonal_baseline(rows, area="n_name", season="winter", value="n")


@query(_SEASONS + "SELECT n_name, winter, n, round(baseline, 6) AS baseline FROM b")
def seasonal_baseline(spark: SparkSession, d: str) -> DataFrame:
    return _seasons(spark, d).withColumn("baseline", six(F.col("baseline")))


@query(
    _SEASONS
    + ", p AS (SELECT *, lag(n) OVER (PARTITION BY n_name ORDER BY winter) AS model FROM b) SELECT count(*) AS n, round(avg(abs(n - model)), 6) AS model_mae, round(avg(abs(n - baseline)), 6) AS baseline_mae FROM p WHERE model IS NOT NULL AND baseline IS NOT NULL"
)
def forecast_errors(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    rows = _seasons(spark, d).withColumn("model", F.lag("n").over(Window.partitionBy("n_name").orderBy("winter")))
    return city.errors(rows, "n", "model", "baseline")


@query(
    _SEASONS.replace("WITH ", "WITH RECURSIVE ", 1)
    + """, t AS (SELECT n, winter, baseline, ln(1 + baseline) AS x FROM b WHERE baseline IS NOT NULL), f AS (SELECT * FROM t WHERE winter < 1999),
it(k, b0, b1) AS (SELECT 0, ln(avg(n)), CAST(0 AS DOUBLE) FROM f UNION ALL
  SELECT k + 1, b0 + (s11 * g0 - s01 * g1) / (s00 * s11 - s01 * s01), b1 + (s00 * g1 - s01 * g0) / (s00 * s11 - s01 * s01)
  FROM (SELECT k, b0, b1, sum(m) AS s00, sum(m * x) AS s01, sum(m * x * x) AS s11, sum(n - m) AS g0, sum((n - m) * x) AS g1
        FROM (SELECT it.k, it.b0, it.b1, f.n, f.x, exp(it.b0 + it.b1 * f.x) AS m FROM it, f WHERE it.k < 30) GROUP BY k, b0, b1)),
p AS (SELECT t.n, t.baseline, exp(it.b0 + it.b1 * t.x) AS model FROM t, it WHERE it.k = 30 AND t.winter >= 1999)
SELECT count(*) AS n, round(avg(abs(n - model)), 4) AS model_mae, round(avg(abs(n - baseline)), 4) AS baseline_mae FROM p"""
)
def poisson_forecast(spark: SparkSession, d: str) -> DataFrame:
    """A count model on the winters before 1999, beside the seasonal baseline on those after; SQL has Newton's steps."""
    rows = _seasons(spark, d).where("baseline is not null").withColumn("level", F.log1p("baseline"))
    predicted = city.count_model(rows, ["level"], "n", F.col("winter") >= 1999, penalty=0.0)
    found = city.errors(predicted, "n", "prediction", "baseline")
    return found.select("n", F.round("model_mae", 4).alias("model_mae"), F.round("baseline_mae", 4).alias("baseline_mae"))


@query("""
WITH s AS (SELECT c_custkey, d, CASE WHEN d = 0 THEN c_acctbal > 0 WHEN d = 1 THEN c_acctbal > 1000 ELSE c_acctbal > 1000 AND c_custkey % 10 <> 0 END AS has_street, CASE WHEN d = 2 AND c_custkey % 13 = 0 THEN NULL ELSE c_custkey % 2 = 0 END AS has_walk FROM customer, (SELECT unnest([0, 1, 2]) AS d)),
l AS (SELECT *, lag(has_street) OVER w AS s0, lag(has_walk) OVER w AS w0, lag(d) OVER w AS d0 FROM s WINDOW w AS (PARTITION BY c_custkey ORDER BY d))
SELECT c_custkey, CAST(d AS INTEGER) AS collected, 'has_street' AS flag, s0 AS old, has_street AS new FROM l WHERE d0 IS NOT NULL AND s0 IS DISTINCT FROM has_street UNION ALL
SELECT c_custkey, CAST(d AS INTEGER), 'has_walk', w0, has_walk FROM l WHERE d0 IS NOT NULL AND w0 IS DISTINCT FROM has_walk
""")
def snapshot_changes(spark: SparkSession, d: str) -> DataFrame:
    c, day = table(spark, d, "customer"), F.col("collected")
    rows = c.withColumn("collected", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    street = F.when(day == 0, F.col("c_acctbal") > 0).when(day == 1, F.col("c_acctbal") > 1000).otherwise(
        (F.col("c_acctbal") > 1000) & (F.col("c_custkey") % 10 != 0)
    )
    walk = F.when(~((day == 2) & (F.col("c_custkey") % 13 == 0)), F.col("c_custkey") % 2 == 0)
    rows = rows.select("c_custkey", "collected", street.alias("has_street"), walk.alias("has_walk"))
    return city.snapshot_changes(rows, key="c_custkey", collected="collected", flags=["has_street", "has_walk"])


@query(
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers, round(avg(CASE WHEN o_totalprice > 100000 THEN 1.0 ELSE 0 END), 6) AS filled_rate FROM orders GROUP BY 1, 2"
)
def yearly_distribution(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(
        F.count("*").alias("n"),
        F.count_distinct("o_custkey").alias("customers"),
        six(F.avg((F.col("o_totalprice") > 100000).cast("double"))).alias("filled_rate"),
    )
