"""Cases of single operators."""

from __future__ import annotations

import datetime as dt
import gzip
import hashlib
import json
import math
import random

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from civicspark.functions import columns, wkt
from civicspark.operators import audit, geo, intervals, profile, quality, timeseries
from civicspark.plans import city, silver
from civicspark.sources import landing

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def snow(spark, values, start=D(2026, 1, 10)):
    return spark.createDataFrame(
        [(start + dt.timedelta(days=i), v, -15.0 - i) for i, v in enumerate(values)], "day date, snow double, cold double"
    )


def segment(df, least=2.0, gap=0, by=()):
    return timeseries.segment_events(df, day="day", measure="snow", least=least, gap_days=gap, low="cold", by=by)


def test_archive_days(spark):
    raw = spark.createDataFrame(
        [
            ("2026-01-15", 4.0, -20.0, -8.0),
            ("2026-01-16", 900.0, -20.0, -8.0),
            ("not-a-date", 1.0, 0.0, 0.0),
            ("2026-01-17", None, -20.0, None),
        ],
        "time string, snowfall_sum double, temperature_2m_min double, temperature_2m_max double",
    )
    valid, rejected = quality.split(silver.archive_days(raw, "S"))
    assert "time" not in valid.columns
    assert rows(
        valid.select("date", "snowfall_sum_cm", "temperature_2m_min_c", "temperature_2m_max_c", "source_id")
    ) == [("2026-01-15", 4.0, -20.0, -8.0, "S"), ("2026-01-17", None, -20.0, None, "S")]
    assert rows(rejected.select("weather_date", "_reject_reason")) == [
        (None, "null_weather_date"), (D(2026, 1, 16), "snowfall_sum_cm_out_of_range")
    ]


def test_strict_dates(spark):
    df = spark.createDataFrame([("2026-02-30",), ("2026-1-5",), ("2026-01-05x",), (None,), ("2026-01-05",)], "t string")
    assert [r[0] for r in df.select(columns.strict_date(F.col("t"))).collect()] == [None, None, None, None, D(2026, 1, 5)]


def test_segments(spark):
    [event] = segment(snow(spark, [0.5, 3.0, 7.5, 2.0, 0.0])).collect()
    assert (
        event.event_id, event.start_date, event.end_date, event.duration_days, event.total, event.peak, event.low
    ) == ("SNOW-20260111", D(2026, 1, 11), D(2026, 1, 13), 3, 12.5, 7.5, -18.0)


@pytest.mark.parametrize(("gap", "events"), [(0, 2), (1, 1)])
def test_segments_bridge(spark, gap, events):
    found = segment(snow(spark, [3.0, 0.0, 4.0]), gap=gap).collect()
    assert len(found) == events
    assert sum(e.total for e in found) == 7.0
    if gap:
        assert found[0].duration_days == 3


def test_segments_edges(spark):
    assert [e.duration_days for e in segment(snow(spark, [5.0])).collect()] == [1]
    assert segment(snow(spark, [2.0])).count() == 1
    assert segment(snow(spark, [0.5])).count() == 0
    with pytest.raises(ValueError, match="least"):
        segment(snow(spark, [1.0]), least=-1.0)
    with pytest.raises(ValueError, match="gap_days"):
        segment(snow(spark, [1.0]), gap=-1)


def test_segments_across_years_whatever_the_order(spark):
    values = [random.Random(3).choice([0.0, 3.0]) for _ in range(900)]
    df = snow(spark, values, D(2024, 6, 1))
    for gap in (0, 2):
        found = segment(df, gap=gap)
        want, start = [], None
        days = [D(2024, 6, 1) + dt.timedelta(days=i) for i, v in enumerate(values) if v]
        for i, day in enumerate(days):
            start = start or day
            if i + 1 == len(days) or (days[i + 1] - day).days > gap + 1:
                want.append((start, day))
                start = None
        assert rows(found.select("start_date", "end_date")) == want
        assert rows(segment(df.orderBy(F.rand(1)).repartition(3), gap=gap)) == rows(found)


def test_newest(spark):
    df = spark.createDataFrame([("h", "2026-06-27", 20.0), ("h", "2026-06-28", 21.0)], "time string, ingest_date string, t double")
    assert rows(timeseries.newest(df, ["time"], [F.desc("ingest_date")])) == [("h", "2026-06-28", 21.0)]
    assert rows(timeseries.newest_by(df, ["time"], ["ingest_date"])) == [("h", "2026-06-28", 21.0)]


@pytest.mark.parametrize(("zone", "hour"), [("America/Winnipeg", "15:00"), ("America/New_York", "14:00")])
def test_wall_clock(spark, zone, hour):
    df = spark.createDataFrame([("2026-06-28T10:00:00",), ("bad",)], "t string").select(
        F.date_format(columns.wall_clock_to_utc(F.col("t"), zone), "HH:mm")
    )
    assert [r[0] for r in df.collect()] == [hour, None]


def test_clock_changes(spark):
    df = spark.createDataFrame([("2026-11-01T01:30",), ("2026-03-08T02:30",)], "t string").select(
        F.date_format(columns.wall_clock_to_utc(F.col("t"), "America/Winnipeg"), "HH:mm")
    )
    assert [r[0] for r in df.collect()] == ["06:30", "08:30"]


def test_forecast_reasons(spark):
    raw = spark.createDataFrame(
        [("2026-06-28T10:00", "2026-06-28", 20.0, None), ("2026-06-28T11:00", "2026-06-28", 999.0, -1.0), (None, "2026-06-28", 20.0, 0.0)],
        "time string, ingest_date string, temperature_2m double, precipitation double",
    )
    valid, rejected = quality.split(silver.forecast_hours(raw, "S", "America/Winnipeg"))
    assert valid.count() == 1
    assert {r._reject_reason for r in rejected.collect()} == {"temperature_2m_out_of_range", "null_time_utc"}


SCHEMA = StructType([StructField("a", IntegerType()), StructField("b", StringType())])


def test_enforce_schema(spark):
    df = spark.createDataFrame([("x", 1, 2)], "b string, a long, c long")
    assert quality.enforce_schema(df.drop("c"), SCHEMA).dtypes == [("a", "int"), ("b", "string")]
    assert quality.enforce_schema(df, SCHEMA, "lenient").columns == ["a", "b"]
    with pytest.raises(ValueError, match="unexpected"):
        quality.enforce_schema(df, SCHEMA)
    with pytest.raises(ValueError, match="missing"):
        quality.enforce_schema(df.drop("b"), SCHEMA)
    with pytest.raises(ValueError, match=r"missing=\['b'\] unexpected=\['c'\]"):
        quality.enforce_schema(df.drop("b"), SCHEMA, "report")
    with pytest.raises(ValueError, match="missing"):
        quality.enforce_schema(df.drop("a"), SCHEMA, "lenient")


def test_gates(spark):
    df = spark.createDataFrame([("2026-01-01",)] * 12, "c string")
    assert quality.require_window(df, 13) == 12
    assert quality.require_collections(df, "c") == 12
    with pytest.raises(quality.TooFewRows):
        quality.require_window(df, 15)
    with pytest.raises(quality.TooFewRows):
        quality.require_collections(df.limit(11), "c")
    with pytest.raises(quality.TooFewRows):
        quality.require_collections(df.limit(0), "c")


SQUARE = [[[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.5], [0.0, 0.0]]]]


def test_boundaries(spark):
    kind = "borocode string, boroname string, shape_area string, shape_leng string, the_geom struct<type:string,coordinates:array<array<array<array<double>>>>>"
    df = spark.createDataFrame(
        [
            ("1", "n", "636631537.285", "1", ("MultiPolygon", SQUARE)),
            ("99", "n", "x", "1", ("MultiPolygon", SQUARE)),
            ("2", "n", "1", "1", None),
            ("3", "n", "1", "1", ("MultiPolygon", [[SQUARE[0][0][:3]]])),
        ],
        kind,
    )
    found = silver.boundaries(df, "S")
    assert [r._reject_reason for r in found.collect()] == [None, "invalid_borough_id", "null_geometry", "open_ring"]
    first = found.first()
    assert (first.borough_id, first.shape_area_sqft, first.geometry_wkt) == (
        1, 636631537.285, "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4.5, 0 0)))"
    )


def test_wkt_with_hole(spark):
    df = spark.createDataFrame([([[SQUARE[0][0], SQUARE[0][0]], SQUARE[0]],), (None,)], "c array<array<array<array<double>>>>")
    text = [r[0] for r in df.select(wkt.multipolygon(F.col("c"))).collect()]
    ring = "(0 0, 4 0, 4 4, 0 4.5, 0 0)"
    assert text == [f"MULTIPOLYGON (({ring}, {ring}), ({ring}))", None]


def manifests(spark, counts):
    return spark.createDataFrame(
        [("d", str(i), c) for i, c in enumerate(counts)], "dataset string, partition_key string, record_count long"
    )


def test_coverage(spark):
    assert [
        r.anomaly_low for r in audit.coverage(manifests(spark, [500, 500, 50]), by=["dataset"]).orderBy("partition_key").collect()
    ] == [False, False, True]
    found = audit.coverage_summary(manifests(spark, [1000, 0, 10])).first()
    assert (found.total_records, found.gaps) == (1010, 1)
    none = audit.coverage_summary(manifests(spark, [])).first()
    assert (none.total_records, none.partition_count, none.gaps, none.anomaly_low) == (0, 0, 0, 0)


def test_profiles(spark):
    df = spark.createDataFrame(
        [("A", "2026-01-01T00:00:00", "brooklyn", "2"), (None, "1970-01-01T00:00:00", "R1", "0"), ("B", None, "Unspecified", None)],
        "agency string, t string, region string, n string",
    )
    rates = {r.field: r.null_rate for r in profile.null_rates(df).collect()}
    assert rates == {"agency": 0.3333, "t": 0.3333, "region": 0.0, "n": 0.3333}
    stamp = profile.timestamps(df, "t").first()
    assert (stamp.missing_pct, stamp.epoch_zero_count, stamp.far_future_count, stamp.min_ts) == (0.3333, 1, 0, "1970-01-01T00:00:00")
    assert {r.value for r in profile.categories(df, "region", ["brooklyn"]).where("dirty").collect()} == {"R1"}
    number = profile.numerics(df, ["n"]).first()
    assert (number.missing_pct, number.min, number.max) == (0.3333, 0.0, 2.0)


def test_profile_of_zero_and_false(spark):
    df = spark.createDataFrame([(0, False, ""), (1, True, "x")], "a int, b boolean, c string")
    assert {r.null_rate for r in profile.null_rates(df).collect()} == {0.5}


def test_tolerant_read(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\nnot json\n\n{"a": 2, "b": "y"}\n')
    good, bad = landing.read_tolerant(spark, str(tmp_path), SCHEMA)
    assert rows(good) == [(1, None), (2, "y")]
    assert [r[0] for r in bad.collect()] == ["not json"]


def test_flatten(spark):
    df = spark.createDataFrame(
        [(1, (["t1", "t2", "t3"], [5.0])), (2, ([], [])), (3, None)], "id int, hourly struct<time:array<string>,x:array<double>>"
    )
    assert rows(landing.flatten_series(df, ["id"], ["hourly"], ["x"])) == [(1, "t1", 5.0), (1, "t2", None), (1, "t3", None)]
    held = spark.createDataFrame([(1, (["t1", "t2", "t3"], [5.0, None])), (2, (["t1"], None))], df.schema)
    assert rows(landing.flatten_series(held, ["id"], ["hourly"], ["x"], pad=False)) == [
        (1, "t1", 5.0, True), (1, "t2", None, True), (1, "t3", None, False), (2, "t1", None, False)
    ]


@pytest.mark.parametrize(("n", "want"), [(2, ["a", "b"]), (7, ["a", "c", "e"]), (3, ["a", "b", "c"])])
def test_sample_names(spark, n, want):
    df = spark.createDataFrame([(chr(97 + i),) for i in range(n)] * 2, "name string")
    assert [r[0] for r in rows(landing.sample_names(df, "name"))] == want


def test_daily_landing_drops_unreadable(spark, tmp_path):
    df = spark.createDataFrame([("2026-01-31T10:00:00", 1), ("2026-02-01T10:00:00", 2), ("bad", 3), (None, 4)], "ts string, n int")
    landing.write_daily(df, str(tmp_path / "d"), "ts")
    found = landing.read_days(spark, str(tmp_path / "d"), df.schema, D(2026, 1, 1), D(2026, 3, 1), absent="skip")
    assert rows(found.select("month", "date", "n")) == [("2026-01", "2026-01-31", 1), ("2026-02", "2026-02-01", 2)]
    assert any(p.suffix == ".gz" for p in (tmp_path / "d").rglob("part-*"))


def test_days_that_are_absent_fail(spark, tmp_path):
    df = spark.createDataFrame([("2026-01-31T10:00:00", 1), ("2026-02-01T10:00:00", 2)], "ts string, n int")
    landing.write_daily(df, str(tmp_path / "d"), "ts")
    read = lambda a, z: landing.read_days(spark, str(tmp_path / "d"), df.schema, a, z)
    assert rows(
        read(D(2026, 1, 31), D(2026, 2, 2)).select("month", "date", "n")
    ) == [("2026-01", "2026-01-31", 1), ("2026-02", "2026-02-01", 2)]
    assert read(D(2026, 2, 1), D(2026, 2, 1)).count() == 0
    with pytest.raises(AnalysisException):
        read(D(2026, 1, 31), D(2026, 2, 3))


def test_daily_landing_keeps_the_order(spark, tmp_path):
    df = spark.range(5000).repartition(3).withColumn("ts", F.lit("2026-01-31T10:00:00")).cache()
    came = [r.id for r in df.collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if the day were large
    try:
        landing.write_daily(df, str(tmp_path / "d"), "ts")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "d").rglob("part-*.gz"))
    got = [json.loads(line)["id"] for f in files for line in gzip.open(f, "rt")]
    assert len(files) > 1  # one day isn't one task
    assert got == came


def test_file_manifests(spark, tmp_path):
    df = spark.range(500).selectExpr("id", "date_format(date_add(date'2026-01-30', cast(id % 3 as int)), 'yyyy-MM-dd') as ts")
    landing.write_daily(df, str(tmp_path / "d"), "ts")
    made = landing.file_manifests(
        spark, str(tmp_path / "d"), source_id="S", dataset_name="x", timestamp_field="ts", fetched=dt.datetime(2026, 2, 3)
    )
    for r in made.collect():
        file = tmp_path / "d" / f"month={r.month_partition}" / f"date={r.date_partition}" / r.filename
        payload = gzip.open(file).read()
        assert (r.record_count, r.file_size_bytes, r.stored_bytes) == (payload.count(b"\n"), len(payload), file.stat().st_size)
        assert r.sha256_checksum == hashlib.sha256(payload).hexdigest()
        assert (r.compression, r.month_partition) == ("gzip", r.date_partition[:7])
    assert sum(r.record_count for r in made.collect()) == 500
    whole = landing.manifest(df.withColumn("p", F.lit(1)), ["p"], ["id"]).first().line_checksum
    assert sum(r.line_checksum for r in made.collect()) == whole


def test_snapshot_floor(spark, tmp_path):
    path, df = str(tmp_path / "s"), spark.range(5)
    assert landing.write_snapshot(df, path, D(2026, 1, 1), min_records=5) == 5
    for few in (df.limit(4), df.limit(0)):
        with pytest.raises(quality.TooFewRows):
            landing.write_snapshot(few, path, D(2026, 1, 1), min_records=5)
    assert landing.read_snapshots(spark, path, df.schema).count() == 5


def test_collection_date(spark):
    df = spark.createDataFrame([("x/ingest_date=2026-06-28/data.ndjson.gz",)], "_source_file string")
    assert landing.collection_date(df).first().ingest_date == "2026-06-28"
    with pytest.raises(ValueError, match="no collection date"):
        landing.collection_date(spark.createDataFrame([("2026-06/data_2026-06-28.ndjson.gz",)], "_source_file string"))


def test_manifests_skip_broken(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/manifest.json").write_text('{\n "a": 1, "b": "x"}')
    (tmp_path / "manifest_2.json").write_text('{"a": ')
    (tmp_path / "data.json").write_text('{"a": 5}')
    assert rows(landing.read_manifests(spark, str(tmp_path), SCHEMA)) == [(1, "x")]


def test_manifest_checksum_ignores_order(spark):
    df = spark.range(50).withColumn("p", F.col("id") % 2)
    assert rows(landing.manifest(df, ["p"], ["id"])) == rows(landing.manifest(df.orderBy(F.desc("id")).repartition(3), ["p"], ["id"]))


def test_rejects_of_an_earlier_run_go(spark, tmp_path):
    path, df = str(tmp_path / "r"), spark.range(3)
    assert landing.write_rejects(df, path)
    assert not landing.write_rejects(df.limit(0), path)
    assert not (tmp_path / "r").exists()


def test_point_on_other_side_of_hole(spark):
    hole = [[[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]], [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]]]
    zones = spark.createDataFrame([("z", [hole])], "zone string, coordinates array<array<array<array<double>>>>")
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 2.0, 5.0), (3, 11.0, 5.0), (4, None, 5.0)], "id int, x double, y double")
    assert rows(geo.points_in_polygons(points, zones, key="id", x="x", y="y")) == [(2, "z")]


def test_overlaps_once(spark):
    a = spark.createDataFrame([(1, D(2026, 1, 1), D(2026, 6, 1))], "k int, s date, e date")
    b = spark.createDataFrame(
        [
            (1, D(2026, 2, 1), D(2026, 5, 1)),
            (1, D(2026, 6, 1), D(2026, 6, 2)),
            (1, D(2026, 6, 2), D(2026, 6, 3)),
            (2, D(2026, 2, 1), D(2026, 2, 1)),
        ],
        "k int, s2 date, e2 date",
    )
    found = intervals.overlaps(a, b, on=["k"], left_span=("s", "e"), right_span=("s2", "e2"))
    assert rows(found.select("s2")) == [(D(2026, 2, 1),), (D(2026, 6, 1),)]


def test_supply_gap_is_null_before_the_series(spark):
    events = spark.createDataFrame(
        [("old", D(2010, 1, 1), D(2010, 1, 2)), ("new", D(2020, 1, 1), D(2020, 1, 2))], "event_id string, start_date date, end_date date"
    )
    zones = spark.createDataFrame([("a",), ("b",)], "zone string")
    shifts = spark.createDataFrame([("a", D(2020, 1, 2), D(2020, 1, 5))], "zone string, shift_start date, shift_end date")
    found = intervals.supply_gaps(events, zones, shifts, supply_start="2015-12-01")
    assert rows(found.select("event_id", "zone", "supply_gap")) == [
        ("new", "a", 0), ("new", "b", 1), ("old", "a", None), ("old", "b", None)
    ]


def test_request_types(spark):
    df = spark.createDataFrame(
        [
            ("Snow Removal High Piles Pr 2",),
            ("Snow Removal Request Sidewalk After Hours P1",),
            ("Frozen Catch Basin Priority 3 Reg",),
            ("Service_vof",),
        ],
        "type string",
    )
    found = {r.type: (r.priority, r["shift"], r.is_vof) for r in city.type_dictionary(df, "type").collect()}
    assert list(found.values()).count((None, None, True)) == 1
    assert set(found.values()) == {(2, None, False), (1, "After", False), (3, "Reg", False), (None, None, True)}


def test_keywords_leave_service_alone(spark):
    df = spark.createDataFrame([("Police Service",), ("Invoice Notice",), ("ice control sanding",), (None,)], "type string")
    assert [r.is_hit for r in city.keyword_flags(df, "type").collect()] == [False, False, True, False]


def test_seasonal_baseline_looks_back_only(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 20.0), ("a", 3, 60.0)], "area string, season int, v double")
    assert [
        r.baseline for r in city.seasonal_baseline(df, area="area", season="season", value="v").orderBy("season").collect()
    ] == [None, 10.0, 15.0]


def test_calendars(spark):
    assert timeseries.days(spark, D(2026, 1, 1), D(2026, 1, 1)).count() == 0
    assert timeseries.months(spark, D(2026, 1, 31), D(2026, 3, 1)).count() == 2
    assert landing.relative_window(D(2026, 1, 1), D(2026, 1, 20), D(2026, 1, 10)) == (9, 10)
    assert landing.relative_window(D(2026, 1, 10), D(2026, 1, 11), D(2026, 1, 10), ahead=7) == (0, 7)
    assert landing.relative_window(D(2026, 1, 1), D(2026, 1, 20), D(2026, 1, 10), past=3) == (3, 0)


def test_count_model_matches_a_plain_fit(spark):
    """The Poisson model's predictions are those of Newton's method on the same rows."""
    rng = np.random.default_rng(2)
    x = rng.uniform(0, 2, 200)
    data = [(float(a), int(n), i >= 150) for i, (a, n) in enumerate(zip(x, rng.poisson(np.exp(0.4 + 0.9 * x)), strict=True))]
    design = np.array([[1.0, a] for a, _, late in data if not late])
    counts, beta = np.array([n for _, n, late in data if not late], float), np.zeros(2)
    for _ in range(50):
        mean = np.exp(design @ beta)
        beta += np.linalg.solve(design.T @ (design * mean[:, None]), design.T @ (counts - mean))
    found = city.count_model(spark.createDataFrame(data, "x double, n int, late boolean"), ["x"], "n", F.col("late")).collect()
    assert len(found) == 50
    for r in found:
        assert abs(r.prediction - math.exp(beta[0] + beta[1] * r.x)) < 1e-3 * r.prediction


def test_latest_before_over_months(spark):
    rng = random.Random(9)
    day = lambda: D(2025, 1, 1) + dt.timedelta(days=rng.randrange(300))
    left = [(rng.choice(["a", "b", None]), i, day() if i else None) for i in range(120)]
    right = [(rng.choice(["a", "b", None]), day(), rng.randrange(9)) for _ in range(25)]
    found = intervals.latest_before(
        spark.createDataFrame(left, "k string, id int, at date"), spark.createDataFrame(right, "k string, seen date, v int"), on=["k"], left_time="at", right_time="seen", take=["seen", "v"]
    )
    want = [(k, i, at, *max([(s, v) for kk, s, v in right if kk == k and at and s <= at], default=(None, None))) for k, i, at in left]
    assert rows(found) == sorted(want, key=repr)
