"""Jobs end to end, and again."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from civicspark.operators.quality import TooFewRows
from civicspark.plans import jobs
from civicspark.sources import landing

D = dt.date
RAW = "time string, snowfall_sum double, temperature_2m_min double, temperature_2m_max double"


def test_archive_and_events(spark, tmp_path):
    landed, table, rejects, events = (str(tmp_path / n) for n in ("landed", "table", "rejects", "events"))
    snow = [0.0, 3.0, 4.0, 0.0, 900.0, 5.0, 0.0, 0.0, 0.0, 0.0]
    rows = [((D(2026, 1, 27) + dt.timedelta(days=i)).isoformat(), s, -20.0, -8.0) for i, s in enumerate(snow)]
    landing.write_daily(spark.createDataFrame(rows, RAW), landed, "time")
    window = D(2026, 1, 27), D(2026, 2, 6)
    for _ in range(2):
        assert jobs.clean_archive(spark, landed, table, rejects, *window, "S") == jobs.Outcome(9, 1)
        assert jobs.rebuild_events(spark, table, events, "S") == 2
    found = spark.read.parquet(events).orderBy("start_date").collect()
    assert [(r.event_id, r.duration_days, r.total_snowfall_cm) for r in found] == [("SNOW-20260128", 2, 7.0), ("SNOW-20260201", 1, 5.0)]
    assert spark.read.parquet(rejects).first()._reject_reason == "snowfall_sum_cm_out_of_range"
    with pytest.raises(AnalysisException):  # days that haven't landed
        jobs.clean_archive(spark, landed, table, rejects, D(2026, 1, 27), D(2026, 3, 1), "S")
    few, bad = str(tmp_path / "few"), [(day, s if i % 3 else -1.0, low, high) for i, (day, s, low, high) in enumerate(rows)]
    landing.write_daily(spark.createDataFrame(bad, RAW), few, "time")
    with pytest.raises(TooFewRows):
        jobs.clean_archive(spark, few, table, rejects, *window, "S")
    with pytest.raises(TooFewRows):
        jobs.rebuild_events(spark, table, events, "S", threshold_cm=100.0)


def test_forecast_keeps_newer_revisions(spark, tmp_path):
    landed, table, rejects = (str(tmp_path / n) for n in ("landed", "table", "rejects"))
    for day, shift in ((27, 0.0), (28, 1.0)):
        rows = [(f"2026-06-28T{h:02d}:00", 20.0 + shift, 0.0, 0.0, 5.0) for h in range(24)]
        landing.write_snapshot(
            spark.createDataFrame(rows, "time string, temperature_2m double, precipitation double, snowfall double, windspeed_10m double"),
            landed,
            D(2026, 6, day),
        )
    for end in (29, 28):  # a rerun of the older window doesn't lose the newer collection
        assert jobs.clean_forecast(
            spark, landed, table, rejects, D(2026, 6, 27), D(2026, 6, end), "S", "America/Winnipeg"
        ) == jobs.Outcome(24, 0)
        assert {r.temperature_2m for r in spark.read.parquet(table).collect()} == {21.0}
    with pytest.raises(TooFewRows):
        jobs.clean_forecast(spark, landed, table, rejects, D(2026, 7, 27), D(2026, 7, 29), "S", "America/Winnipeg")


def test_boundaries(spark, tmp_path):
    ring = [[[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]]]]
    rows = [(str(i), "n", "1.5", "2", ("MultiPolygon", ring)) for i in (1, 2, 3, 4, 5, 9)]
    landed, table, rejects = (str(tmp_path / n) for n in ("landed", "table", "rejects"))
    landing.write_static(spark.createDataFrame(rows, jobs.BOUNDARY_RAW), landed)
    assert jobs.clean_boundaries(spark, landed, table, rejects, "S") == jobs.Outcome(5, 1)
    assert len([p for p in (tmp_path / "table").iterdir() if p.suffix == ".parquet"]) == 1
    with pytest.raises(TooFewRows):
        jobs.clean_boundaries(spark, landed, table, rejects, "S", expected=6)


def test_merged_days_stay_out_of_the_driver(spark, tmp_path, monkeypatch):
    """Without a checkpoint folder too, the rows of touched days are written, not collected."""
    from civicspark.streaming import incremental

    def collected(self):
        raise AssertionError("rows pass through the driver")

    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(type(spark.range(1)), "toArrow", collected)
    landed, table, state = (f"{tmp_path}/{x}" for x in ("landed", "table", "state"))
    for version, keys in ((1, [1, 2]), (2, [2, 3])):
        rows = spark.createDataFrame([(k, version, "2024-01-01") for k in keys], "k int, version int, date string")
        rows.write.mode("append").parquet(landed)
        incremental.clean_new_files(
            spark, landed, rows.schema, lambda batch: batch, table, state, file_format="parquet", keys=["k"], version=["version"]
        )
    assert sorted((r.k, r.version) for r in spark.read.parquet(table).collect()) == [(1, 1), (2, 2), (3, 2)]
