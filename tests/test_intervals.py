"""Intervals of any length, keys of records without a schema."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from civicspark.operators import intervals, profile
from civicspark.streaming import revisions


def test_overlaps_of_any_length(spark):
    """Against all pairs: single days, equal days, a century, dates long ago, reversed and null bounds, null keys."""
    rng = random.Random(3)
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)
    span = lambda n: (s := rng.randint(-400, 400), s + rng.choice([0, 0, 1, 2, 30, 90, -1]) + n)
    make = lambda: [(i, rng.choice(["a", "b", None]), *map(day, span(0))) for i in range(150)]
    left, right = make(), make()
    left += [(500, "a", dt.date(1900, 1, 1), dt.date(2010, 1, 1)), (501, "a", dt.date(1, 1, 1), dt.date(1, 1, 2)), (502, "a", None, day(1))]
    right += [(500, "a", dt.date(1, 1, 2), dt.date(9999, 12, 31)), (501, "b", day(3), None)]
    got = intervals.overlaps(
        spark.createDataFrame(left, "l long, k string, a date, b date"), spark.createDataFrame(right, "r long, k string, c date, d date"),
        on=["k"], left_span=("a", "b"), right_span=("c", "d"),
    )
    held = lambda rows: [x for x in rows if None not in x and x[2] <= x[3]]
    want = sorted((x[0], y[0]) for x in held(left) for y in held(right) if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
    assert sorted((r.l, r.r) for r in got.collect()) == want and got.columns[0] == "k"


def test_overlaps_within_a_day(spark):
    at = lambda h: dt.datetime(2020, 5, 1) + dt.timedelta(hours=h)
    left = spark.createDataFrame([(1, 1, at(1), at(5)), (2, 1, at(6), at(30))], "l int, k int, a timestamp, b timestamp")
    right = spark.createDataFrame([(1, 1, at(5), at(5.5)), (2, 1, at(31), at(40)), (3, 1, at(0), at(90))], "r int, k int, c timestamp, d timestamp")
    got = intervals.overlaps(left, right, on=["k"], left_span=("a", "b"), right_span=("c", "d"))
    assert sorted((r.l, r.r) for r in got.collect()) == [(1, 1), (1, 3), (2, 3)]
    none = intervals.overlaps(left.limit(0), right, on=["k"], left_span=("a", "b"), right_span=("c", "d"))
    assert none.collect() == []


def test_supply_gaps_deal_one_shift_a_start(spark, monkeypatch):
    """Against all pairs, with copies, shorter shifts of a start, null and reversed spans; only the longest meet events."""
    rng = random.Random(5)
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)
    events = [(f"e{i}", day(s := rng.randint(0, 300)), day(s + rng.choice([0, 1, 9]))) for i in range(40)] + [("none", None, day(3))]
    starts = [rng.randint(0, 300) for _ in range(12)]
    shifts = [(rng.choice(["a", "b"]), day(s := rng.choice(starts)), day(s + rng.choice([0, 2, 5, -3]))) for _ in range(300)]
    shifts += [("a", None, day(40)), ("a", day(41), None), (None, day(0), day(300)), ("c", day(9), day(2))] + [("b", day(50), day(52))] * 200
    dealt, plain = [], intervals.overlaps

    def counted(grid, rows, **more):
        dealt.append(rows.count())
        return plain(grid, rows, **more)

    monkeypatch.setattr(intervals, "overlaps", counted)
    found = intervals.supply_gaps(
        spark.createDataFrame(events, "event_id string, start_date date, end_date date"), spark.createDataFrame([("a",), ("b",), ("c",)], "zone string"),
        spark.createDataFrame(shifts, "zone string, shift_start date, shift_end date"), supply_start=day(20).isoformat(),
    )
    met = lambda z, s, e: any(None not in x and x[0] == z and x[1] <= x[2] and x[1] <= e and s <= x[2] for x in shifts)
    want = {(i, z): None if s is None or s < day(20) else int(not met(z, s, e)) for i, s, e in events for z in "abc"}
    rows = found.collect()
    assert len(rows) == len(want) and {(r.event_id, r.zone): r.supply_gap for r in rows} == want
    assert dealt == [len({x[:2] for x in shifts})]


def test_covers_are_exact_and_small(spark):
    rng = random.Random(4)
    spans = [(a, a + n) for a, n in ((rng.randint(0, 1 << 21), rng.choice([0, 1, 5, 400, 36525, 900000])) for _ in range(60))]
    df = spark.createDataFrame(spans, "a long, b long").withColumn("cells", intervals.cover("a", "b", 21))
    for r in df.collect():
        days = sorted((c.place << c.level, (c.place + 1) << c.level) for c in r.cells)
        assert days[0][0] == r.a and days[-1][1] == r.b + 1 and all(x[1] == y[0] for x, y in zip(days, days[1:], strict=False))
        assert len(days) <= 2 * max(1, (r.b - r.a + 1).bit_length())
    assert df.select(intervals.cover("a", "a - 1", 21).alias("c")).where("size(c) > 0").isEmpty()


def test_null_rates_of_keys_without_a_schema(spark):
    texts = ['{"a": 1, "b c": "x"}', '{"a": 0, "z": {"y": 1}}', '{"a": "0", "z": {}}', '{"a": null, "z": [0]}', "[1]", "no json", None, '{"b c": 0.0, "t": true}']
    got = profile.key_null_rates(spark.createDataFrame([(t, 1) for t in texts], "value string, key int"), "value")
    assert {r.field: (r.null_rate, r.is_high) for r in got.collect()} == {"a": (0.75, True), "b c": (0.875, True), "z": (0.75, True), "t": (0.875, True)}
    assert profile.key_null_rates(spark.createDataFrame([("3",)], "v string"), "v").collect() == []


def test_newest_revision_of_a_stream(spark, tmp_path):
    """Versions with nulls and ties, rows without an opening time, an empty landing, keys of two columns."""
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    schema = "k int, p string, opened timestamp, version int, note string"
    landings = [
        [(1, "a", day(0), 2, "old"), (1, "a", day(0), 1, "older"), (1, None, day(0), None, "null"), (2, "a", None, 1, "undated"), (3, "a", day(1), 1, "x"), (3, "a", day(1), 1, "y")],
        [],
        [(1, "a", day(0), 3, "new"), (1, None, day(0), 0, "first"), (4, "a", day(9), 1, "later")],
        [(1, "a", day(0), 4, "too late"), (4, "a", day(9), 0, "outdated"), (5, "a", day(30), 1, "last")],
    ]
    args = [str(tmp_path / n) for n in ("in", "out", "state")]
    for rows in landings:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(args[0])
        kind = spark.createDataFrame([], schema).schema
        revisions.settle_revisions(
            spark, args[0], kind, *args[1:], keys=["k", "p"], opened="opened", version=["version"], horizon="7 days", file_format="parquet"
        )
    got = sorted((tuple(r) for r in spark.read.schema(kind).parquet(args[1]).select("k", "p", "note").collect()), key=repr)
    assert got == [(1, "a", "new"), (1, None, "first"), (3, "a", "y"), (4, "a", "later")]


def test_newest_revisions_are_aggregated(spark, tmp_path):
    """Revisions are joined by Spark's own aggregation, before the shuffle too, and no row passes through Python; columns
    without an order may be among them."""
    at, schema = dt.datetime(2024, 1, 1), "k int, opened timestamp, version int, tags map<string,int>"
    rows = [(i % 3, at, i, {"n": i}) for i in range(30)] + [(9, at + dt.timedelta(days=n), 1, None) for n in (20, 40)]
    args = [str(tmp_path / n) for n in ("in", "out", "state")]
    spark.createDataFrame(rows, schema).write.parquet(args[0])
    kind = spark.createDataFrame([], schema).schema
    newest = dict(keys=["k", "opened"], opened="opened", version=["version"])
    plan = revisions.newest_within(spark.readStream.schema(kind).parquet(args[0]), **newest)._jdf.queryExecution().analyzed().toString()
    assert "Aggregate" in plan and "Python" not in plan and "TransformWithState" not in plan
    revisions.settle_revisions(spark, args[0], kind, *args[1:], **newest, file_format="parquet")
    got = sorted((r.k, r.version, r.tags) for r in spark.read.schema(kind).parquet(args[1]).collect())
    assert got == [(0, 27, {"n": 27}), (1, 28, {"n": 28}), (2, 29, {"n": 29}), (9, 1, None)]
