"""Profiles from mergeable states against scans of all records."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from civicspark.operators import profile, profile_states


def records(spark, days=6, seed=2):
    rng = random.Random(seed)
    rows = []
    for day in range(days):
        for _ in range(rng.choice([1, 40, 150])):
            word = rng.choice(["a", " b", "c ", "", None, *[f"w{rng.randint(0, 40)}" for _ in range(6)]])
            rows.append((f"d{day}", rng.choice([None, 0, 1, rng.random() * 100]), word, rng.choice(["1", "x", "2.5", None])))
    rows += [("d9", None, None, None)]
    return spark.createDataFrame([(d, float(x) if x is not None else None, w, t) for d, x, w, t in rows], "day string, x double, word string, `t e` string")


def test_states_add_up_to_a_scan(spark, tmp_path):
    df, of = records(spark), profile_states.Profiled("day", numeric=["x", "t e"], categories=["word"], keep=3)
    path = str(tmp_path / "s")
    profile_states.update(df.where("day < 'd4'"), of, path)
    profile_states.update(df.where("day = 'd2'").limit(0).union(df.where("day >= 'd4'")), of, path)
    got = {r.field: r for r in profile_states.field_profile(spark, path).collect()}
    for r in profile.null_rates(df.drop("day")).collect():
        assert got[r.field].null_rate == r.null_rate and got[r.field].record_count == df.count()
    for r in profile.numerics(df, ["x"]).collect():
        assert (got["x"].missing_pct, got["x"].min, got["x"].max, got["x"].mean, got["x"].stdev) == tuple(r)[1:]
    assert got["t e"].missing_pct == profile.numerics(df.withColumnRenamed("t e", "t"), ["t"]).first().missing_pct


def test_top_values_are_exact(spark, tmp_path):
    """Days keep few values, so that bounds leave candidates open; the days in question are read, others are not."""
    for seed, keep in ((2, 2), (3, 5), (4, 100)):
        df, of = records(spark, seed=seed), profile_states.Profiled("day", categories=["word"], keep=keep)
        path, asked = str(tmp_path / f"s{seed}"), []
        profile_states.update(df, of, path)
        read = lambda days, df=df, asked=asked: asked.extend(days) or df.where(F.col("day").isin(days))
        got = [(r.value, r.n) for r in profile_states.top_values(spark, path, of, read, top=7).orderBy("place").collect()]
        counts = Counter(r.word.strip(" ") for r in df.collect() if r.word)
        assert got == sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:7]
        assert (keep == 100) == (asked == []) and "d9" not in asked


def test_a_new_day_reads_one_day(spark, tmp_path):
    data, path = str(tmp_path / "data"), str(tmp_path / "s")
    of = profile_states.Profiled("day", numeric=["x"], categories=["word"])
    records(spark).write.partitionBy("day").parquet(data)
    table = spark.read.parquet(data)
    profile_states.update(table, of, path)
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "s").rglob("*.parquet")}
    profile_states.update(table.where("day = 'd3'"), of, path)
    after = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "s").rglob("*.parquet")}
    new = set(after) - set(before)
    assert {f.parent.name for f in (tmp_path / "s").rglob("*.parquet") if f.name in new} == {"partition=d3"}
    assert all(after[n] == t for n, t in before.items() if n in after)
    assert "day=d3" in table.where("day = 'd3'").inputFiles()[0] or len(table.where("day = 'd3'").inputFiles()) >= 1
