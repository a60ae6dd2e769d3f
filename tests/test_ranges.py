"""Row numbers by ranges, hash trees, manifests that are read again."""

from __future__ import annotations

import datetime as dt
import gzip
import hashlib
import json

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from civicspark.operators import checksums, ranks
from civicspark.registry import ORACLES, QUERIES
from civicspark.sources import landing


@pytest.fixture()
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranks_are_consecutive(spark, many_ranges):
    """Helper names, nulls and ties don't matter; equal rows are dealt to several ranges."""
    df = spark.range(1000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("range"), F.lit(3).alias("row"), F.col("id").cast("string").alias("a b"), "id"
    )
    found = ranks.ranked(df, ["range"])
    got = found.rows("place").orderBy("place").collect()
    assert [r.place for r in got] == list(range(1000)) and sorted(r.id for r in got) == list(range(1000))
    assert [r["range"] or 0 for r in got] == sorted(r["range"] or 0 for r in got)
    assert len(found.ranges) > 1 and found.total == 1000
    equal = ranks.ranked(spark.range(4000).select(F.lit(1).alias("x")), ["x"])
    assert len(equal.ranges) > 1 and max(b - a for a, b in zip(equal.firsts, equal.firsts[1:], strict=False)) < 2000
    assert ranks.ranked(df.limit(0), ["range"]).rows("n").collect() == []


def test_pages_read_their_ranges_only(spark, many_ranges):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x"), (F.col("id") % 3).alias("_rank_"))
    found = ranks.ranked(df, ["x"])
    page = found.between(500, 520)
    assert sorted(r.x for r in page.collect()) == list(range(500, 520))
    assert len({f.split("range=")[1].split("/")[0] for f in page.inputFiles()}) <= len(found.ranges)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(range" in plan and "Window" not in plan and "GlobalLimit" not in plan
    assert found.between(2000, 3000).collect() == [] and [r.x for r in found.at([7]).collect()] == [7]
    pages = [r.x for i in range(4) for r in landing.stable_page(df, ["_rank_"], i, 300).collect()]
    assert sorted(pages) == list(range(1000))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 10])
def test_sampled_names(spark, n):
    names = [f"f{i:02}" for i in range(n)]
    got = landing.sample_names(spark.createDataFrame([(x,) for x in names * 2], "name string"), "name", 3)
    step = n // 3
    assert sorted(r.name for r in got.collect()) == (names if n <= 3 else [names[i * step] for i in range(3)])


def plain_root(lines, fanout):
    level = [hashlib.sha256(x.encode()).hexdigest() for x in lines]
    while True:
        level = [hashlib.sha256("".join(level[i : i + fanout]).encode()).hexdigest() for i in range(0, len(level), fanout)]
        if len(level) == 1:
            return level[0]


def test_hash_trees_match_a_plain_tree(spark, many_ranges):
    sizes = {"a": 1, "b": 4, "c": 5, None: 64, "e": 65, "f": 300}
    lines = {k: [f"{k} {i * i}" for i in range(n)] for k, n in sizes.items()}
    rows = [(k, i, x) for k, v in lines.items() for i, x in enumerate(v)]
    df = spark.createDataFrame(rows[::-1], "_key string, at int, line string")
    tree = checksums.hash_tree(df.withColumnRenamed("_key", "part"), ["part"], ["at"], "line", fanout=4)
    got = {r.part: (r.tree_checksum, r.record_count, r.file_size_bytes) for r in checksums.roots(tree, ["part"]).collect()}
    assert got == {k: (plain_root(v, 4), len(v), sum(len(x) + 1 for x in v)) for k, v in lines.items()}
    assert checksums.hash_tree(df.limit(0), ["_key"], ["at"], "line").collect() == []


def test_flat_roots_hash_all_blocks(spark, many_ranges):
    """Partitions of one line, of one block, of more blocks than a node of the tree has, and of several batches."""
    sizes = {"a": 1, "b": 4, "c": 5, None: 64, "e": 65, "f": 300}
    lines = {k: [f"{k} {i * i}" for i in range(n)] for k, n in sizes.items()}
    df = spark.createDataFrame([(k, i, x) for k, v in lines.items() for i, x in enumerate(v)][::-1], "part string, at int, line string")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    blocks = {k: [digest("".join(map(digest, v[i : i + 4]))) for i in range(0, len(v), 4)] for k, v in lines.items()}
    tree = checksums.hash_tree(df, ["part"], ["at"], "line", fanout=4, height=1)
    assert {r.level for r in tree.select("level").distinct().collect()} == {0, 1}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = sorted((tuple(r) for r in checksums.flat_roots(tree, ["part"], fanout=4).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(((k, b[0] if len(b) == 1 else digest("".join(b))) for k, b in blocks.items()), key=repr)
    assert checksums.differences(tree, tree, ["part"], fanout=4).collect() == []
    assert checksums.flat_roots(checksums.hash_tree(df.limit(0), ["part"], ["at"], "line", height=1), ["part"]).collect() == []


def test_tree_manifest_of_large_partitions_matches_sql(spark, tmp_path):
    """2,500 lines of a day: more than two levels of 32 hold."""
    con = duckdb.connect()
    con.execute(
        "create table events as select range AS event_id, range % 9 AS user_id, CASE WHEN range % 50 = 0 THEN 'b' ELSE 'a' END AS event_type, TIMESTAMP '2024-01-01' AS ts FROM range(2500)"
    )
    con.execute(f"copy events to '{tmp_path}/events.parquet'")
    want = con.execute(ORACLES["tree_manifest"]).fetchall()
    columns = [c[0] for c in con.description]
    assert sorted(map(tuple, QUERIES["tree_manifest"](spark, str(tmp_path)).select(*columns).collect())) == sorted(want)


def test_hash_trees_locate_changes(spark):
    """A changed line, one that is lacking at the end, a partition that only one side has."""
    before = [(p, i, f"{p}{i}") for p, n in (("a", 100), ("b", 70), (None, 5), ("only", 3)) for i in range(n)]
    after = [(p, i, x + "!" if (p, i) in {("a", 17), ("a", 99), (None, 2)} else x) for p, i, x in before if p != "only" and (p, i) != ("b", 69)]
    trees = [
        checksums.hash_tree(spark.createDataFrame(r, "p string, i int, line string"), ["p"], ["i"], "line", fanout=4) for r in (before, after)
    ]
    want = {("a", 17), ("a", 99), (None, 2), ("b", 69), ("only", 0), ("only", 1), ("only", 2)}
    for pair in (trees, trees[::-1]):
        got = [(r.p, r.node) for r in checksums.differences(*pair, ["p"], fanout=4).collect()]
        assert len(got) == len(want) and set(got) == want
    assert checksums.differences(trees[0], trees[0], ["p"], fanout=4).collect() == []


def test_tree_manifests(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("p"), "id", F.lit("2026-01-02").alias("_line"))
    found, _ = landing.tree_manifest(df, ["p"], ["id"], "_line")
    lines = [json.dumps({"id": i, "_line": "2026-01-02"}, separators=(",", ":")) for i in range(0, 100, 2)]
    row = found.where("p = 0").first()
    assert (row.tree_checksum, row.record_count, row.file_size_bytes) == (plain_root(lines, 32), 50, sum(len(x) + 1 for x in lines))
    assert "sha256_checksum" not in found.columns and row.data_date_min == dt.date(2026, 1, 2)


def test_written_manifests_come_back(spark, tmp_path):
    data, beside = str(tmp_path / "d"), str(tmp_path / "m")
    landing.write_daily(spark.range(50).selectExpr("id", "date_format(date_add(date'2026-01-30', cast(id % 5 as int)), 'yyyy-MM-dd') as ts"), data, "ts")
    made = landing.file_manifests(spark, data, source_id="S", dataset_name="x", timestamp_field="ts", fetched=dt.datetime(2026, 2, 3))
    landing.write_manifests(made, beside, most=2)
    found = landing.read_manifests(spark, beside, made.schema)
    assert found.count() == made.count() == 5
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, made.collect()), key=repr)
    landing.write_manifests(made.limit(3), beside)
    assert landing.read_manifests(spark, beside, made.schema).count() == 3


def test_manifests_of_either_form(spark, tmp_path):
    """One object over several lines, one on a line, several on lines with a broken one, an empty file, a broken object."""
    texts = ['{\n "a": 1,\n "b": "x"\n}\n', '{"a": 2, "c": 1}', '{"a": 3}\n\n{"a": \n{"a": 4}\n', "", '{"a": \n', '{\n"b": "y",\n']
    for i, t in enumerate(texts):
        (tmp_path / f"manifest_{i}.json").write_text(t)
    found = landing.read_manifests(spark, str(tmp_path), spark.createDataFrame([], "a long, b string").schema)
    assert sorted(map(tuple, found.collect())) == [(1, "x"), (2, None), (3, None), (4, None)]
    assert found.count() == 4 and found.select("b").where("b is null").count() == 3


def test_daily_landing_keeps_every_field(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") * 3).alias("_at"), F.lit("2026-01-30").alias("ts"))
    landing.write_daily(df, str(tmp_path / "d"), "ts")
    got = [json.loads(x) for f in sorted((tmp_path / "d").rglob("part-*.gz")) for x in gzip.open(f, "rt")]
    assert got == [{"id": i, "_at": 3 * i, "ts": "2026-01-30"} for i in range(10)]


def test_quantiles_are_exact(spark, many_ranges):
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=101).tolist(), "b": [1.0] * 50 + [2.0] * 50, None: [3.0], "none": [None, None], "c": [5.0, None, 7.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    got = {r.k: tuple(r)[1:] for r in ranks.quantiles(df, ["k"], "v", {"low": 0.0, "mid": 0.5, "p": 0.93}).collect()}
    for k, vs in groups.items():
        held = [v for v in vs if v is not None]
        if held:
            assert got[k] == pytest.approx((len(held), *np.quantile(held, [0.0, 0.5, 0.93])))
    assert len(got) == 4
    assert ranks.quantiles(df, [], "v", {"mid": 0.5}).first().n == 204 and ranks.quantiles(df.limit(0), ["k"], "v", {"mid": 0.5}).collect() == []


def test_landing_again_gives_the_same_bytes(spark, tmp_path):
    df = spark.range(300).selectExpr("id", "date_format(date_add(date'2026-01-30', cast(id % 4 as int)), 'yyyy-MM-dd') as ts", "id / 7 as x")

    def landed(name):
        landing.write_daily(df, str(tmp_path / name), "ts")
        return {f.parent.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in (tmp_path / name).rglob("part-*.gz")}

    first = landed("a")
    assert len(first) == 4 and landed("b") == first == landed("a")
