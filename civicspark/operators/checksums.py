"""Checksums of ordered lines as hash trees, so that neither a partition nor its list of hashes comes together in one row.

A line's hash is a leaf, at its place in the order. Up to ``FANOUT`` neighbours make a node of the level above, whose hash is
that of theirs one after the other, until one node is left, the root. Two trees that differ in a line differ along its branch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch
from .ranks import ranked

FANOUT = 32


def hash_tree(
    lines: DataFrame, keys: list[str], order: list[str], line: str, fanout: int = FANOUT, height: int | None = None
) -> DataFrame:
    """Action: all nodes of the tree of each partition: ``keys``, ``level`` (0: lines), ``node`` (place in the level),
    ``hash`` (SHA-256 in hex), ``n_lines`` and ``bytes`` (with line ends) below it, ``total`` lines of the partition.

    ``order`` must tell the lines of a partition apart, or equal ones are taken in any order. A null line is an empty one;
    keys may be null. A tree has a level above its lines even if it has one line; a table without rows has no tree. With
    ``height`` levels above that one are left out, and the highest may have several nodes.
    """
    spark = lines.sparkSession
    rows = ranked(lines.select(*keys, *[c for c in order if c not in keys], F.coalesce(line, F.lit("")).alias("_line")), [*keys, *order])
    placed = rows.rows("_rank").withColumn("_key", F.struct(*keys))  # null members of equal structs are equal
    begins = placed.groupBy("_key").agg(F.min("_rank").alias("_first"), F.count("*").alias("total"))
    leaves = placed.join(begins, "_key")
    level = leaves.select(
        *keys,
        F.lit(0).alias("level"),
        (F.col("_rank") - F.col("_first")).alias("node"),
        F.sha2("_line", 256).alias("hash"),
        F.lit(1).cast("long").alias("n_lines"),
        (F.octet_length("_line") + 1).cast("long").alias("bytes"),
        "total",
    )
    path, top, schema = scratch(spark, "hash-tree"), 0, level.schema
    while True:
        level.drop("level").write.parquet(f"{path}/level={top}")
        below = spark.read.schema(schema).parquet(f"{path}/level={top}").drop("level")
        # of the partitions that have more than one node so far, and of all the first level above the lines
        open_ = below if top == 0 else below.where(F.col("total") > fanout**top)
        if top == height or open_.isEmpty():
            break
        top += 1
        at = [F.max(F.when(F.col("node") % fanout == i, F.col("hash"))).alias(f"_{i}") for i in range(fanout)]
        grouped = open_.groupBy(*keys, F.expr(f"node div {fanout}").alias("_node"), "total").agg(
            *at, F.sum("n_lines").alias("n_lines"), F.sum("bytes").alias("bytes")
        )
        level = grouped.select(
            *keys,
            F.lit(top).alias("level"),
            F.col("_node").alias("node"),
            F.sha2(F.concat_ws("", *[f"_{i}" for i in range(fanout)]), 256).alias("hash"),
            "n_lines",
            "bytes",
            "total",
        )
    rows.drop()
    return spark.read.schema(schema).parquet(path)


def roots(tree: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``tree_checksum``, ``record_count`` and ``file_size_bytes`` of each partition."""
    top = (F.col("level") > 0) & (F.col("n_lines") == F.col("total"))
    return tree.where(top).select(
        *keys, F.col("hash").alias("tree_checksum"), F.col("n_lines").alias("record_count"), F.col("bytes").alias("file_size_bytes")
    )


def flat_roots(tree: DataFrame, keys: list[str], fanout: int = FANOUT) -> DataFrame:
    """``keys`` and ``tree_checksum`` of each partition: one hash of those of all its blocks of ``fanout`` lines, in order,
    however many there are; of a single block its own.

    One hash of a text can't be put together from those of its parts, so the hashes of a partition's blocks, two bytes a line,
    pass through one task; it holds a batch of them at a time.
    """
    blocks = tree.where("level = 1").select(*keys, "node", "total", F.col("hash").alias("tree_checksum"))
    n = len(keys)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = hashlib.sha256()
        for batch in batches:
            last, found = [], []
            for i, (node, total, value) in enumerate(zip(*(batch.column(n + j).to_pylist() for j in range(3)), strict=True)):
                if node == 0:
                    running = hashlib.sha256()
                running.update(value.encode())
                if (node + 1) * fanout >= total:
                    last.append(i)
                    found.append(running.hexdigest() if node else value)
            rows = batch.take(pa.array(last, pa.int64()))
            columns = [*rows.columns[:n], pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:n], "tree_checksum"])

    line = blocks.repartition(F.struct(*keys)).sortWithinPartitions(*keys, "node")
    return line.mapInArrow(hashed, blocks.drop("node", "total").schema)


def differences(left: DataFrame, right: DataFrame, keys: list[str], fanout: int = FANOUT) -> DataFrame:
    """Action: ``keys`` and ``node``, the places of lines that differ or that only one tree has.

    From the top down only children of nodes that differ are compared, so that the lines of equal branches are never
    matched. Where trees have different heights, the comparison begins at the height of the lower one; a partition that
    only one side has differs in all its lines.
    """
    spark = left.sparkSession
    key = F.struct(*keys).alias("_key")  # null members of equal structs are equal
    sides = [t.select(key, "level", "node", "hash") for t in (left, right)]
    heights = [t.groupBy("_key").agg(F.max("level").alias("top")) for t in sides]
    both = heights[0].unionByName(heights[1]).groupBy("_key")
    begins = both.agg(F.when(F.count("*") == 2, F.min("top")).otherwise(0).alias("top"))
    height = begins.agg(F.max("top")).first()[0]
    found = spark.createDataFrame([], left.select(key, "node").schema)
    for level in range(-1 if height is None else height, -1, -1):
        start, parents = begins.where(F.col("top") == level).select("_key"), found.withColumnRenamed("node", "_parent")

        def inside(side: DataFrame) -> DataFrame:
            rows = side.where(F.col("level") == level).withColumn("_parent", F.expr(f"node div {fanout}"))  # noqa: B023
            return rows.join(start, "_key", "left_semi").unionByName(rows.join(parents, ["_key", "_parent"], "left_semi"))  # noqa: B023

        a, b = (inside(t).select("_key", "node", F.col("hash").alias(n)) for t, n in zip(sides, ("a", "b"), strict=True))
        path = scratch(spark, "differing")
        matched = a.join(b, ["_key", "node"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("_key", "node")
        matched.write.parquet(path)
        found = spark.read.schema(matched.schema).parquet(path)
    return found.select("_key.*", "node")
