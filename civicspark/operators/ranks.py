"""Row numbers over a whole table. No task sees all rows: ranges of the order are sorted each for itself, and the sizes of
the ranges, one number each, tell where every range begins."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import drop_folder, scratch


@dataclass
class Ranked:
    """A table written in ranges of its order: a folder each, rows with their place in it."""

    spark: SparkSession
    path: str
    schema: StructType
    #: Where each range that has rows begins; the last entry is the number of all rows.
    ranges: list[int]
    firsts: list[int]

    @property
    def total(self) -> int:
        return self.firsts[-1]

    def rows(self, name: str | None = None, of: Iterable[int] | None = None) -> DataFrame:
        """The rows, with their number (from 0) in a column ``name`` if that is given; ``of``: those of these ranges."""
        wanted = range(len(self.ranges)) if of is None else sorted(of)
        if not wanted:
            empty = StructType([*self._kind(), StructField("first", LongType())])
            return self._numbered(self.spark.createDataFrame([], empty), name)
        table = self.spark.read.schema(self._kind()).parquet(self.path)
        if of is not None:  # only the folders of these ranges are opened
            table = table.where(F.col("range").isin([self.ranges[i] for i in wanted]))
        begins = self.spark.createDataFrame([(self.ranges[i], self.firsts[i]) for i in wanted], "range int, first long")
        return self._numbered(table.join(F.broadcast(begins), "range"), name)  # a row for each range

    def _kind(self) -> StructType:
        return StructType([StructField("row", self.schema), StructField("place", LongType()), StructField("range", IntegerType())])

    def _numbered(self, table: DataFrame, name: str | None) -> DataFrame:
        own = [F.col("row")[f.name].alias(f.name) for f in self.schema]
        return table.select(*own, *([(F.col("first") + F.col("place")).alias(name)] if name else []))

    def between(self, low: int, high: int, name: str = "rank") -> DataFrame:
        """The rows numbered ``low`` to ``high`` - 1, from the ranges that hold them."""
        of = [i for i in range(len(self.ranges)) if self.firsts[i] < high and self.firsts[i + 1] > low]
        return self.rows(name, of).where((F.col(name) >= low) & (F.col(name) < high))

    def at(self, numbers: Iterable[int], name: str = "rank") -> DataFrame:
        """The rows of these numbers, from the ranges that hold them."""
        wanted = sorted(set(numbers))
        of = [i for i in range(len(self.ranges)) if any(self.firsts[i] <= n < self.firsts[i + 1] for n in wanted)]
        return self.rows(name, of).where(F.col(name).isin(wanted))

    def drop(self) -> None:
        drop_folder(self.spark, self.path)


def ranked(rows: DataFrame, order: list[str | Column]) -> Ranked:
    """Action: the rows in ``order``, nulls first, written to the shared folder.

    Rows of equal order go by a hash of all columns, then by these; equal rows are interchangeable, and dealt to several
    ranges however many there are. Columns may have any name.
    """
    spark, path = rows.sparkSession, scratch(rows.sparkSession, "ranked")
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    fields = [F.col(f"`{c}`") for c in rows.columns]
    tie = [F.xxhash64(*fields), *fields, F.monotonically_increasing_id()]
    packed = rows.select(F.struct(*[k.alias(f"k{i}") for i, k in enumerate([*keys, *tie])]).alias("by"), F.struct(*fields).alias("row"))
    dealt = packed.repartitionByRange("by").sortWithinPartitions("by")
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # its lower bits count the rows of a task
    dealt.select("row", F.spark_partition_id().alias("range"), within.alias("place")).write.partitionBy("range").parquet(path)
    if not any(True for _ in _folders(spark, path)):
        return Ranked(spark, path, rows.schema, [], [0])
    sizes = spark.read.parquet(path).groupBy("range").count().orderBy("range").collect()  # a row for each range
    return Ranked(spark, path, rows.schema, [r["range"] for r in sizes], [*accumulate((r["count"] for r in sizes), initial=0)])


def _folders(spark: SparkSession, path: str) -> Iterable[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    for status in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place):
        if status.isDirectory():
            yield status.getPath().getName()


def quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Action: ``by`` and, for each of ``shares`` under its name, the exact quantile of ``value``, interpolated between
    neighbours, with ``n``, the number of values. Nulls aren't values; a group without values has no row.

    Values are placed by a sort in ranges, and of each group the few at the places asked for are looked up: no task holds
    a group's values or its distinct ones, however many there are.
    """
    held = ranked(rows.select(*by, F.col(value).cast("double").alias("_value")).where("_value IS NOT NULL"), [*by, "_value"])
    placed = held.rows("_rank").withColumn("_key", F.struct(F.lit(0), *by))  # null members of equal structs are equal
    groups = placed.groupBy("_key").agg(F.min("_rank").alias("_first"), F.count("*").alias("n"))
    at = lambda s: F.lit(s) * (F.col("n") - 1)
    wanted = [
        F.struct(F.lit(name).alias("name"), (F.col("_first") + side(at(s)).cast("long")).alias("_rank"), weight(at(s)).alias("w"))
        for name, s in shares.items()
        for side, weight in ((F.floor, lambda p: 1 - (p - F.floor(p))), (lambda p: F.floor(p) + 1, lambda p: p - F.floor(p)))
    ]
    places = groups.select("_key", "n", F.explode(F.array(*wanted)).alias("_q")).select("_key", "n", "_q.*").where("w > 0")
    found = places.join(placed.select("_rank", "_value"), "_rank")
    out = found.groupBy("_key", "n").agg(*[F.sum(F.when(F.col("name") == k, F.col("_value") * F.col("w"))).alias(k) for k in shares])
    return out.select(*[F.col("_key")[k].alias(k) for k in by], "n", *shares)
