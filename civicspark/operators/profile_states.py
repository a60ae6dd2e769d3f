"""Profiles that are kept up to date: each partition has mergeable states, and a new partition is the only one that is read.

A partition's state holds counts, least and greatest values and moments of its fields, and the most frequent values of its
categories with what the others have at most. States are added up; where the kept values don't tell the top list for
certain, the partitions that may still change it are read again, for the values in question alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import missing
from ..session import scratch
from ..sources.landing import write_partitions


@dataclass(frozen=True)
class Profiled:
    """The fields of a dataset: all for missing values, ``numeric`` ones, ``categories``; ``partition`` tells partitions
    apart, ``keep`` values of a category are kept for each."""

    partition: str
    numeric: Sequence[str] = ()
    categories: Sequence[str] = ()
    keep: int = 1000


def _text(field: str) -> Column:
    raw = F.col(f"`{field}`").cast("string")
    return F.when(raw != "", F.trim(raw))


def figures(records: DataFrame, of: Profiled) -> DataFrame:
    """The state of all fields: ``partition``, ``field``, ``records``, ``gone`` (missing values), and of numeric fields ``n``
    (numbers), ``low``, ``high``, ``mean`` and ``spread``, the sum of squares about the mean. One scan."""
    fields = [f for f in records.schema.fields if f.name != of.partition]
    number = lambda f: F.col(f"`{f.name}`").cast("string").try_cast("double") if f.name in of.numeric else F.lit(None).cast("double")
    gone = lambda f: missing(F.col(f"`{f.name}`"), f.dataType.simpleString())
    each = F.array(*[F.struct(F.lit(f.name).alias("field"), gone(f).alias("gone"), number(f).alias("x")) for f in fields])
    rows = records.select(F.col(of.partition).cast("string").alias("partition"), F.explode(each).alias("s")).select("partition", "s.*")
    return rows.groupBy("partition", "field").agg(
        F.count("*").alias("records"),
        F.count_if("gone").alias("gone"),
        F.count("x").alias("n"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.avg("x").alias("mean"),
        (F.var_pop("x") * F.count("x")).alias("spread"),
    )


def values(records: DataFrame, of: Profiled) -> DataFrame:
    """The state of categories: ``partition``, ``field``, ``value`` (trimmed; null for missing ones) and ``n`` for the most
    frequent ``keep`` of each partition, with ``left_most``, the highest count that isn't kept (0 where all are)."""
    each = F.array(*[F.struct(F.lit(f).alias("field"), _text(f).alias("value")) for f in of.categories])
    rows = records.select(F.col(of.partition).cast("string").alias("partition"), F.explode(each).alias("s")).select("partition", "s.*")
    counts = rows.groupBy("partition", "field", "value").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("partition", "field").orderBy(F.desc("n"), "value"))
    best = counts.withColumn("place", place).where(F.col("place") <= of.keep + 1)  # tasks pass on their best
    left = F.coalesce(F.max(F.when(F.col("place") == of.keep + 1, F.col("n"))).over(Window.partitionBy("partition", "field")), F.lit(0))
    return best.withColumn("left_most", left).where(F.col("place") <= of.keep).drop("place")


def update(records: DataFrame, of: Profiled, states: str) -> None:
    """Action: writes the states of the partitions that ``records`` holds; those of others stay as they are."""
    write_partitions(figures(records, of), f"{states}/figures", "partition")
    if of.categories:
        write_partitions(values(records, of), f"{states}/values", "partition")


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(f"{kind}, partition string").parquet(path)


def field_profile(spark: SparkSession, states: str) -> DataFrame:
    """``field``, ``record_count``, ``null_rate``, and of numeric fields ``missing_pct``, ``min``, ``max``, ``mean``, ``stdev``
    over all partitions, rounded as a scan of the records has them. Only states are read."""
    kind = "field string, records long, gone long, n long, low double, high double, mean double, spread double"
    rows = _read(spark, f"{states}/figures", kind)
    whole = rows.groupBy("field").agg(
        F.sum("records").alias("record_count"), F.sum("gone").alias("gone"), F.sum("n").alias("n"), F.min("low").alias("min"),
        F.max("high").alias("max"), (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("center"),
    )
    about = rows.join(whole.select("field", "center"), "field").groupBy("field").agg(
        F.sum(F.col("spread") + F.col("n") * F.pow(F.col("mean") - F.col("center"), 2)).alias("spread")
    )
    stdev = F.when(F.col("n") > 0, F.when(F.col("n") == 1, 0.0).otherwise(F.round(F.sqrt(F.col("spread") / F.nullif(F.col("n") - 1, F.lit(0))), 4)))
    return whole.join(about, "field").select(
        "field",
        "record_count",
        F.round(F.col("gone") / F.col("record_count"), 4).alias("null_rate"),
        F.when(F.col("n") > 0, F.round(1 - F.col("n") / F.col("record_count"), 4)).alias("missing_pct"),
        "min",
        "max",
        F.round("center", 4).alias("mean"),
        stdev.alias("stdev"),
    )


def top_values(spark: SparkSession, states: str, of: Profiled, read: Callable[[list[str]], DataFrame], top: int = 20) -> DataFrame:
    """Action: ``field``, ``value``, ``n`` and ``place`` of each category's ``top`` values over all partitions, exactly.

    A value's count lies between what is kept of it and that with ``left_most`` of every partition that hasn't kept it. All
    values whose upper bound reaches the lower bound of the last place are candidates; where a candidate's bounds differ,
    the partitions that haven't kept it are read again through ``read``, which gets their names. Where even a value that no
    partition has kept may be among the first, which takes a small ``keep``, all partitions that left values out are.
    """
    rows = _read(spark, f"{states}/values", "field string, value string, n long, left_most long").where("value IS NOT NULL")
    lefts = _read(spark, f"{states}/values", "field string, left_most long").distinct()  # one row for each field and partition
    total = lefts.groupBy("field").agg(F.sum("left_most").alias("left"))
    sums = rows.groupBy("field", "value").agg(F.sum("n").alias("low"), F.sum("left_most").alias("known"))
    bounds = sums.join(total, "field").select("field", "value", "low", (F.col("low") + F.col("left") - F.col("known")).alias("high"))
    by_low = Window.partitionBy("field").orderBy(F.desc("low"), "value")
    last = bounds.withColumn("place", F.row_number().over(by_low)).where(F.col("place") <= top).groupBy("field").agg(
        F.min("low").alias("least"), F.count("*").alias("found")
    ).withColumn("least", F.when(F.col("found") < top, 0).otherwise(F.col("least")))
    unseen = [r["field"] for r in total.join(last, "field", "left").where("left > 0 AND left >= coalesce(least, 0)").collect()]  # fields
    path = scratch(spark, "candidates")
    able = bounds.join(last, "field").where((F.col("high") >= F.col("least")) & ~F.col("field").isin(unseen))
    able.select("field", "value", "low", "high").write.parquet(path)
    candidates = spark.read.schema("field string, value string, low long, high long").parquet(path)
    # a partition may change a candidate's count if it has left out values and hasn't kept this one
    open_ = candidates.where("high > low").select("field", "value").join(lefts.where("left_most > 0"), "field")
    again = open_.join(rows, ["field", "value", "partition"], "left_anti").select("field", "value", "partition")
    whole = lefts.where((F.col("left_most") > 0) & F.col("field").isin(unseen)).select("field", "partition")
    partitions = again.select("partition").union(whole.select("partition")).distinct()
    names = [r["partition"] for r in partitions.collect()]  # partitions, not records
    kept = rows.where(F.col("field").isin(unseen)).join(whole, ["field", "partition"], "left_anti").select("field", "value", "n")
    counts = candidates.select("field", "value", F.col("low").alias("n")).union(kept)
    if names:
        each = F.array(*[F.struct(F.lit(f).alias("field"), _text(f).alias("value")) for f in of.categories])
        seen = read(names).select(F.col(of.partition).cast("string").alias("partition"), F.explode(each).alias("s"))
        found = seen.select("partition", "s.*").where("value IS NOT NULL").groupBy("partition", "field", "value").agg(F.count("*").alias("n"))
        for part, on in ((again, ["partition", "field", "value"]), (whole, ["partition", "field"])):
            counts = counts.union(found.join(part, on, "left_semi").select("field", "value", "n"))
    summed = counts.groupBy("field", "value").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "value"))
    return summed.withColumn("place", place).where(F.col("place") <= top)
