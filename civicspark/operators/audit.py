"""Coverage and gaps of landed partitions, from the manifest table alone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def daily_gaps(datasets: DataFrame, present: DataFrame, today: date, *, back: int = 14, recoverable: bool = True) -> DataFrame:
    """``dataset``, ``missing`` (date), ``recoverable``: the ``back`` days before today on which a dataset has no partition.

    ``datasets`` has a row for each dataset, ``present`` its partitions as ``dataset`` and ``day``. For snapshots, which
    can't be fetched later, ``recoverable`` is False.
    """
    expected = F.sequence(F.date_sub(F.lit(today), back), F.date_sub(F.lit(today), 1))
    return datasets.select("dataset", F.explode(expected).alias("missing")).join(
        present.select("dataset", F.col("day").cast("date").alias("missing")), ["dataset", "missing"], "left_anti"
    ).withColumn("recoverable", F.lit(recoverable))


def monthly_gaps(datasets: DataFrame, present: DataFrame, today: date, *, back: int = 3) -> DataFrame:
    """The same for the ``back`` full calendar months before today's; ``missing`` is the first of the month."""
    this = F.trunc(F.lit(today), "MM")
    expected = F.sequence(F.add_months(this, -back), F.add_months(this, -1), F.expr("interval 1 month"))
    held = present.select("dataset", F.trunc(F.col("day"), "MM").alias("missing")).distinct()
    return datasets.select(
        "dataset", F.explode(expected).alias("missing")
    ).join(held, ["dataset", "missing"], "left_anti").withColumn("recoverable", F.lit(True))


def fill_ranges(gaps: DataFrame) -> DataFrame:
    """``dataset``, ``fill_start``, ``fill_end``: the half-open range of days that covers a dataset's gaps."""
    return gaps.groupBy("dataset").agg(F.min("missing").alias("fill_start"), F.date_add(F.max("missing"), 1).alias("fill_end"))


def report(datasets: DataFrame, gaps: dict[str, DataFrame], filled: DataFrame | None = None) -> DataFrame:
    """A row for each dataset and kind of audit: how many gaps, from when to when, and whether it is clean, has a gap, or
    a fill has failed (``filled``: ``dataset`` of the fills that have)."""
    out = None
    for kind, found in gaps.items():
        counts = found.groupBy("dataset").agg(
            F.count("*").alias("gaps"), F.min("missing").alias("first_gap"), F.max("missing").alias("last_gap")
        )
        rows = datasets.select("dataset").join(counts, "dataset", "left").select(
            "dataset", F.lit(kind).alias("audit"), F.coalesce("gaps", F.lit(0)).alias("gaps"), "first_gap", "last_gap"
        )
        out = rows if out is None else out.unionByName(rows)
    failed = datasets.sparkSession.createDataFrame([], "dataset string") if filled is None else filled.select("dataset").distinct()
    out = out.join(failed.withColumn("_failed", F.lit(True)), "dataset", "left")
    status = F.when(F.col("gaps") == 0, "clean").when(F.coalesce("_failed", F.lit(False)), "fill failed").otherwise("gap")
    return out.withColumn("status", status).drop("_failed")


def coverage(manifests: DataFrame, *, by: list[str], key: str = "partition_key", count: str = "record_count") -> DataFrame:
    """Each partition's count with its dataset's total, number, least, most and exact median, and the flags ``gap`` (no
    records) and ``anomaly_low`` (some, but under half the median). A manifest is a row; keys may repeat."""
    rows = manifests.select(*by, F.col(key), F.coalesce(F.col(count), F.lit(0)).alias("record_count"))
    c = F.col("record_count")
    sums = rows.groupBy(*by).agg(
        F.sum(c).alias("total_records"),
        F.count("*").alias("partition_count"),
        F.min(c).alias("min_count"),
        F.max(c).alias("max_count"),
        F.percentile(c, F.lit(0.5)).alias("median_count"),
    )
    return rows.join(sums, by).withColumns({"gap": c == 0, "anomaly_low": (c > 0) & (c < 0.5 * F.col("median_count"))})


def coverage_summary(manifests: DataFrame, *, count: str = "record_count") -> DataFrame:
    """One row for all manifests: total, number, least, most, median, gaps and low partitions; zeros where there are none."""
    c = F.coalesce(F.col(count), F.lit(0))
    sums = manifests.agg(
        F.coalesce(F.sum(c), F.lit(0)).alias("total_records"),
        F.count("*").alias("partition_count"),
        F.coalesce(F.min(c), F.lit(0)).alias("min_count"),
        F.coalesce(F.max(c), F.lit(0)).alias("max_count"),
        F.coalesce(F.percentile(c, F.lit(0.5)), F.lit(0.0)).alias("median_count"),
    )
    flags = manifests.select(c.alias("_c")).crossJoin(F.broadcast(sums.select("median_count")))  # one row, whatever the input
    marked = flags.agg(
        F.count_if(F.col("_c") == 0).alias("gaps"),
        F.count_if((F.col("_c") > 0) & (F.col("_c") < 0.5 * F.col("median_count"))).alias("anomaly_low"),
    )
    return sums.crossJoin(marked)


def volume_alerts(expected: DataFrame, actual: DataFrame, keys: list[str], share: float = 0.5) -> DataFrame:
    """Expected rows (``keys``, ``expected``) that came short: no rows at all, or under ``share`` of what is expected."""
    got = F.coalesce("actual", F.lit(0))
    short = expected.join(actual, keys, "left").withColumn("actual", got)
    return short.where(
        (F.col("actual") == 0) | (F.col("actual") < share * F.col("expected"))
    ).withColumn("alert", F.when(F.col("actual") == 0, "no rows").otherwise("low"))
