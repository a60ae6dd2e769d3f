"""Data-quality profiles of any table, as long tables: one row for each field and figure."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field as default

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import missing
from .audit import coverage_summary


def null_rates(df: DataFrame, high: float = 0.05) -> DataFrame:
    """``field``, ``null_rate`` (missing values, rounded to 4), ``is_high`` for every column; one scan."""
    fields = [f for f in df.schema.fields]
    rates = df.agg(
        *[F.round(F.avg(missing(F.col(f"`{f.name}`"), f.dataType.simpleString()).cast("double")), 4).alias(f.name) for f in fields]
    )
    long = rates.unpivot([], [f"`{f.name}`" for f in fields], "field", "null_rate") if fields else rates
    return long.withColumn("is_high", F.coalesce(F.col("null_rate") > high, F.lit(False)))


def key_null_rates(records: DataFrame, column: str, high: float = 0.05) -> DataFrame:
    """``field``, ``null_rate`` and ``is_high`` of every key found in a column of JSON objects: no schema is needed.

    A record lacks a key if it hasn't got it, or has null, '', 0, false, [] or {} there; keys within objects aren't looked
    at. A record that is null, no JSON or no object lacks all keys, and counts. Without any key there is no row.
    """
    parsed = records.select(F.try_parse_json(column).alias("_record"))
    total = parsed.agg(F.count("*").alias("_total"))
    objects = parsed.where(F.schema_of_variant("_record").startswith("OBJECT"))
    each = objects.lateralJoin(records.sparkSession.tvf.variant_explode(F.col("_record").outer())).select("key", "value")
    kind, text = F.schema_of_variant("value"), F.col("value").cast("string")
    number = F.try_variant_get("value", "$", "double")
    empty = (
        F.is_variant_null("value")
        | ((kind == "STRING") & (text == ""))
        | ((kind == "BOOLEAN") & (text == "false"))
        | (kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & (number == 0))
        | (kind.rlike("^(ARRAY|OBJECT)") & text.isin("[]", "{}"))
    )
    filled = each.groupBy(F.col("key").alias("field")).agg(F.count_if(~F.coalesce(empty, F.lit(True))).alias("_filled"))
    rate = F.round(1 - F.col("_filled") / F.col("_total"), 4).alias("null_rate")
    rates = filled.crossJoin(F.broadcast(total)).select("field", rate)  # one row, whatever the input
    return rates.withColumn("is_high", F.col("null_rate") > high)


def timestamps(df: DataFrame, field: str) -> DataFrame:
    """Missing and unreadable shares, values at or before 1970-01-01 and from 2099-01-01 on, least and greatest.

    What follows a plus sign or a Z is cut off; a negative offset can't be read.
    """
    raw = F.col(field).cast("string")
    gone = raw.isNull() | (raw == "")
    local = F.split_part(F.regexp_replace(raw, "Z$", ""), F.lit("+"), F.lit(1))
    negative = local.rlike(r"T\d{2}:?\d{2}.*-\d{2}:?\d{2}$") | local.rlike(r" \d{2}:\d{2}.*-\d{2}:?\d{2}$")
    ts = F.when(~gone & ~negative, F.try_to_timestamp(local))
    low, high = F.to_timestamp(F.lit("1970-01-01 00:00:00")), F.to_timestamp(F.lit("2099-01-01 00:00:00"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return df.select(gone.alias("gone"), ts.alias("ts")).agg(
        F.lit(field).alias("field"), F.round(F.avg(F.col("gone").cast("double")), 4).alias("missing_pct"), F.round(F.avg((~F.col("gone") & F.col("ts").isNull()).cast("double")), 4).alias("parse_error_pct"),
        F.count_if(F.col("ts") <= low).alias("epoch_zero_count"), F.count_if(F.col("ts") >= high).alias("far_future_count"), text(F.min("ts")).alias("min_ts"), text(F.max("ts")).alias("max_ts"),
    )


def categories(df: DataFrame, field: str, valid: DataFrame | Sequence[str], top: int = 20, ignore: str = "Unspecified") -> DataFrame:
    """Trimmed values with their counts: ``value``, ``n``, ``place`` (among the ``top``, else null), ``dirty`` (in no way
    among the valid values, which are lower case; ``ignore`` is never dirty), ``missing_pct`` of the field."""
    raw = F.col(field).cast("string")
    rows = df.select(F.when(raw != "", F.trim(raw)).alias("value"))
    counts = rows.groupBy("value").agg(F.count("*").alias("n"))
    total = counts.agg(F.round(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)) / F.sum("n"), 4).alias("missing_pct"))
    known = counts.where("value is not null")
    best = known.orderBy(F.desc("n"), "value").limit(top).select("value", F.lit(True).alias("in_top"))
    if isinstance(valid, DataFrame):
        allowed = valid.select(F.lower("value").alias("_v")).distinct().withColumn("_ok", F.lit(True))
        out = known.join(allowed, F.lower(known["value"]) == allowed["_v"], "left")
    else:
        out = known.withColumn("_ok", F.when(F.lower("value").isin([v.lower() for v in valid]), True))
    return out.join(best, "value", "left").crossJoin(F.broadcast(total)).select(
        "value",
        "n",
        F.coalesce("in_top", F.lit(False)).alias("in_top"),
        (F.col("_ok").isNull() & (F.col("value") != ignore)).alias("dirty"),
        "missing_pct",
    )


def numerics(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``field``, ``missing_pct`` (null or no number), ``min``, ``max``, ``mean``, ``stdev`` (of a sample; 0 for one value), rounded to 4."""
    stack = F.explode(
        F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").try_cast("double").alias("x")) for f in fields])
    ).alias("_s")
    x = F.col("x")
    return df.select(stack).select("_s.*").groupBy("field").agg(
        F.round(F.avg(x.isNull().cast("double")), 4).alias("missing_pct"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.round(F.avg(x), 4).alias("mean"),
        F.when(F.count(x) > 0, F.round(F.coalesce(F.stddev_samp(x), F.lit(0.0)), 4)).alias("stdev"),
    )


def report(tables: dict[tuple[str, str], DataFrame], numeric: dict[tuple[str, str], Sequence[str]] | None = None) -> DataFrame:
    """One long table over datasets: ``source``, ``dataset``, ``field``, ``metric``, ``value``."""
    out = None
    for (source, dataset), df in tables.items():
        parts = [
            null_rates(df).select("field", F.lit("null_rate").alias("metric"), F.col("null_rate").alias("value")),
            df.agg(
                F.lit(None).cast("string").alias("field"), F.lit("record_count").alias("metric"), F.count("*").cast("double").alias("value")
            ),
        ]
        if fields := (numeric or {}).get((source, dataset)):
            parts.append(numerics(df, fields).unpivot("field", ["min", "max", "mean", "stdev"], "metric", "value"))
        for part in parts:
            rows = part.select(
                F.lit(source).alias("source"),
                F.lit(dataset).alias("dataset"),
                "field",
                "metric",
                F.col("value").cast("double").alias("value"),
            )
            out = rows if out is None else out.unionByName(rows)
    return out


@dataclass(frozen=True)
class Dataset:
    """What is profiled of a dataset: its records, and where they have them a timestamp, a field of categories with its
    valid values, numeric fields, and the manifests of its partitions."""

    records: DataFrame
    timestamp: str | None = None
    category: str | None = None
    valid: DataFrame | Sequence[str] = ()
    numeric: Sequence[str] = default(default_factory=tuple)
    manifests: DataFrame | None = None


def dataset_profile(datasets: dict[tuple[str, str], Dataset], high: float = 0.05) -> DataFrame:
    """All profiles of all datasets in one long table: ``source``, ``dataset``, ``section``, ``field``, ``metric``, ``value``
    and ``text`` for what isn't a number.

    Sections: coverage (totals over manifests), records (their number and that of their fields), null_rates (with
    ``high_place``, the place among those above ``high``, highest rate first, then by name), timestamps, categories and
    numerics.
    """
    out = None
    for (source, dataset), d in datasets.items():
        for section, part in _sections(d, high):
            rows = part.select(
                F.lit(source).alias("source"),
                F.lit(dataset).alias("dataset"),
                F.lit(section).alias("section"),
                "field",
                "metric",
                "value",
                "text",
            )
            out = rows if out is None else out.unionByName(rows)
    return out


def _sections(d: Dataset, high: float) -> list[tuple[str, DataFrame]]:
    records, none = d.records, F.lit(None).cast("string")
    rates = null_rates(records, high)  # a row for each column, in one partition
    place = F.size(
        F.filter(
            F.col("_all"),
            lambda x: (x["null_rate"] > F.col("null_rate")) | ((x["null_rate"] == F.col("null_rate")) & (x["field"] < F.col("field"))),
        )
    ) + 1
    ranked = rates.crossJoin(
        rates.where("is_high").agg(F.collect_list(F.struct("field", "null_rate")).alias("_all"))
    ).withColumn("high_place", F.when(F.col("is_high"), place))
    n_fields = F.lit(float(len(records.columns))).alias("field_count")
    parts = [
        ("records", _long(records.agg(none.alias("field"), F.count("*").alias("record_count"), n_fields))),
        ("null_rates", _long(ranked.select("field", "null_rate", "high_place"))),
    ]
    if d.manifests is not None:
        parts.append(("coverage", _long(coverage_summary(d.manifests).withColumn("field", none))))
    if d.timestamp:
        parts.append(("timestamps", _long(timestamps(records, d.timestamp), texts=("min_ts", "max_ts"))))
    if d.category:
        found = categories(records, d.category, d.valid)
        dirty = F.array_join(F.array_sort(F.collect_set(F.when(F.col("dirty"), F.col("value")))), "|").alias("dirty_values")
        parts.append(
            (
                "categories",
                _long(
                    found.agg(
                        F.lit(d.category).alias("field"),
                        F.count("*").alias("distinct_count"),
                        F.count_if("dirty").alias("dirty_count"),
                        F.max("missing_pct").alias("missing_pct"),
                        dirty,
                    ),
                    texts=("dirty_values",),
                ),
            )
        )
    if d.numeric:
        parts.append(("numerics", _long(numerics(records, d.numeric))))
    return parts


def _long(wide: DataFrame, texts: Sequence[str] = ()) -> DataFrame:
    """``field``, ``metric``, ``value``, ``text`` of each other column that isn't null."""
    metrics = [c for c in wide.columns if c != "field"]
    value = lambda c: F.lit(None).cast("double") if c in texts else F.col(c).cast("double")
    text = lambda c: F.col(c) if c in texts else F.lit(None).cast("string")
    each = F.array(*[F.struct(F.lit(c).alias("metric"), value(c).alias("value"), text(c).alias("text")) for c in metrics])
    return wide.select("field", F.inline(each)).where("value is not null or text is not null")
