"""City-operations queries: demand from service requests, supply from shifts and bans, load scores and recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import level

# Patterns of winter request types, and the weights of the three priorities.
WINTER_WORDS = ("SNOW", "FROZEN", "PLOW", "PLOUGH", "SANDING", "WINDROW", "ICE CONTROL")
PRIORITY_WEIGHTS = ((1, 3), (2, 2), (3, 1))
#: The weights of demand, supply gap and weather in the load score.
LOAD_WEIGHTS = (("demand", 0.40), ("gap", 0.30), ("weather", 0.30))


def volumes(interactions: DataFrame, case: str, by: Sequence[str] = ()) -> DataFrame:
    """Both volumes: contacts (rows) and distinct cases."""
    return interactions.groupBy(*by).agg(F.count("*").alias("contacts"), F.count_distinct(case).alias("cases"))


def normalise(df: DataFrame, column: str, mapping: DataFrame, out: str) -> DataFrame:
    """Adds ``out``: the value that the vocabulary (``raw``, ``value``) gives, else the value itself. Vocabularies are small by nature."""
    return df.join(
        mapping.select(F.col("raw").alias("_raw"), F.col("value").alias("_value")), F.col(column) == F.col("_raw"), "left"
    ).withColumn(out, F.coalesce("_value", column)).drop("_raw", "_value")


def type_dictionary(types: DataFrame, column: str) -> DataFrame:
    """Of each distinct type: ``priority`` (Priority 2, Pr 2, P2), ``shift`` (Reg, After) and ``is_vof`` (suffix _vof)."""
    t = F.col(column)
    priority = F.regexp_extract(t, r"(?i)\bP(?:riority|r)?\s?([1-9])\b", 1)
    shift = F.when(t.rlike(r"(?i)\bAfter(\s+Hours)?\b"), "After").when(t.rlike(r"(?i)\bReg\b"), "Reg")
    return types.select(column).distinct().select(
        column,
        F.when(priority != "", priority.cast("int")).alias("priority"),
        shift.alias("shift"),
        F.lower(t).endswith("_vof").alias("is_vof"),
    )


def keyword_flags(df: DataFrame, column: str, words: Sequence[str] = WINTER_WORDS) -> DataFrame:
    """Adds ``hits``, the words that the upper-case value contains, and ``is_hit``."""
    upper = F.upper(column)
    hits = F.filter(F.array(*[F.when(upper.contains(w), F.lit(w)) for w in words]), lambda x: x.isNotNull())
    return df.withColumn("hits", hits).withColumn("is_hit", F.coalesce(F.size("hits") > 0, F.lit(False)))


def keyword_report(flagged: DataFrame) -> DataFrame:
    """Rows for each word, and for any of them (each row once)."""
    each = flagged.where("is_hit").select(F.explode("hits").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return each.unionByName(flagged.agg(F.lit("ANY").alias("word"), F.count_if("is_hit").alias("n")))


def geo_share(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """How many rows have a place, and their share."""
    has = F.col(x).isNotNull() & F.col(y).isNotNull()
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(has).alias("n_geo"), F.round(F.avg(has.cast("double")), 6).alias("geo_share")
    )


def weighted_volume(
    requests: DataFrame, by: Sequence[str], priority: str, weights: Sequence[tuple[int, int]] = PRIORITY_WEIGHTS
) -> DataFrame:
    """Requests and requests weighted by priority; other priorities weigh nothing."""
    weight = F.coalesce(*[F.when(F.col(priority) == p, F.lit(w)) for p, w in weights], F.lit(0))
    return requests.groupBy(*by).agg(F.count("*").alias("requests"), F.sum(weight).alias("weighted"))


def load_anomalies(daily: DataFrame, count: str, median: str, factor: float = 1.5) -> DataFrame:
    return daily.withColumn("is_anomaly", F.coalesce(F.col(count) > factor * F.col(median), F.lit(False)))


def shift_report(shifts: DataFrame, event: str, zone: str, start: str, end: str, zones: int) -> DataFrame:
    """For each event: zones covered and their share of all, hours of work, and when it was complete."""
    hours = (F.unix_timestamp(F.col(end).cast("timestamp")) - F.unix_timestamp(F.col(start).cast("timestamp"))) / 3600.0
    return shifts.groupBy(event).agg(
        F.count_distinct(zone).alias("zones_covered"),
        F.round(F.count_distinct(zone) / zones, 6).alias("coverage"),
        F.round(F.sum(hours), 4).alias("hours"),
        F.max(end).alias("completed"),
    )


def declared_and_done(declared: DataFrame, done: DataFrame, *, key: str, done_key: str, kind: str, sentinel: str = "0") -> DataFrame:
    """For each kind: declarations with and without any execution, never null. The sentinel key stands for none."""
    real = done.where(
        F.nullif(F.col(done_key).cast("string"), F.lit(sentinel)).isNotNull()
    ).select(F.col(done_key).alias(key)).distinct().withColumn("_has", F.lit(True))
    flagged = declared.join(real, key, "left").withColumn("has", F.coalesce("_has", F.lit(False)))
    return flagged.groupBy(kind).agg(
        F.count("*").alias("declared"), F.count_if("has").alias("with_execution"), F.count_if(~F.col("has")).alias("without_execution")
    )


def scheduled(zones: DataFrame, schedule: DataFrame, zone: str) -> DataFrame:
    """Zones with ``has_schedule``."""
    held = schedule.select(zone).where(F.col(zone).isNotNull()).distinct().withColumn("_has", F.lit(True))
    return zones.join(held, zone, "left").withColumn("has_schedule", F.coalesce("_has", F.lit(False))).drop("_has")


def severity(days: DataFrame, snow: str, cold: str, weights: tuple[float, float] = (0.5, 0.5), cold_below: float = -25.0) -> DataFrame:
    """Adds ``is_cold_day`` and ``severity`` (0 to 1): snow and coldness, each scaled between its extremes, weighed."""
    ends = days.agg(F.min(snow).alias("_s0"), F.max(snow).alias("_s1"), F.min(cold).alias("_c0"), F.max(cold).alias("_c1"))
    scaled = lambda x, lo, hi: F.coalesce((F.col(x) - F.col(lo)) / F.nullif(F.col(hi) - F.col(lo), F.lit(0.0)), F.lit(0.0))
    out = days.crossJoin(F.broadcast(ends))  # one row
    score = weights[0] * scaled(snow, "_s0", "_s1") + weights[1] * (1 - scaled(cold, "_c0", "_c1"))
    return out.withColumns(
        {"is_cold_day": F.coalesce(F.col(cold) <= cold_below, F.lit(False)), "severity": score}
    ).drop("_s0", "_s1", "_c0", "_c1")


def dose_response(days: DataFrame, dose: str, response: str, width: float) -> DataFrame:
    """Response by bucket of the dose."""
    bucket = F.floor(F.col(dose) / width).cast("long")
    return days.where(F.col(dose).isNotNull()).groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("days"),
        F.round(F.avg(response), 6).alias("mean_response"),
        F.percentile(response, F.lit(0.5)).alias("median_response"),
    )


def empirical_threshold(days: DataFrame, dose: str, declared: str, width: float, share: float = 0.5) -> DataFrame:
    """The lowest bucket edge from which at least ``share`` of the days saw a declaration."""
    bucket = F.floor(F.col(dose) / width).cast("long")
    rates = days.where(F.col(dose).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.avg(F.col(declared).cast("double")).alias("rate"))
    return rates.where(F.col("rate") >= share).agg((F.min("bucket") * width).alias("threshold"))


def durations(requests: DataFrame, by: Sequence[str], opened: str, closed: str) -> DataFrame:
    """Median and 90th percentile of days from open to close; open rows are left out."""
    days = F.datediff(closed, opened)
    return requests.where(F.col(closed).isNotNull() & F.col(opened).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), F.percentile(days, F.lit(0.5)).alias("p50"), F.percentile(days, F.lit(0.9)).alias("p90")
    )


def dispersion(medians: DataFrame, value: str) -> DataFrame:
    """How far the areas' medians lie apart."""
    return medians.agg(
        F.count("*").alias("areas"),
        F.round(F.coalesce(F.stddev_samp(value), F.lit(0.0)), 6).alias("stddev"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
    )


def allocate(parents: DataFrame, history: DataFrame, *, parent: str, child: str, value: str, count: str) -> DataFrame:
    """A parent's value shared among its children by their share of the history; the parts add up to the parent's value."""
    share = F.col(count) / F.sum(count).over(Window.partitionBy(parent))
    return history.withColumn("share", share).join(parents.select(parent, value), parent).withColumn(
        "allocated", F.col(value) * F.col("share")
    )


def load_score(
    grid: DataFrame,
    *,
    demand: str,
    addresses: str,
    gap: str,
    weather: str,
    event: str,
    cuts: Sequence[tuple[float, str]] = ((25.0, "MED"), (50.0, "HIGH"), (75.0, "CRITICAL")),
    weights: Sequence[tuple[str, float]] = LOAD_WEIGHTS,
) -> DataFrame:
    """Adds ``score`` (0 to 100), ``level`` and ``driver`` (the largest weighted term, in the order of the weights).

    Demand is requests per address, scaled by the event's largest; a missing term counts 0.
    """
    w = Window.partitionBy(event)
    rate = F.col(demand) / F.nullif(F.col(addresses).cast("double"), F.lit(0.0))
    rows = grid.withColumn("_rate", rate)
    terms = {
        "demand": F.col("_rate") / F.nullif(F.max("_rate").over(w), F.lit(0.0)), "gap": F.col(gap).cast("double"), "weather": F.col(weather)
    }
    rows = rows.withColumns({f"_{n}": weight * F.coalesce(terms[n], F.lit(0.0)) for n, weight in weights})
    best = F.greatest(*[F.col(f"_{n}") for n, _ in weights])
    driver = F.coalesce(*[F.when(F.col(f"_{n}") == best, F.lit(n)) for n, _ in weights])
    score = 100 * sum((F.col(f"_{n}") for n, _ in weights[1:]), F.col(f"_{weights[0][0]}"))
    return rows.withColumns(
        {"score": F.round(score, 6), "driver": driver}
    ).withColumn("level", level(F.col("score"), cuts, "LOW")).drop("_rate", *[f"_{n}" for n, _ in weights])


def recommend(scored: DataFrame, rules: DataFrame, *, event: str, zone: str, top: int | None = None) -> DataFrame:
    """Zones ranked in each event by score, with the rule's text for their level and driver, else for their level alone."""
    rank = F.row_number().over(Window.partitionBy(event).orderBy(F.desc("score"), zone))
    exact = rules.where(F.col("driver").isNotNull()).select("level", "driver", F.col("text").alias("_exact"))
    general = rules.where(F.col("driver").isNull()).select("level", F.col("text").alias("_general"))
    out = scored.withColumn("place", rank).join(exact, ["level", "driver"], "left").join(general, "level", "left")
    out = out.withColumn("recommendation", F.coalesce("_exact", "_general")).drop("_exact", "_general")
    return out if top is None else out.where(F.col("place") <= top)


def seasonal_baseline(seasons: DataFrame, *, area: str, season: str, value: str) -> DataFrame:
    """Adds ``baseline``: the area's mean over strictly earlier seasons."""
    earlier = Window.partitionBy(area).orderBy(season).rangeBetween(Window.unboundedPreceding, -1)
    return seasons.withColumn("baseline", F.avg(value).over(earlier))


def snapshot_changes(snapshots: DataFrame, *, key: str, collected: str, flags: Sequence[str]) -> DataFrame:
    """Rows whose flags differ from the key's previous collection, with the flag and both values."""
    w = Window.partitionBy(key).orderBy(collected)
    before = snapshots.withColumns({f"_{f}": F.lag(f).over(w) for f in flags}).withColumn("_seen", F.lag(collected).over(w))
    changes = F.filter(
        F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f"_{f}").alias("old"), F.col(f).alias("new")) for f in flags]),
        lambda s: ~s["old"].eqNullSafe(s["new"]),
    )
    return before.where(F.col("_seen").isNotNull()).select(key, collected, F.explode(changes).alias("c")).select(key, collected, "c.*")


def errors(predicted: DataFrame, actual: str, model: str, baseline: str) -> DataFrame:
    """Mean absolute errors of model and baseline, always as a pair, over rows that have both."""
    both = predicted.where(F.col(model).isNotNull() & F.col(baseline).isNotNull())
    mae = lambda c: F.round(F.avg(F.abs(F.col(actual) - F.col(c))), 6)
    return both.agg(F.count("*").alias("n"), mae(model).alias("model_mae"), mae(baseline).alias("baseline_mae"))


def count_model(rows: DataFrame, features: Sequence[str], label: str, split: Column, penalty: float = 1e-6) -> DataFrame:
    """Action: a Poisson model of counts, fitted where ``split`` is false, with ``prediction`` for the rows where it is true.
    A small ``penalty`` gives a result for features that depend on each other too."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    ready = VectorAssembler(inputCols=[*features], outputCol="_x", handleInvalid="skip").transform(rows)
    model = GeneralizedLinearRegression(
        family="poisson", link="log", featuresCol="_x", labelCol=label, maxIter=50, tol=1e-10, regParam=penalty
    ).fit(ready.where(~split))
    return model.transform(ready.where(split)).drop("_x")
