"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's target is cut into blocks of one size for all sources, the last one of a source holds the rest. The points
j * (golden ratio) mod 1 are mapped through the cumulative numbers of blocks: slot j of the mix goes to the source whose
interval holds the point. Slots are ranked within their source, and the slot of rank k gets the k-th block of the source's
documents, in shuffled order and as often as needed; what no slot gets isn't taken. The schedule goes on until every source
has a slot for each of its blocks: of n golden-ratio points no two neighbours are more than 1.9 / n apart, so twice as many
slots as there are blocks are enough for any source, however small; slots beyond a source's blocks stay empty.
Hot sources are never in one task: ranks and running sums are taken within segments and hash buckets, and the
offsets of these are summed from one row per segment or bucket.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import materialize, small_table

#: A word: anything but space, and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: The fraction of the golden ratio, times 2**53, rounded to an odd number: j times it, modulo 2**53, is exact.
_GOLDEN = round((math.sqrt(5) - 1) / 2 * 2**53) | 1
_PER_BUCKET = 512
#: Sources whose table is broadcast.
_BROADCAST = 100_000


@dataclass(frozen=True)
class Target:
    source: str | None
    size: int
    target: float


def words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: list[tuple[str | None, int]], *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> list[Target]:
    """The words wanted of each source. Sources stand by code point, null last, and weigh ``weights`` in turn; together
    they get ``share`` of all words. A target stops at ``most`` times its source's size; the excess is shared again by
    weight among the others until none is above."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = [weights[i % len(weights)] for i in range(len(order))]
    left, open_, out = share * sum(n for _, n in order), set(range(len(order))), [0.0] * len(order)
    while open_:
        total = sum(weight[i] for i in open_)
        full = {i for i in open_ if left * weight[i] / total > most * order[i][1]}
        for i in full or open_:
            out[i] = float(most * order[i][1]) if full else left * weight[i] / total
        if not full:
            break
        left -= sum(out[i] for i in full)
        open_ -= full
    return [Target(name, n, t) for (name, n), t in zip(order, out, strict=True)]


@dataclass
class Mix:
    """``documents``: a row for each input row, with size, source_size, target, taken, and ``slots``, the first slot of each
    of its passes (empty if none is taken). ``schedule``: a row for each piece of a document in a slot of the mix: slot,
    source, block, the key, first word and words."""

    documents: DataFrame
    schedule: DataFrame


def _offset(df: DataFrame, by: list[str], place: str, value: Column) -> DataFrame:
    """For each ``by`` and ``place`` the sum of ``value`` over all smaller places; one row per place comes in."""
    sums = df.groupBy(*by, place).agg(F.sum(value).alias("_here"))
    w = Window.partitionBy(*by).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*by, place, F.coalesce(F.sum("_here").over(w), F.lit(0)).cast("long").alias("_before"))


def mix(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
    block_words: int = 4096,
    least_slots: int = 20_000,
) -> Mix:
    """Mix all documents; see ``Mix`` for the result.

    Null text has size 0 and is never taken, null is a source like any other (the last), equal keys are ordered by their
    text and repeated rows count as so many documents; texts of any length count whole; an empty table gives empty
    results; no other column is read. Of each source the blocks that have a slot
    are taken, which are all of its target, to the nearest word. Blocks hold ``block_words`` words, fewer where the whole
    mix would otherwise have under ``least_slots`` blocks. Reruns agree: the order is that of a seeded hash of the key.

    The table of sources (one row each, about 50 bytes) passes through the driver: it is bounded by their number, not by
    the documents, and is broadcast up to 100,000 sources, beyond that joined by shuffle.
    """
    spark = docs.sparkSession
    sized = docs.select(
        F.col(key).alias("_key"),
        F.col(source).alias("_source"),
        words(text).alias("size"),
        F.xxhash64(F.lit(seed), F.col(key)).alias("_place"),
        F.xxhash64(text).alias("_tie"),
    )
    sized = materialize(sized)  # a few numbers a row; the texts are read once
    per_source = sized.groupBy("_source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()
    plan = targets([(r["_source"], r["n"]) for r in per_source], weights=weights, share=share, most=most)
    small = F.broadcast if len(plan) <= _BROADCAST else lambda df: df  # a few rows for each source
    total = sum(t.target for t in plan)
    block = max(1, min(block_words, int(total // least_slots)))
    goals = [min(int(t.target + 0.5), int(most * t.size)) for t in plan]
    counts = [-(-goal // block) for goal in goals]
    n_blocks = sum(counts)
    slots = 2 * n_blocks + 2
    kind = docs.schema[source].dataType.simpleString()
    sources = [(i, t.source, t.size, t.target, *x) for i, (t, *x) in enumerate(zip(plan, goals, counts, strict=True))]
    table = small_table(spark, sources, f"_s int, _source {kind}, source_size long, target double, _goal long, _count long")

    # the source's stream: rows by hashed place; running sums within hash buckets
    buckets = 1 << max(0, math.ceil(math.log2(max(1, sum(r["rows"] for r in per_source)) / _PER_BUCKET)))
    bucket = F.shiftrightunsigned("_place", 64 - int(math.log2(buckets))) if buckets > 1 else F.lit(0).cast("long")
    at = Window.partitionBy("_s", "_bucket").orderBy("_upper", "_place", "_key", "_tie")
    # unsigned order of the place within a bucket: its sign bit is part of the bucket, or compared first
    rows = sized.join(small(table), sized["_source"].eqNullSafe(table["_source"])).drop(table["_source"])
    rows = rows.withColumns({"_bucket": bucket, "_upper": (F.col("_place") < 0).cast("int")})
    inner = rows.withColumns({"_row": F.row_number().over(at), "_sum": F.sum("size").over(at.rowsBetween(Window.unboundedPreceding, -1))})
    start = F.col("_before") + F.coalesce(F.col("_sum"), F.lit(0))
    placed = inner.join(_offset(rows, ["_s"], "_bucket", F.col("size")), ["_s", "_bucket"]).withColumn("_start", start)

    # pieces of each pass: the words that a document has in each block of its source's repeated stream, up to the target
    passes = math.ceil(most)
    repeated = placed.where("size > 0").withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))).withColumn(
        "_a", F.col("_start") + F.col("_pass") * F.col("source_size")
    )
    wanted = repeated.where("_a < _goal").withColumn("_e", F.least(F.col("_a") + F.col("size"), F.col("_goal")))
    pieces = wanted.withColumn("block", F.explode(F.expr(f"sequence(_a div {block}L, (_e - 1) div {block}L)")))
    lo, hi = F.greatest(F.col("_a"), F.col("block") * block), F.least(F.col("_e"), (F.col("block") + 1) * block)
    pieces = pieces.select(
        "_s", "_bucket", "_row", F.col("_key"), "block", (lo - F.col("_a")).alias("first_word"), (hi - lo).alias("words"), "_pass"
    )

    # slots: golden-ratio points through the cumulative numbers of blocks, ranked in their source by segment
    points = spark.range(slots).select(
        F.col("id").alias("slot"),
        (
            F.pmod(
                F.col("id").cast("decimal(20,0)") * F.lit(_GOLDEN).cast("decimal(18,0)"), F.lit(1 << 53).cast("decimal(18,0)")
            ).cast("double") / float(1 << 53)
        ).alias("_u"),
    )
    cells, before, ranges = len(plan), 0, []
    for i, n in enumerate(counts):
        low, high = before / max(1, n_blocks), (before + n) / max(1, n_blocks)
        ranges += [(cell, i, low, high) for cell in range(int(low * cells), int(high * cells) + 1) if n]
        before += n
    intervals = small_table(spark, ranges, "_cell int, _s int, _from double, _to double")
    near = points.withColumn("_cell", F.floor(F.col("_u") * cells).cast("int")).join(small(intervals), "_cell")
    hit = near.where((F.col("_u") >= F.col("_from")) & (F.col("_u") < F.col("_to"))).select(
        "slot", "_s", F.expr(f"slot div {_PER_BUCKET}").alias("_segment")
    )
    rank = F.row_number().over(Window.partitionBy("_s", "_segment").orderBy("slot"))
    ranked = hit.withColumn("_rank", rank).join(_offset(hit, ["_s"], "_segment", F.lit(1)), ["_s", "_segment"]).select(
        "slot", "_s", (F.col("_before") + F.col("_rank") - 1).alias("_rank")
    )
    # a source's slots beyond its blocks stay empty
    used = ranked.join(small(table.select("_s", "_count")), "_s").where("_rank < _count").select("slot", "_s", F.col("_rank").alias("block"))

    joined = pieces.join(used, ["_s", "block"])
    schedule = joined.join(small(table.select("_s", F.col("_source").alias("source"))), "_s").select(
        "slot", "source", "block", F.col("_key").alias(key), F.col("_pass").alias("pass"), "first_word", "words"
    )
    first = [F.min(F.when(F.col("_pass") == i, F.col("slot"))) for i in range(passes)]
    taken = joined.groupBy("_s", "_bucket", "_row").agg(F.sum("words").alias("_taken"), F.array_compact(F.array(*first)).alias("_slots"))
    documents = placed.join(taken, ["_s", "_bucket", "_row"], "left").select(
        F.col("_key").alias(key),
        "size",
        "source_size",
        "target",
        F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("_slots", F.array().cast("array<long>")).alias("slots"),
        F.col("_tie"),
    )
    return Mix(documents, schedule)
