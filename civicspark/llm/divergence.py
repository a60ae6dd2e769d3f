"""How far the vocabularies of sources stand apart: counts of terms as run-length columns.

The counts of a term in all sources of its language are its profile. Terms of equal profiles are one entry with a number of
terms, and entries are sorted by profile, so that equal counts of a source stand together. The order is cut into blocks; in
each block the column of a source is a list of runs. For a pair of sources the run boundaries are intersected: within each
piece both counts are the same, so that its contribution is computed once and multiplied by the number of terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import materialize, tidy, tidy_groups
from .kernels import slices, utf8, words

_GAP = np.ones(256, bool)
_GAP[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
#: Entries of a term table that a task gathers, and counts (of profiles) in a block.
_TABLE, _BLOCK = 1 << 19, 1 << 19
SCALE = 1_000_000_000


def term_counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs`` (rows that hold it); nulls are ''.

    Each task adds up before the shuffle. A group without terms has no row here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            keys = [batch.column(i).cast(pa.large_string()).dictionary_encode() for i in (0, 1)]
            lang_at, source_at = (k.indices.to_numpy().astype(np.int64) for k in keys)
            group = lang_at * len(keys[1].dictionary) + source_at
            for lo, hi in slices(offsets):
                distinct, word, _, rows = words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], _GAP)
                if not len(word):
                    continue
                row = np.repeat(np.arange(hi - lo), np.diff(rows))
                in_row, times = np.unique(row * len(distinct) + word, return_counts=True)
                pair = group[lo:hi][in_row // len(distinct)] * len(distinct) + in_row % len(distinct)
                pairs, place = np.unique(pair, return_inverse=True)
                of = pairs // len(distinct)
                held.append(
                    pa.table(
                        {
                            "lang": keys[0].dictionary.take(of // len(keys[1].dictionary)),
                            "source": keys[1].dictionary.take(of % len(keys[1].dictionary)),
                            "term": distinct.take(pairs % len(distinct)),
                            "n": np.bincount(place, weights=times).astype(np.int64),
                            "docs": np.bincount(place),
                        }
                    )
                )
                size += len(pairs)
                if size >= _TABLE:
                    held = [_added(held)]
                    size = held[0].num_rows
                    if size >= _TABLE // 2:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from _added(held).to_batches()

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    found = docs.select(empty(lang), empty(source), text).mapInArrow(tidy(run), "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _added(tables: list[pa.Table]) -> pa.Table:
    kind = pa.schema([*[(c, pa.string()) for c in ("lang", "source", "term")], ("n", pa.int64()), ("docs", pa.int64())])
    found = pa.concat_tables(t.cast(kind) for t in tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return found.rename_columns(kind.names).cast(kind)


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (count + 1) / (total + terms)), exactly; null without terms."""
    wide = lambda c: c.cast("decimal(38,0)")
    over = F.call_function("div", wide(F.lit(SCALE)) * wide(count + 1), wide(total + terms))
    return F.when(terms > 0, 1 + over)


def run_lengths(counts: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal counts begin, in terms, and their counts. ``terms`` are those of each entry."""
    if not len(counts):
        return np.zeros(0, np.int64), counts
    first = np.flatnonzero(np.concatenate([[True], counts[1:] != counts[:-1]]))
    return (np.cumsum(terms) - terms)[first], counts[first]


def intersect(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces in which neither column changes: the value of each and the number of terms."""
    bounds = np.union1d(a[0], b[0])
    at = lambda c: c[1][np.searchsorted(c[0], bounds, side="right") - 1]
    return at(a), at(b), np.diff(np.concatenate([bounds, [end]]))


def _parted(table: pa.Table, heads: pa.Table) -> pa.Table:
    """Of a block: for each ordered pair of its language's sources (by number) the sum of f over the block's terms.

    p of a run is that of its count, so it is worked out once a run. Sums of p over a vocabulary of V terms are at most
    10**9 + V, so a sum of p * p / q stays below 2**63 for up to two billion terms, and (p - q)**2 below 2 * 10**18.
    """
    kinds = pa.schema([("lang", pa.string()), ("s", pa.int64()), ("t", pa.int64()), ("value", pa.int64())])
    lang, sizes = table.column("lang")[0].as_py(), heads.column("all")[0].as_py()
    profiles, terms = table.column("held").combine_chunks(), table.column("terms").to_numpy()
    order = np.argsort(table.column("place").to_numpy())
    entries = profiles.flatten()
    at = np.repeat(np.arange(len(profiles)), profiles.value_lengths().to_numpy())
    known = pa.array([x["source"] for x in sizes], entries.field(0).type)
    source = pc.index_in(entries.field(0), value_set=known).to_numpy().astype(np.int64)
    count = entries.field(1).to_numpy()
    by = np.argsort(source, kind="stable")
    at, source, count = at[by], source[by], count[by]
    edges = np.searchsorted(source, np.arange(len(sizes) + 1))
    spans = terms[order]
    columns = []
    for s, size in enumerate(sizes):
        dense = np.zeros(len(profiles), np.int64)
        dense[at[edges[s] : edges[s + 1]]] = count[edges[s] : edges[s + 1]]
        starts, values = run_lengths(dense[order], spans)
        distinct, place = np.unique(values, return_inverse=True)
        below = size["total"] + size["terms"]
        columns.append((starts, np.array([1 + SCALE * (int(c) + 1) // below for c in distinct], np.int64)[place]))
    end, out = int(spans.sum()), []
    for s, a in enumerate(columns):
        for t in range(s):
            p, q, length = intersect(a, columns[t], end)
            square = (p - q) * (p - q)
            out += [(lang, s, t, int((square // q * length).sum())), (lang, t, s, int((square // p * length).sum()))]
    return pa.table([pa.array([r[i] for r in out], f.type) for i, f in enumerate(kinds)], schema=kinds)


def audit(docs: DataFrame, *, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank`` of every group of a language and a source.

    Terms are runs of letters A-Z, lower-cased, and of characters beyond ASCII; a language keeps those that ``min_docs`` of
    its rows hold. p of a kept term in a group is 1 + floor(10**9 * (count + 1) / (N + V)), with N the group's kept
    occurrences and V the language's kept terms, and f = floor((p - q)**2 / q). Part ``pair`` has every other source of the
    language with the sum of f over all kept terms, q being its p; part ``term`` the ``top`` terms with a count in the group
    and a p above q, that of the whole language. Ranks go by value, then by the item's bytes.

    Null texts, languages and sources are '' (together with empty ones); repeated rows count as often as they stand there;
    a group without terms takes part with counts of 0, and where a language keeps no term all its pairs have the value 0. A
    lone source has no pair. An empty table gives no rows; no other column is read.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    counts = term_counts(docs, lang, source, text)
    entry = F.struct("source", "n")
    # an entry for each source of a term's language at most
    held = F.array_sort(F.collect_list(entry)).alias("held")
    found = counts.groupBy("lang", "term").agg(held, F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    kept = materialize(found.where(F.col("docs") >= min_docs).drop("docs"))
    each = kept.select("lang", "term", F.col("n").alias("all"), F.explode("held").alias("e")).select("lang", "term", "all", "e.source", "e.n")
    whole = kept.groupBy("lang").agg(F.sum("n").alias("whole"), F.count("*").alias("terms"))
    groups = materialize(
        docs.select(empty(lang).alias("lang"), empty(source).alias("source")).distinct()
        .join(each.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(whole, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "whole", "terms")])
    )

    # the sources of each language in order
    numbered = groups.withColumn("s", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    sources = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "total", "terms"))).alias("all"))
    profiles = kept.groupBy("lang", "held").agg(F.count("*").alias("terms"))
    # the order of profiles in ranges, and these in blocks of about so many counts
    entries = each.count()
    ordered = profiles.repartitionByRange(1 + entries // _BLOCK, "lang", "held").sortWithinPartitions("lang", "held")
    placed = materialize(ordered.withColumn("place", F.monotonically_increasing_id()).withColumn("range", F.spark_partition_id()))
    wide = placed.groupBy("lang", "range").agg(F.avg(F.size("held")).alias("mean"), F.min("place").alias("least"))
    block = F.floor((F.col("place") - F.col("least")) * F.col("mean") / _BLOCK).alias("block")
    blocks = placed.join(wide, ["lang", "range"]).select("lang", "range", block, "place", "held", "terms")
    by = ["lang", "range", "block"]
    of_block = blocks.select([F.col(c).alias(f"_{c}") for c in by]).distinct()
    heads = of_block.join(sources, F.col("_lang") == F.col("lang")).drop("lang")  # a row for each block, not for each profile
    sums = blocks.groupBy(by).cogroup(heads.groupBy([f"_{c}" for c in by])).applyInArrow(tidy_groups(_parted), "lang string, s long, t long, value long")
    sums = sums.groupBy("lang", "s", "t").agg(F.sum("value").alias("value"))

    other = numbered.select("lang", F.col("s").alias("t"), F.col("source").alias("item"))
    pairs = numbered.join(other, "lang").where("s <> t").join(sums, ["lang", "s", "t"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value")
    )
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("all"), F.col("whole"), F.col("terms"))
    apart = each.join(groups, ["lang", "source"]).select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q")
    value = F.expr("((p - q) * (p - q)) div q")
    terms = apart.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    return pairs.withColumn("rank", rank).union(terms.withColumn("rank", rank).where(F.col("rank") <= top))
