"""Exact top-k inner-product search by MaxScore over shards.

Components are terms: a vector's posting of a term is its component, and a term's bound in a shard is the most that it
can add to a query's score there. For each query and shard the terms are ordered by bound; those whose bounds together
stay under what the best five candidates so far have reached are non-essential. Essential postings are traversed for the
whole shard at once, and the others are probed, largest bound first, for the vectors that can still compete. Shards
merge by score.

Vectors are dealt to lanes and packed into shards, queries to groups of packed blocks. One task scores one lane for one
group: every query's threshold holds over all shards of the lane, no pair of rows is ever joined, and memory is a lane
and a group, whatever the tables' size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import partitions, tidy, tidy_groups


def scaled(vector: Column, scale: int) -> Column:
    """Integer components, floor(scale * x); null where the vector or a component is null or a component isn't finite."""
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, ints)


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of numbers as a matrix; missing last components are 0."""
    length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), length)
    place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
    matrix = np.zeros((len(lists), int(length.max(initial=0))))
    matrix[row, place] = lists.flatten().to_numpy(zero_copy_only=False)
    return matrix


def _pack(rows: DataFrame, group: str, groups: int, size: int) -> DataFrame:
    """Distinct rows of (k long, v array<double>), dealt to ``groups`` numbered groups and packed there into matrices of
    at most ``size`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            for g in np.unique(at).tolist():
                own = batch.filter(pa.array(at == g)) if g != at[0] or g != at[-1] else batch
                step = -(-own.num_rows // -(-own.num_rows // size))
                for start in range(0, own.num_rows, step):
                    part = own.slice(start, step)
                    matrix = _matrix(part.column(1))
                    kind = np.float32 if np.abs(matrix).max(initial=0) < 1 << 24 else np.float64
                    packed = [part.column(0).to_numpy().tobytes(), matrix.astype(kind).tobytes()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([g], pa.int32()),
                            *[pa.array([x], pa.binary()) for x in packed],
                            pa.array([matrix.shape[1]], pa.int32()),
                            pa.array([kind == np.float32]),
                        ],
                        names=[group, "keys", "matrix", "width", "single"],
                    )

    dealt = rows.dropDuplicates(["k", "v"]).withColumn(
        "g", F.pmod(F.xxhash64("k", "v"), F.lit(groups)).cast("int")
    ).repartition(groups, "g")
    return dealt.mapInArrow(tidy(run), f"{group} int, keys binary, matrix binary, width int, single boolean")


def _unpack(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and matrix of each packed row, by first key, whatever order the shuffle brought."""
    found = []
    for keys, matrix, width, single in zip(*[table.column(c) for c in ("keys", "matrix", "width", "single")], strict=True):
        keys = np.frombuffer(keys.as_py(), np.int64)
        found.append((keys, np.frombuffer(matrix.as_py(), np.float32 if single.as_py() else np.float64).reshape(len(keys), width.as_py())))
    yield from sorted(found, key=lambda x: int(x[0][0]))


class TopK:
    """The best ``k`` of each query so far, by score and then by smaller key."""

    def __init__(self, k: int):
        self.k = k
        self.best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def threshold(self, query: int) -> float:
        got = self.best.get(query)
        return float(got[0][-1]) if got is not None and len(got[0]) == self.k else -np.inf

    def offer(self, query: int, scores: np.ndarray, keys: np.ndarray) -> None:
        if query in self.best:
            scores, keys = np.concatenate([self.best[query][0], scores]), np.concatenate([self.best[query][1], keys])
        order = np.lexsort((keys, -scores))
        once = np.sort(np.unique(keys[order], return_index=True)[1])[: self.k]  # of a repeated key its best score
        self.best[query] = scores[order][once], keys[order][once]


def maxscore(
    query: np.ndarray, shard: np.ndarray, high: np.ndarray, low: np.ndarray, threshold: float, probe: int = 8
) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a shard whose score may reach ``threshold``, and their exact scores.

    ``high`` and ``low`` hold the greatest and least component of each term in the shard.
    """
    bound = np.maximum(query * high, query * low)
    order = np.argsort(bound, kind="stable")
    after = np.cumsum(bound[order])  # the most that the first terms of the order add together
    split = int(np.searchsorted(np.maximum.accumulate(after), threshold, side="left")) if np.isfinite(threshold) else 0
    essential, rest = order[split:], order[:split][::-1]
    partial = shard[:, essential] @ query[essential]
    rows = np.arange(len(shard))
    for at in range(0, len(rest) + 1, probe):
        left = rest[at:]
        keep = partial + bound[left].sum() >= threshold
        if not keep.all():
            rows, partial = rows[keep], partial[keep]
        if not len(left) or not len(rows):
            break
        terms = left[:probe]
        partial = partial + shard[np.ix_(rows, terms)] @ query[terms]
    return rows, partial


def score(shards: pa.Table, blocks: pa.Table, k: int, seed_rows: int = 64) -> tuple[TopK, int]:
    """The best of all packed ``shards`` for each query of the packed ``blocks``, and the number of scores that were completed.

    The shards of a block come one after the other, so that what the first ones have reached bounds the later ones.
    """
    top, completed = TopK(k), 0
    lane = [(ids, shard, len(np.unique(ids)) == len(ids)) for ids, shard in _unpack(shards)]
    for asked, queries in _unpack(blocks):
        for ids, shard, distinct in lane:
            width = max(shard.shape[1], queries.shape[1])
            wide, block = [m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (shard, queries)]
            high, low = wide.max(axis=0), wide.min(axis=0)
            # float32 holds whole numbers below 2**24
            reach = np.abs(np.maximum(high, -low)) @ np.abs(block).max(axis=0).astype(np.float64)
            if reach >= 1 << 24:
                wide, block, high, low = (m.astype(np.float64) for m in (wide, block, high, low))
            for own, query in zip(asked.tolist(), block, strict=True):
                if own not in top.best:  # a first threshold from a few rows
                    few = np.flatnonzero(ids[:seed_rows] != own)
                    top.offer(own, (wide[few] @ query).astype(np.float64), ids[few])
                rows, scores = maxscore(query, wide, high, low, top.threshold(own))
                completed += len(rows)
                keep = ids[rows] != own
                scores, rows = scores[keep].astype(np.float64), rows[keep]
                if len(rows):
                    # the k-th best row is no bound where a key stands in several
                    if len(rows) > 4 * k and distinct:
                        cutoff = np.partition(scores, -k)[-k]
                        scores, rows = scores[scores >= cutoff], rows[scores >= cutoff]
                    top.offer(own, scores, ids[rows])
    return top, completed


def search(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 5,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = 4096,
    lane_rows: int = 1 << 17,
    block_rows: int = 2048,
    group_rows: int = 1 << 15,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), the neighbour's ``key`` and ``score``, an exact integer inner product.

    Every row of ``vectors`` but those with the query's own key is a candidate. Vectors that are null or hold a null or
    non-finite component take no part, as query or candidate, nor do null keys; missing last components count as 0, so
    that vectors may have any length; ties go to the smaller key; a query with fewer candidates than ``k`` gets all. A
    key that stands in several rows counts once, with the best score of these rows, as a query too. Empty tables give no
    rows and no other column is read. Scores are exact below 2**53.

    Vectors are dealt to lanes of about ``lane_rows`` rows and queries to groups of about ``group_rows``; each lane scores
    each group in a task of its own, which gives ``k`` rows a query.
    """
    spark = vectors.sparkSession
    candidates, asked = _ready(vectors, key, vector, scale), _ready(queries, key, vector, scale)
    lanes = max(partitions(spark), -(-vectors.count() // lane_rows))
    groups = max(1, -(-asked.count() // group_rows))
    shards = _pack(candidates, "lane", lanes, shard_rows).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    blocks = _pack(asked, "group", groups, block_rows).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        top, _ = score(left, right, k)
        rows = [(q, int(i), int(s)) for q, (scores, ids) in top.best.items() for s, i in zip(scores, ids, strict=True)]
        return pa.table({n: pa.array([r[j] for r in rows], pa.int64()) for j, n in enumerate(("query_id", key, "score"))})

    found = shards.groupBy("lane", "group").cogroup(blocks.groupBy("lane", "group")).applyInArrow(
        tidy_groups(run), f"query_id long, `{key}` long, score long"
    )
    best = found.groupBy("query_id", key).agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", key, "score")


def _ready(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("k"), scaled(F.col(vector), scale).alias("v")).where("k is not null and v is not null")
