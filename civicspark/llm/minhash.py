"""Near copies by MinHash: banded candidates, sequential Bayesian verification of signatures, exact confirmation.

Documents with equal shingle sets form one class and stand for one node. A node's signature is the least value of its
shingles under each of ``ROWS * BANDS`` hash functions; nodes that agree in all rows of a band meet in a bucket. Candidates
compare their signatures, a byte of each value, batch by batch. After each batch the posterior of their similarity is known
from the number of agreements, and a pair is given up as soon as the similarity reaches the threshold with a probability
below ``MISS``. Survivors whose parity bitmaps differ in more bits than sets that link can in shingles go too, and the rest
is confirmed on whole shingle sets.

Links matter as far as they connect: in each bucket nodes are first tried against centres, and what still stands apart is
compared in blocks of bounded size, of which survivors alone come out. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import discard, materialize, tidy, tidy_group
from .kernels import mix, shingle_sets, slices, utf8
from .ngram_join import _keys, components

#: A pair at the threshold of 0.8 misses all bands with a probability of (1 - 0.8**4)**32, about 5 in 10**8.
ROWS, BANDS = 4, 32
#: Signature values of a batch, and the posterior probability below which a pair is given up.
BATCH, MISS = 16, 1e-7
#: Bits of a parity bitmap, 64 a word: one is on if an odd number of shingles hits it.
_BITS = 1024
#: Rounds against centres; parts that a bucket's nodes are dealt to; nodes of a block in one task. None changes the result.
_ROUNDS, _PARTS, _BLOCK = 3, 8, 1024
#: Nodes of a bucket up to which pairs are formed by a join, at most half of this squared.
_FEW = 32
#: Nodes whose names, 8 bytes each, are broadcast; more are joined by shuffle.
_BROADCAST = 1 << 20


def _factors(n: int) -> np.ndarray:
    """Odd multipliers, one for each hash function."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signatures(values: np.ndarray, at: np.ndarray, n: int = ROWS * BANDS) -> np.ndarray:
    """The least value of each row's shingles under ``n`` hash functions; rows have shingles."""
    out, room = np.empty((len(at) - 1, n), np.uint64), np.empty_like(values)
    if not len(out):
        return out
    for i, factor in enumerate(_factors(n)):
        out[:, i] = np.minimum.reduceat(np.multiply(values, factor, out=room), at[:-1])
    return mix(out)


@cache
def least_agreements(percent: int, n: int = ROWS * BANDS, batch: int = BATCH, miss: float = MISS) -> tuple[int, ...]:
    """The number of agreements after each batch below which a pair is given up.

    Values of a byte agree with the probability p = s + (1 - s) / 256 for sets of similarity s. With a uniform prior of p
    on [1 / 256, 1] the posterior after m agreements in k values is a truncated Beta(m + 1, k - m + 1), whose upper tails
    are binomial sums: P(p >= t) = P(Bin(k + 1, t) <= m). They are summed exactly.
    """

    def below(k: int, m: int, t: Fraction) -> Fraction:
        return sum((comb(k + 1, i) * t**i * (1 - t) ** (k + 1 - i) for i in range(m + 1)), Fraction(0))

    s = Fraction(percent, 100)
    threshold, floor = s + (1 - s) / 256, Fraction(1, 256)
    out = []
    for k in range(batch, n + 1, batch):
        m = next(m for m in range(k + 1) if below(k, m, threshold) >= Fraction(miss) * below(k, m, floor))
        out.append(m)
    return tuple(out)


def survive(a: np.ndarray, b: np.ndarray, least: tuple[int, ...], batch: int = BATCH) -> np.ndarray:
    """Of pairs of signatures, a row each: the places of those that no batch gives up."""
    alive, agree = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i, needed in enumerate(least):
        part = slice(i * batch, (i + 1) * batch)
        agree = agree + (a[alive, part] == b[alive, part]).sum(axis=1)
        keep = agree >= needed
        alive, agree = alive[keep], agree[keep]
        if not len(alive):
            break
    return alive


def bitmaps(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The parity bitmap of each row's shingles as bytes: two sets differ in at least as many shingles as bitmaps in bits."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    hits = np.bincount(row * _BITS + (mix(values) % np.uint64(_BITS)).astype(np.int64), minlength=(len(at) - 1) * _BITS)
    return np.packbits((hits % 2).astype(np.uint8).reshape(-1, _BITS), axis=1)


def may_link(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """The places of pairs of sketches, a row each, that no batch gives up and whose bitmaps allow a link."""
    alive = survive(a, b, least_agreements(percent))
    words = [np.ascontiguousarray(x[alive][:, ROWS * BANDS :]).view(np.uint64) for x in (a, b)]
    differ = np.bitwise_count(words[0] ^ words[1]).sum(axis=1).astype(np.int64)
    n_a, n_b = (np.broadcast_to(n, len(a))[alive].astype(np.int64) for n in (n_a, n_b))
    return alive[(100 + percent) * differ <= (100 - percent) * (n_a + n_b)]


def _signed(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``_k``, ``n``, ``node``, the name of the shingle set, and the text's hash of each row; the first row of a node in a
    task also has its sketch, which is a byte of each signature value and the bitmap, and the values of its bands."""
    frame = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.xxhash64(text).alias("hash"))
    kind = frame.schema["_k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(0, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in slices(offsets):
                values, at = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], words)
                names, n = _keys(values, at), np.diff(at)
                _, first = np.unique(names, return_index=True)
                new = np.zeros(len(n), bool)
                new[first] = True
                new &= ~np.isin(names, met) & (n > 0)
                met = np.concatenate([met, names[new]])
                # the sets of new rows, one after the other
                held = values[np.repeat(new, n)]
                starts = np.concatenate([[0], np.cumsum(n[new])])
                signed = signatures(held, starts)
                sketch = np.concatenate([signed.astype(np.uint8), bitmaps(held, starts)], axis=1)
                bands = np.zeros((len(signed), BANDS), np.uint64)
                for i in range(ROWS):
                    bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + signed[:, i::ROWS])
                bands ^= np.arange(BANDS, dtype=np.uint64) << np.uint64(56)  # a value of another band is another bucket
                at_new = np.where(new, np.cumsum(new) - 1, -1).tolist()
                starts = np.concatenate([[0], np.cumsum(new * BANDS)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(n),
                        pa.array(names, mask=n == 0),
                        pa.array([sketch[i].tobytes() if i >= 0 else None for i in at_new], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(starts), pa.array(bands.view(np.int64).reshape(-1)), mask=pa.array(~new)),
                        batch.column(2).slice(lo, hi - lo),
                    ],
                    names=["_k", "n", "node", "sketch", "bands", "hash"],
                )

    return frame.mapInArrow(tidy(run), f"_k {kind}, n long, node long, sketch binary, bands array<long>, hash long")


def _torn(rows: DataFrame) -> DataFrame:
    """The rows of buckets whose nodes stand in different components."""
    torn = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    parts = torn.withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(_PARTS)])))
    return _parted(rows).join(parts, ["bucket", "part"], "left_semi").drop("part")


def _parted(rows: DataFrame) -> DataFrame:
    """Rows with a part of their bucket, so that those of a frequent one are in several tasks."""
    return rows.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(_PARTS)).cast("int"))


def _pairs(rows: DataFrame, a: str, b: str, percent: int) -> DataFrame:
    """Distinct pairs of different components whose sizes allow the threshold, the lesser node first."""
    n_a, n_b = f"{a}.n", f"{b}.n"
    fit = rows.where(f"{a}.comp <> {b}.comp").where(100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))
    return fit.select(F.least(f"{a}.node", f"{b}.node").alias("a"), F.greatest(f"{a}.node", f"{b}.node").alias("b")).distinct()


def _centred(rows: DataFrame, order: Column, percent: int) -> DataFrame:
    """Pairs of nodes with the node of their bucket's part that is first in ``order``, and of these with the bucket's first."""
    parted = _parted(rows).select("bucket", "part", F.struct("node", "n", "comp").alias("x"), order.alias("o"))
    centres = parted.groupBy("bucket", "part").agg(F.min(F.struct("o", "x")).alias("c"))
    near = parted.join(centres, ["bucket", "part"]).select("x", F.col("c.x").alias("y"))
    heads = centres.groupBy("bucket").agg(F.min("c").alias("c"), F.collect_list("c").alias("all"))  # an entry for each part
    apart = heads.select(F.col("c.x").alias("y"), F.explode("all").alias("of")).select(F.col("of.x").alias("x"), "y")
    return _pairs(near.union(apart), "x", "y", percent)


def _blocks(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Of two parts of a bucket: the pairs of different components that may link."""

    def run(table: pa.Table) -> pa.Table:
        left = table.column("left").to_numpy(zero_copy_only=False)
        node, n, comp = (table.column(c).to_numpy() for c in ("node", "n", "comp"))
        signed = np.frombuffer(b"".join(x.as_py() for x in table.column("sketch")), np.uint8).reshape(len(node), -1)
        same = bool(table.column("same")[0].as_py())
        rows, columns = (np.arange(len(node)),) * 2 if same else (np.flatnonzero(left), np.flatnonzero(~left))
        a, b = [], []
        for i in rows.tolist():
            with_ = columns[columns > i] if same else columns
            with_ = with_[(comp[with_] != comp[i]) & (100 * np.minimum(n[with_], n[i]) >= percent * np.maximum(n[with_], n[i]))]
            found = with_[may_link(np.broadcast_to(signed[i], (len(with_), signed.shape[1])), n[i], signed[with_], n[with_], percent)]
            a.append(np.minimum(node[found], node[i]))
            b.append(np.maximum(node[found], node[i]))
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})

    return run


def _apart(rows: DataFrame, signed: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """All pairs of torn buckets that may link: of small buckets as such, of larger ones those that signatures leave."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("m"))
    few = rows.join(sizes.where(F.col("m") <= _FEW), "bucket").select("bucket", F.struct("node", "n", "comp").alias("x"))
    small = _pairs(few.join(few.select("bucket", F.col("x").alias("y")), "bucket").where("x.node < y.node"), "x", "y", percent)
    # a bucket of m nodes has m / _BLOCK parts, and a block for every two of them
    parts = F.ceil(F.col("m") / _BLOCK).cast("int")
    many = rows.join(sizes.where(F.col("m") > _FEW), "bucket").join(signed, "node")
    dealt = many.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
    copies = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = copies.select(
        "bucket", F.least("part", "with").alias("i"), F.greatest("part", "with").alias("j"), (F.col("part") <= F.col("with")).alias("left"),
        (F.col("part") == F.col("with")).alias("same"), "node", "n", "comp", "sketch",
    )
    return small, tiles.groupBy("bucket", "i", "j").applyInArrow(tidy_group(_blocks(percent)), "a long, b long").distinct()


def _surviving(pairs: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches may link."""
    one = lambda k: signed.select(F.col("node").alias(k), F.col("sketch").alias(f"sketch_{k}"), F.col("n").alias(f"n_{k}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(x.as_py() for x in batch.column(i)), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                n_a, n_b = (batch.column(i).to_numpy() for i in (4, 5))
                yield batch.select([0, 1]).take(pa.array(may_link(a, n_a, b, n_b, percent)))

    joined = pairs.join(one("a"), "a").join(one("b"), "b").select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b")
    return joined.mapInArrow(tidy(run), "a long, b long")


def _whole_sets(docs: DataFrame, text: str, words: int, wanted: DataFrame) -> DataFrame:
    """``node`` and ``items``, its whole set, of the wanted nodes, a written table; ``wanted`` has the hash of a text of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for lo, hi in slices(offsets):
                values, at = shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], words)
                items = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(_keys(values, at)), items], names=["node", "items"])

    hashes = wanted.select("hash").distinct()
    hashes = F.broadcast(hashes) if wanted.count() <= _BROADCAST else hashes
    texts = docs.select(F.col(text).alias("text")).join(hashes, F.xxhash64("text") == F.col("hash"), "left_semi").dropDuplicates(["text"])
    found = texts.mapInArrow(tidy(run), "node long, items array<long>")
    return materialize(found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold, a written table."""
    one = lambda k: sets.select(F.col("node").alias(k), F.col("items").alias(f"items_{k}"))
    both = F.size(F.array_intersect("items_a", "items_b"))
    joined = pairs.join(one("a"), "a").join(one("b"), "b").select(
        "a", "b", both.alias("both"), (F.size("items_a") + F.size("items_b")).alias("all")
    )
    return materialize(joined.where(100 * F.col("both") >= percent * (F.col("all") - F.col("both"))).select("a", "b"))


def near_copies(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (the smallest key that links reach) and ``kept`` (the key is that) of every row.

    Words are split at ASCII white space, A-Z lower-cased; a text with fewer words than a shingle has one, of all its
    words; one without words, or null, has none, and is linked with nothing: its component is its own key. Rows link when
    100 * overlap >= ``percent`` * union, which is confirmed on whole sets; a link at the threshold is missed by all bands or
    given up by a batch about once in ten million pairs, and a component is only torn if all its links there are.

    Repeated rows are one class and have the same result; null keys are never a component's smallest, and where all keys of a
    component are null its id is null and the rows are kept; an empty table gives no rows; no other column is read, and
    texts of any length count whole. Sets are named by 64 bits, shingles are 64-bit hashes.
    """
    named = materialize(_signed(docs, key, text, words))
    classes = named.where("node IS NOT NULL").groupBy("node", "n").agg(F.min("_k").alias("first"))
    signed = materialize(named.where("sketch IS NOT NULL").drop("_k").dropDuplicates(["node"]))
    buckets = signed.select("node", F.col("n").cast("int").alias("n"), F.explode("bands").alias("bucket"), F.col("node").alias("comp"))
    rows = materialize(_torn(buckets))
    # the nodes that share a bucket, and their whole sets
    shared = materialize(signed.select("node", "n", "sketch", "hash").join(rows.select("node").distinct(), "node", "left_semi"))
    sets = _whole_sets(docs, text, words, shared)
    used = [signed, shared, sets, rows]

    comps = links = None
    for turn in range(_ROUNDS):
        if turn:
            rows = materialize(_torn(rows.drop("comp").join(comps, "node")))
            used.append(rows)
            if rows.isEmpty():
                break
            used.append(comps)
        pairs = _centred(rows, F.xxhash64(F.lit(turn), F.col("node")), percent)
        found = _confirmed(_surviving(pairs, shared, percent), sets, percent)
        used.append(found)
        links = links.union(found) if turn else found
        comps = components(shared, links)
    else:  # some buckets may still hold different components
        rows = materialize(_torn(rows.drop("comp").join(comps, "node")))
        small, large = _apart(rows, shared.select("node", "sketch"), percent)
        found = _confirmed(_surviving(small, shared, percent).union(large).distinct(), sets, percent)
        used += [rows, found]
        if not found.isEmpty():
            used.append(comps)
            comps = components(shared, links.union(found))
    discard(*used)

    member = classes.join(comps, "node", "left").select("node", "first", F.coalesce("comp", "node").alias("comp"))
    least = member.groupBy("comp").agg(F.min("first").alias("least"))
    merged = member.join(least, "comp").select("node", "least")
    component = F.when(F.col("node").isNull(), F.col("_k")).otherwise(F.col("least"))
    return named.join(merged, "node", "left").select(
        F.col("_k").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("_k").eqNullSafe(component).alias("kept")
    )
