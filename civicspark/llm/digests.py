"""Similarity digests of documents from improbable features.

A feature is a window of bytes. Its entropy falls into one of 1,000 classes, and classes are ranked by rarity: how few
windows of the whole corpus fall into them. In every run of neighbouring windows the rarest (the first of equals) gets
a vote; features with enough votes go, by hash, into a chain of Bloom filters of equal capacity. Two digests are
compared by the overlap of their filters' bits, normalised so that chance overlap is 0 and containment 1.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .frames import partitions, tidy
from .kernels import mix, sliding_min, utf8

_CLASSES = 1000
_STEP = 1 << 15


@dataclass(frozen=True)
class Settings:
    """``window``: bytes of a feature; ``run``: windows that vote together; ``votes``: that a feature needs; entropy
    classes under ``least`` (of 1,000: near-constant windows) never count; filters have ``bits`` bits for ``capacity``
    features of ``hashes`` bits each."""

    window: int = 16
    run: int = 16
    votes: int = 4
    least: int = 150
    bits: int = 2048
    capacity: int = 160
    hashes: int = 5


def entropy_classes(data: np.ndarray, window: int) -> np.ndarray:
    """The entropy class, 0 to 999, of the window from each place on: a function of the window's bytes alone.

    A window's sum of c * log2(c) over its byte counts c changes by what the byte that enters adds and what the byte
    that leaves takes away; both follow from how often the byte occurs in the window so far. Sums are of integers, and
    so exact wherever the window stands.
    """
    n = len(data)
    if n < window:
        return np.zeros(0, np.int16)
    counts = np.arange(1, window + 1, dtype=np.float64)
    gain = np.concatenate([[0], np.round(counts * np.log2(counts) * (1 << 16))]).astype(np.int32)
    up = np.diff(gain)  # from c to c + 1
    most, scale = int(gain[window]), np.float32(_CLASSES / max(1, int(gain[window])))
    out = np.empty(n - window + 1, np.int16)
    for a in range(0, n - window + 1, _STEP):
        part = data[a : a + _STEP + window - 1]
        before, after = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
        for d in range(1, window):
            same = (part[d:] == part[:-d]).view(np.uint8)
            before[d:] += same
            after[:-d] += same
        # the step from i to i + 1: both windows share the window - 1 bytes that ``before`` and ``after`` count in
        left = np.empty(len(part) - window + 1, np.int32)
        left[0] = most - int(gain[np.bincount(part[:window], minlength=256)].sum())
        left[1:] = up.take(after[: len(part) - window]) - up.take(before[window:])
        np.cumsum(left, out=left)
        out[a : a + len(left)] = np.minimum(left * scale, np.float32(_CLASSES - 1))
    return out


def rarity_ranks(histogram: np.ndarray, least: int) -> np.ndarray:
    """The rank of each entropy class, the rarest first, equals by class; classes under ``least`` have none (the largest value)."""
    order = np.lexsort((np.arange(_CLASSES), histogram))
    ranks = np.empty(_CLASSES, np.uint32)
    ranks[order] = np.arange(_CLASSES, dtype=np.uint32)
    ranks[:least] = _CLASSES
    return ranks


def histogram(docs: DataFrame, *, text: str = "text", settings: Settings = Settings()) -> np.ndarray:  # noqa: B008
    """How many windows of all texts fall into each entropy class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CLASSES, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            classes = entropy_classes(data, settings.window)
            inside = np.arange(settings.window, settings.window + len(classes), dtype=np.int32) <= _row_ends(offsets, len(classes))
            total += np.bincount(classes[inside], minlength=_CLASSES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["class", "n"])

    out = np.zeros(_CLASSES, np.int64)
    for r in docs.select(text).mapInArrow(tidy(run), "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        out[r["class"]] = r["n"]
    return out


def _row_ends(offsets: np.ndarray, n: int) -> np.ndarray:
    """Where the row of each of the first n places ends."""
    kind = np.int32 if offsets[-1] < 1 << 31 else np.int64
    return np.repeat(offsets[1:].astype(kind), np.diff(offsets))[:n]


class Digester:
    def __init__(self, ranks: np.ndarray, settings: Settings):
        self.ranks, self.settings = ranks, settings

    def many(self, texts: list[bytes]) -> list[np.ndarray]:
        """The chain of filters of each text, as rows of bytes, each followed by its number of features."""
        s = self.settings
        # spaces fill up a text that is shorter than a feature
        texts = [t if len(t) >= s.window or not t else t + b" " * (s.window - len(t)) for t in texts]
        if len(texts) > 1 and sum(map(len, texts)) >= 1 << 20:
            half = len(texts) // 2
            return self.many(texts[:half]) + self.many(texts[half:])
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        chosen = self._chosen(data, offsets)
        value = gram_hashes_at(data, chosen, s.window)
        row = np.searchsorted(offsets, chosen, side="right") - 1
        first = np.searchsorted(row, np.arange(len(texts) + 1))
        out = []
        for i in range(len(texts)):
            values = value[first[i] : first[i + 1]]
            _, at = np.unique(values, return_index=True)
            values = values[np.sort(at)]
            chain = np.zeros((-(-len(values) // s.capacity), s.bits // 8 + 1), np.uint8)
            bits = np.zeros((len(chain), s.bits), np.uint8)
            link = np.arange(len(values)) // s.capacity
            for k in range(s.hashes):
                bits[link, (values >> np.uint64(12 * k)).astype(np.int64) & (s.bits - 1)] = 1
            if len(chain):
                chain[:, :-1] = np.packbits(bits, axis=1)
                chain[:, -1] = np.bincount(link, minlength=len(chain))
            out.append(chain)
        return out

    def _chosen(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        s = self.settings
        classes = entropy_classes(data, s.window)
        n = len(classes)
        if not n:
            return np.zeros(0, np.int64)
        ends = _row_ends(offsets, n)
        at = np.arange(n, dtype=ends.dtype)
        # rank first, then place: the least of a run is its rarest, first feature
        kind, low = (np.uint32, 21) if n < 1 << 21 else (np.uint64, 40)
        none = kind((_CLASSES + 1) << low)
        votes = np.full(n + s.run - 1, none, kind)
        np.bitwise_or(self.ranks.astype(kind).take(classes) << kind(low), at.astype(kind), out=votes[:n], where=at + s.window <= ends)
        found = sliding_min(votes, s.run)
        # a run begins at each place of a row and ends in the row; a row too short for one run has one all the same
        begins = at + (s.window + s.run - 1) <= ends
        length = np.diff(offsets)
        short = (length >= s.window) & (length < s.window + s.run - 1)
        begins[offsets[:-1][short]] = True
        found = found[begins]
        place = (found[found < kind(_CLASSES << low)] & kind((1 << low) - 1)).astype(np.int64)
        got = np.bincount(place, minlength=n)
        chosen = np.flatnonzero(got)
        runs = np.maximum(length - s.window - s.run + 2, 1)
        needed = np.minimum(s.votes, runs)[np.searchsorted(offsets, chosen, side="right") - 1]
        return chosen[got[chosen] >= needed]


def gram_hashes_at(data: np.ndarray, places: np.ndarray, window: int) -> np.ndarray:
    """The hash of the window from each of the places on."""
    if not len(places):
        return np.zeros(0, np.uint64)
    value = np.zeros(len(places), np.uint64)
    for k in range(0, window, 8):
        word = np.zeros(len(places), np.uint64)
        for j in range(k, min(k + 8, window)):
            word = word << np.uint64(8) | data[places + j]
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + word)
    return value


def likeness(a: np.ndarray, b: np.ndarray, settings: Settings) -> float:
    """0 to 1: for each filter of the shorter chain the best normalised overlap with one of the other, weighed by features.

    Two empty digests are alike (1), an empty one is unlike any other (0).
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a is b:
        return 1.0
    if len(a) > len(b) or len(a) == len(b) and a.tobytes() > b.tobytes():
        a, b = b, a
    ones_a, ones_b = (np.bitwise_count(x[:, :-1]).sum(axis=1, dtype=np.int64).astype(float) for x in (a, b))
    if len(a) * len(b) > 1 << 14:
        both = np.stack([np.bitwise_count(x[:-1] & b[:, :-1]).sum(axis=1, dtype=np.int64) for x in a])
    else:
        both = np.bitwise_count(a[:, None, :-1] & b[None, :, :-1]).sum(axis=2, dtype=np.int64)
    chance = ones_a[:, None] * ones_b / settings.bits
    least = np.minimum(ones_a[:, None], ones_b)
    score = np.clip((both - chance) / np.maximum(least - chance, 1e-9), 0, 1)
    # a filter of few features says little about a full one: what it holds at most counts
    share = np.minimum(np.minimum(a[:, -1][:, None], b[:, -1]) / np.maximum(1, np.maximum(a[:, -1][:, None], b[:, -1])) * 2, 1)
    return float(np.average((score * share).max(axis=1), weights=a[:, -1]))


def text_of(chain: np.ndarray, settings: Settings) -> str:
    return f"v1:{settings.window}:{len(chain)}:" + base64.b64encode(chain.tobytes()).decode()


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def neighbours(
    docs: DataFrame, ranks: np.ndarray, *, key: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> DataFrame:  # noqa: B008
    """Each document's fingerprint, its edited text with its fingerprint, and its likeness to that and to the next document.

    ``key``, ``n_chars`` (code points), ``fingerprint``, ``edited``, ``edited_fingerprint``, ``near_edited``, ``near_next``. The next document is
    that of the next larger key, after the last the first; of equal keys the text decides, and repeated rows follow each
    other; a lone document is its own next. Keys are numbers. Null text counts as empty, null keys come first; texts of any
    length count whole; an empty table gives no rows; no other column is read.

    Rows are dealt into key ranges; the first row of each range is also sent to the range before it, so that each task
    meets every row's successor as it reads its sorted rows once.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    parts = partitions(spark)
    # as many bounds as partitions: a few numbers, whatever the input
    quantiles = rows.agg(
        F.percentile_approx(F.col("_k"), [i / parts for i in range(1, parts)], 10 * parts).alias("q")
    ).first()["q"] if parts > 1 else None
    bounds = sorted(set(quantiles or []))
    ranged = _ranged(rows, bounds)
    nulls = F.max(F.col("_k").isNull().cast("int"))
    heads = [
        (r["_range"], r["head"])
        for r in ranged.groupBy("_range").agg(F.when(nulls == 0, F.min("_k")).alias("head")).orderBy("_range").collect()
    ]
    if not heads:
        return spark.createDataFrame(
            [],
            f"`{key}` {kind}, n_chars long, fingerprint string, edited string, edited_fingerprint string, near_edited double, near_next double",
        )
    table = spark.createDataFrame([(r, heads[i - 1][0], h) for i, (r, h) in enumerate(heads)], f"_range int, _before int, _head {kind}")
    ranged = ranged.join(F.broadcast(table), "_range")
    own, sent = F.struct(F.col("_range").alias("r"), F.lit(0).alias("copy")), F.struct(F.col("_before").alias("r"), F.lit(1).alias("copy"))
    is_head = F.col("_k").eqNullSafe(F.col("_head"))
    dealt = ranged.withColumn("_to", F.explode(F.when(is_head, F.array(own, sent)).otherwise(F.array(own))))
    dealt = dealt.select(F.col("_to.r").alias("_r"), F.col("_to.copy").alias("_copy"), "_k", "_text")
    ordered = dealt.repartitionByRange(parts, "_r").sortWithinPartitions("_r", "_copy", "_k", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digester = Digester(ranks, settings)
        held: list[tuple] = []  # rows whose successor isn't known yet, in order
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                held += zip(*(part.column(i).to_pylist() for i in range(4)), strict=True)
                if len(held) > 256:
                    yield compared(digester, held)
                    held = held[-1:]
        yield compared(digester, [*held, None])

    def compared(digester: Digester, held: list) -> pa.RecordBatch:
        pairs = [(a, b) for a, b in zip(held, held[1:], strict=False) if a is not None and not a[1] and b is not None]
        texts = list(dict.fromkeys(t for a, b in pairs for t in (a[3], b[3])))
        changed = [edited(a[3], b[3]) for a, b in pairs]
        made = digester.many([t.encode() for t in [*texts, *changed]])
        of = dict(zip(texts, made[: len(texts)], strict=True))
        rows = [(a[2], len(a[3]), text_of(of[a[3]], settings), c, text_of(d, settings), likeness(of[a[3]], d, settings), likeness(of[a[3]], of[b[3]], settings)) for (a, b), c, d in zip(pairs, changed, made[len(texts) :], strict=True)]
        names = [key, "n_chars", "fingerprint", "edited", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [arrow, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(7)], names=names)

    arrow = to_arrow_type(docs.schema[key].dataType)
    return ordered.mapInArrow(
        tidy(run),
        f"`{key}` {kind}, n_chars long, fingerprint string, edited string, edited_fingerprint string, near_edited double, near_next double",
    )


def _ranged(rows: DataFrame, bounds: list) -> DataFrame:
    """``_range``: how many bounds are at or below the key; null keys are in range 0."""
    if not bounds:
        return rows.withColumn("_range", F.lit(0))
    cut = Bucketizer(splits=[float("-inf"), *map(float, bounds), float("inf")], inputCol="_d", outputCol="_b", handleInvalid="keep")
    out = cut.transform(rows.withColumn("_d", F.col("_k").cast("double")))
    return out.withColumn("_range", F.when(F.col("_k").isNull(), F.lit(0)).otherwise(F.col("_b").cast("int"))).drop("_d", "_b")
