"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. Each model sees the words of a text and the probabilities of the earlier
categories; in training these come from models of other folds, so that no model learns from a probability that has seen
the row's own label. Models are sparse logistic regressions, fitted in numpy on the driver from a bounded sample of
labelled rows; Spark tasks apply the chain to every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import tidy
from .kernels import utf8, word_hashes

#: Every ASCII byte but letters and digits separates words here.
GAP = np.zeros(256, bool)
GAP[[b for b in range(128) if not chr(b).isalnum()]] = True


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows that are learned from and ``sample_bytes`` their features, 4 bytes each;
    features are hashed into 2**``bits`` places."""

    sample_rows: int = 8000
    sample_bytes: int = 128 << 20
    bits: int = 20
    prefix: int = 4
    folds: int = 3
    epochs: int = 6
    l1: float = 10.0
    l2: float = 1.0
    rate: float = 0.3
    seed: int = 11


@dataclass
class Chain:
    categories: list[str]
    settings: Settings
    #: Of each category: the weights of hashed words, of earlier categories' probabilities, and the bias.
    models: list[tuple[np.ndarray, np.ndarray, float]]


def features(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The place of each word and of each word's first bytes, row by row, with the row of each; not yet distinct."""
    words, at = word_hashes(data, offsets, gap=GAP)
    starts, _ = word_hashes(data, offsets, gap=GAP, prefix=settings.prefix)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    shift = np.uint64(64 - settings.bits)
    return np.concatenate([words >> shift, (starts ^ np.uint64(0x5851F42D4C957F2D)) >> shift]).astype(np.int64), np.concatenate([row, row])


def _fit(rows: list[np.ndarray], earlier: np.ndarray, labels: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """Follow-the-regularised-leader with L1, which leaves words that tell nothing at exactly 0."""
    size, extra = 1 << s.bits, earlier.shape[1]
    z, n, w = (np.zeros(size + extra + 1) for _ in range(3))
    values = np.concatenate([earlier, np.ones((len(rows), 1))], axis=1)
    tail = np.arange(size, size + extra + 1)
    rng = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for i in rng.permutation(len(rows)):
            at = np.concatenate([rows[i], tail])
            x = np.concatenate([np.ones(len(rows[i])), values[i]])
            l1 = np.where(at < size, s.l1, 0.0)
            w[at] = np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / (s.l2 + np.sqrt(n[at]) / s.rate))
            p = 1 / (1 + np.exp(-np.clip(w[at] @ x, -30, 30)))
            g = (p - labels[i]) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.rate
            z[at] += g - step * w[at]
            n[at] += g * g
    l1 = np.where(np.arange(len(z)) < size, s.l1, 0.0)
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / (s.l2 + np.sqrt(n) / s.rate))
    return w[:size].astype(np.float32), w[size:-1], float(w[-1])


def _predict(model: tuple[np.ndarray, np.ndarray, float], place: np.ndarray, row: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    weights, chained, bias = model
    told = weights[place] != 0
    pairs = np.unique(np.stack([row[told], place[told]], axis=1), axis=0) if told.any() else np.zeros((0, 2), np.int64)
    score = np.bincount(pairs[:, 0], weights=weights[pairs[:, 1]], minlength=len(earlier)) + earlier @ chained + bias
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    *,
    key: str = "doc_id",
    text: str = "text",
    settings: Settings = Settings(),
) -> Chain:  # noqa: B008
    """A chain over ``categories``: name -> 0/1 column of ``labels``, in order.

    Rows with a null key, text or label teach nothing; of a key that is labelled or stands repeatedly all rows count, up
    to the bounds of the sample, which is the same at every run. Texts of any length teach whole. Without rows to learn
    from, every probability is 0.
    """
    s, names = settings, [*categories]
    labelled = labels.select(F.col(key).alias("_k"), *[c.cast("int").alias(f"_y{i}") for i, c in enumerate(categories.values())]).na.drop()
    # the first by hash: the same rows at every run, at most sample_rows of them
    sample = labelled.distinct().orderBy(F.xxhash64("_k"), "_k", *[f"_y{i}" for i in range(len(names))]).limit(s.sample_rows)
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_k"), F.col(text).alias("_text")).join(F.broadcast(sample), "_k").select("_k", F.array(*[f"_y{i}" for i in range(len(names))]).alias("_y"), "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            place, row = features(data, offsets, s)
            pairs = np.unique(row << s.bits | place)
            ends = np.searchsorted(pairs, np.arange(batch.num_rows + 1) << s.bits)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array(
                        [x.astype(np.int32).tobytes() for x in np.split(pairs & ((1 << s.bits) - 1), ends[1:-1])][: batch.num_rows],
                        pa.binary(),
                    ),
                    pa.array(np.zeros(batch.num_rows, np.int64)) if batch.column(0).type == pa.null() else batch.column(0).cast(pa.string()),
                ],
                names=["y", "x", "k"],
            )

    made = rows.mapInArrow(tidy(run), "y array<int>, x binary, k string")
    # rows that repeat a key come on top of the sample, and texts have any length: both bounds hold again here
    first = [F.xxhash64("k"), "k", "y", "x"]
    kept = made.orderBy(*first).limit(s.sample_rows).withColumn(
        "so_far", F.sum(F.octet_length("x").cast("long")).over(Window.orderBy(*first))
    )
    got = sorted((r["k"], *r["y"], bytes(r["x"])) for r in kept.where(F.col("so_far") <= s.sample_bytes).collect())
    if not got:
        return Chain(names, s, [(np.zeros(1 << s.bits, np.float32), np.zeros(i), -30.0) for i in range(len(names))])
    x = [np.frombuffer(r[-1], np.int32).astype(np.int64) for r in got]
    y = np.array([r[1:-1] for r in got], float)
    place, row = np.concatenate(x), np.repeat(np.arange(len(x)), [len(i) for i in x])
    fold = np.random.default_rng(s.seed).integers(0, s.folds, len(x))
    models, earlier = [], np.zeros((len(x), 0))
    for i in range(len(names)):
        models.append(_fit(x, earlier, y[:, i], s))
        if i + 1 < len(names):
            out = np.zeros(len(x))
            for f in range(s.folds):
                rest, own = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                if len(rest) and len(own):
                    model = _fit([x[j] for j in rest], earlier[rest], y[rest, i], s)
                    out[own] = _predict(
                        model, np.concatenate([x[j] for j in own]), np.repeat(np.arange(len(own)), [len(x[j]) for j in own]), earlier[own]
                    )
            earlier = np.concatenate([earlier, out[:, None]], axis=1)
    return Chain(names, s, models)


def score(docs: DataFrame, chain: Chain, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and a probability ``p_<category>`` for each category of every row, from its whole text.

    Null text counts as empty; texts of any length count whole; repeated rows each get a row; an empty table gives no
    rows; no other column is read.
    """
    frame = docs.select(key, text)
    kind = frame.schema[key].dataType.simpleString()
    settings = chain.settings
    sent = docs.sparkSession.sparkContext.broadcast(chain.models)  # 2**bits weights a category, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                data, offsets = utf8(part.column(1))
                place, row = features(data, offsets, settings)
                earlier = np.zeros((part.num_rows, 0))
                for model in sent.value:
                    earlier = np.concatenate([earlier, _predict(model, place, row, earlier)[:, None]], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(p) for p in earlier.T]], names=[key, *[f"p_{c}" for c in chain.categories]]
                )

    return frame.mapInArrow(tidy(run), f"`{key}` {kind}, " + ", ".join(f"`p_{c}` double" for c in chain.categories))
