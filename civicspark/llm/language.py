"""Language identification with a small convolutional network over bytes.

Windows of a fixed number of bytes go through one embedding, filters of several widths, a maximum over the window and
a softmax. The network is trained in numpy on the driver from a bounded sample of labelled windows; Spark tasks apply
it to every window of every text, in batches, and average the windows of a text by the letters they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .frames import tidy
from .kernels import utf8

#: Lower case for A-Z; digits, ASCII punctuation, control bytes and white space all read as one space.
FOLD = np.full(256, 0x20, np.uint8)
FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[0x80:] = np.arange(0x80, 0x100)
UNKNOWN = "und"
#: Bytes of text whose windows are made at once.
_PIECE = 1 << 20


@dataclass(frozen=True)
class Settings:
    """``docs_per_language``: the bound of the training sample, documents of each language, ``windows_per_doc`` windows of each."""

    window: int = 128
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 14
    embedding: int = 8
    docs_per_language: int = 500
    windows_per_doc: int = 3
    epochs: int = 8
    batch: int = 64
    rate: float = 4e-3
    seed: int = 7


@dataclass
class Network:
    languages: list[str]
    settings: Settings
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self) -> Network:
        s, rng = self.settings, np.random.default_rng(self.settings.seed)
        w = {
            "emb": rng.normal(0, 0.5, (256, s.embedding)),
            "out": rng.normal(0, 0.1, (s.filters * len(s.widths), len(self.languages))),
            "bias": np.zeros(len(self.languages)),
        }
        for k in s.widths:
            w[f"conv{k}"] = rng.normal(0, (k * s.embedding) ** -0.5, (k * s.embedding, s.filters))
            w[f"off{k}"] = np.zeros(s.filters)
        self.weights = {k: v.astype(np.float32) for k, v in w.items()}
        return self

    def _columns(self, emb: np.ndarray, k: int) -> np.ndarray:
        n = emb.shape[1] - k + 1
        return np.concatenate([emb[:, i : i + n] for i in range(k)], axis=2)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        w, out = self.weights, []
        emb = w["emb"][windows]
        for k in self.settings.widths:
            n = emb.shape[1] - k + 1
            act = emb[:, :n].reshape(-1, emb.shape[2]) @ w[f"conv{k}"][: emb.shape[2]]
            for i in range(1, k):
                act += emb[:, i : i + n].reshape(-1, emb.shape[2]) @ w[f"conv{k}"][i * emb.shape[2] : (i + 1) * emb.shape[2]]
            out.append(act.reshape(len(windows), n, -1).max(axis=1) + w[f"off{k}"])
        return np.maximum(np.concatenate(out, axis=1), 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return softmax(self.pooled(windows) @ self.weights["out"] + self.weights["bias"])

    def fit(self, windows: np.ndarray, labels: np.ndarray) -> Network:
        s, w, rng = self.settings, self.start().weights, np.random.default_rng(self.settings.seed)
        m = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in w.items()}
        # each language weighs the same, however many windows it gave
        weight = 1 / np.maximum(np.bincount(labels, minlength=len(self.languages)), 1)[labels]
        weight = (weight / weight.mean()).astype(np.float32)
        step, total = 0, s.epochs * -(-len(labels) // s.batch)
        for _ in range(s.epochs):
            for at in np.array_split(rng.permutation(len(labels)), -(-len(labels) // s.batch)):
                step += 1
                rate = s.rate * (1 - 0.9 * step / total)
                for k, g in self._gradients(windows[at], labels[at], weight[at]).items():
                    m[k][0] += 0.1 * (g - m[k][0])
                    m[k][1] += 0.001 * (g * g - m[k][1])
                    w[k] -= rate * (m[k][0] / (1 - 0.9**step)) / (np.sqrt(m[k][1] / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        w, f, rows = self.weights, self.settings.filters, np.arange(len(x))[:, None]
        emb = w["emb"][x]
        columns = {k: self._columns(emb, k) for k in self.settings.widths}
        peaks, pooled = {}, []
        for k, c in columns.items():
            act = c @ w[f"conv{k}"] + w[f"off{k}"]
            peaks[k] = act.argmax(axis=1)
            pooled.append(np.take_along_axis(act, peaks[k][:, None], axis=1)[:, 0])
        pre = np.concatenate(pooled, axis=1)
        hidden = np.maximum(pre, 0)
        delta = softmax(hidden @ w["out"] + w["bias"])
        delta[np.arange(len(x)), y] -= 1
        delta *= weight[:, None] / len(x)
        grads = {"out": hidden.T @ delta, "bias": delta.sum(axis=0), "emb": np.zeros_like(w["emb"])}
        back = (delta @ w["out"].T) * (pre > 0)
        for j, (k, c) in enumerate(columns.items()):
            g, at = back[:, j * f : (j + 1) * f], peaks[k]
            seen = c[rows, at]  # rows, filters, columns: what each filter saw at its peak
            grads[f"conv{k}"] = np.einsum("bf,bfc->cf", g, seen)
            grads[f"off{k}"] = g.sum(axis=0)
            down = np.einsum("bf,cf->bfc", g, w[f"conv{k}"]).reshape(len(x), f, k, -1)
            for i in range(k):
                np.add.at(grads["emb"], x[rows, at + i], down[:, :, i])
        return grads


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all rows, side by side, the last of a row filled up with spaces; and the row of each."""
    length = np.diff(offsets)
    count = -(-length // window)
    row = np.repeat(np.arange(len(length)), count)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * window
    at = (offsets[row] + start)[:, None] + np.arange(window)
    inside = at < offsets[row + 1][:, None]
    return np.where(inside, FOLD[data[np.where(inside, at, 0)]] if len(data) else 0x20, 0x20).astype(np.uint8), row


def held_out(key: str = "doc_id") -> Column:
    """True for the rows that no model learns from: crc32 of the key's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()
) -> Network:  # noqa: B008
    """A network trained on at most ``docs_per_language`` documents of each language that are not held out.

    Rows whose text or language is null teach nothing. Without any the network has no languages.
    """
    frame = docs.select(key, text, lang).where(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(key))
    counts = {r[lang]: r["n"] for r in frame.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    network = Network(sorted(counts), settings)
    if not counts:
        return network
    # hashing picks about twice the documents wanted; the driver keeps the first of each language
    share = {k: min(1.0, 2 * settings.docs_per_language / n) for k, n in counts.items()}
    place = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / float(1 << 30)
    limit = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])[F.col(lang)]
    picked = frame.where(place < limit).select(place.alias("place"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    width, each, seed = settings.window, settings.windows_per_doc, settings.seed

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            made, row = cut(data, offsets, width)
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            places = batch.column(0).to_numpy()
            keep = [
                first[i] + np.random.default_rng([seed, int(places[i] * (1 << 30))]).permutation(n)[:each]
                for i in range(batch.num_rows) if (n := first[i + 1] - first[i])
            ]
            keep = np.concatenate(keep) if keep else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row[keep])),
                    batch.column(1).take(pa.array(row[keep])),
                    pa.array([m.tobytes() for m in made[keep]], pa.binary()),
                ],
                names=["place", "lang", "bytes"],
            )

    rows = sorted(
        (tuple(r) for r in picked.mapInArrow(tidy(windows), "place double, lang string, bytes binary").collect()), key=lambda r: r[0]
    )
    x, y, seen = [], [], dict.fromkeys(network.languages, 0)
    for _, language, content in rows:
        if seen[language] < settings.docs_per_language * each:
            seen[language] += 1
            x.append(np.frombuffer(content, np.uint8))
            y.append(network.languages.index(language))
    if not x:
        return Network([], settings)
    x, y = np.stack(x), np.array(y)
    # short texts occur too: as many windows again, cut down to a few bytes
    rng = np.random.default_rng(seed)
    short = x.copy()
    short[np.arange(width) >= rng.integers(6, width, len(x))[:, None]] = 0x20
    return network.fit(np.concatenate([x, short]), np.concatenate([y, y]))


def identify(
    docs: DataFrame, network: Network, *, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), windows_at_once: int = 512
) -> DataFrame:
    """``key``, the columns named in ``carry``, ``lang_pred`` and ``score`` (mean probability, 0 to 1) of every row, from its whole text alone.

    A text that is null or has no letter is ``und`` with score 0, as is every text if the network knows no language.
    Texts of any length count whole, in windows from their first byte on, so that equal texts have equal results.
    Repeated rows each get a row, ties go to the language first in order, an empty table gives no rows; no other column
    is read.
    """
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    frame = docs.select(F.col(key), F.when(lettered, F.col(text)).alias("_seen"), *carry)
    kinds = [StructField(c, frame.schema[c].dataType) for c in (key, *carry)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = network  # a few thousand numbers, whatever the input
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            rows, names = batch.num_rows, [*net.languages, UNKNOWN]
            total, mass = np.zeros((rows, len(net.languages))), np.zeros(rows)
            # rows are taken some at a time, a long text in pieces of its own, so that the windows of a batch never stand
            # in memory together and a text's windows hang on its own bytes alone
            piece, lo = _PIECE // net.settings.window * net.settings.window, 0
            while lo < rows and net.languages:
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + piece, side="right")) - 1)
                for a in range(int(offsets[lo]), int(offsets[hi]), piece):
                    b = min(a + piece, int(offsets[hi]))
                    made, row = cut(data[a:b], np.clip(offsets[lo : hi + 1], a, b) - a, net.settings.window)
                    for at in range(0, len(row), windows_at_once):
                        part, of = made[at : at + windows_at_once], row[at : at + windows_at_once] + lo
                        weight = (part != 0x20).sum(axis=1) + 1e-9
                        np.add.at(total, of, net.probabilities(part) * weight[:, None])
                        np.add.at(mass, of, weight)
                lo = hi
            known = (mass > 0) & (np.diff(offsets) > 0)
            best = total.argmax(axis=1) if net.languages else np.zeros(rows, int)
            score = np.where(known, total[np.arange(rows), best] / np.maximum(mass, 1e-12), 0.0) if net.languages else np.zeros(rows)
            best = np.where(known, best, len(net.languages))
            made = [pa.array([names[i] for i in best], pa.string()), pa.array(np.clip(score, 0, 1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *made], names=[key, *carry, "lang_pred", "score"])

    return frame.mapInArrow(tidy(run), StructType([*kinds, *StructType.fromDDL("lang_pred string, score double")]))
